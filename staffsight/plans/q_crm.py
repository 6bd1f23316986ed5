"""CRM queries: scenarios, periods, measures, the previous-month correction and the
full feature block. Amounts stay exact decimals until each measure is cast to double, so
the oracle and Spark agree to the last bit whatever order they sum in."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crm
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .registry import register

SNAP_DATES = ("1998-02-10", "1998-05-10", "1998-08-10", "1998-11-20")
_DATES_ARRAY_SQL = "[" + ", ".join(f"date '{d}'" for d in SNAP_DATES) + "]"


def _snap_dates():
    return F.explode(F.array(*[F.lit(d).cast("date") for d in SNAP_DATES]))


def _prob(col):
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(3,2)")


def crm_plan(t):
    o, c = t.orders, t.customer
    prio = F.col("o_orderpriority")
    p = (F.when(prio == "1-URGENT", 1.0).when(prio == "2-HIGH", 0.8).when(prio == "3-MEDIUM", 0.6)
         .when(prio == "4-NOT SPECIFIED", 0.4).otherwise(0.1)).cast("decimal(3,2)")
    g = (o.join(c, o.o_custkey == c.c_custkey)
         .groupBy(F.concat(F.lit("PRJ"), (F.col("o_custkey") % 97).cast("string")).alias("project_name"),
                  F.col("c_mktsegment").alias("customer_name"), (F.col("c_nationkey") % 3).alias("gbu_id"),
                  F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), p.alias("probability"))
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")))
    return g.withColumn("date", _snap_dates())


def crm_actual(t):
    p = crm_plan(t)
    return p.withColumn("amount", F.when(F.col("month") % 4 == 0, F.lit(0)).otherwise(F.col("amount") * F.lit(0.9)
                                                                                        .cast("decimal(2,1)")))


def crm_positions(t):
    pos, c = fx.v_position(t), t.customer
    g = (pos.join(c, pos.customer_id == c.c_custkey)
         .groupBy(F.concat(F.lit("PRJ"), (F.col("customer_id") % 97).cast("string")).alias("project_name"),
                  F.col("c_mktsegment").alias("customer_name"), (F.col("c_nationkey") % 3).alias("gbu_id"),
                  F.year("planned_start_date").alias("year"), F.month("planned_start_date").alias("month"))
         .agg(F.count(F.lit(1)).alias("amount")))
    return g.withColumn("date", _snap_dates())


_CRM_SQL = f"""
plan as (select 'PRJ' || cast(o.o_custkey % 97 as varchar) as project_name, c.c_mktsegment as customer_name,
           c.c_nationkey % 3 as gbu_id, year(o.o_orderdate) as year, month(o.o_orderdate) as month,
           cast(case o.o_orderpriority when '1-URGENT' then 1.0 when '2-HIGH' then 0.8 when '3-MEDIUM' then 0.6
                when '4-NOT SPECIFIED' then 0.4 else 0.1 end as decimal(3,2)) as probability,
           sum(cast(o.o_totalprice as decimal(18,2))) as amount, unnest({_DATES_ARRAY_SQL}) as date
         from orders o join customer c on o.o_custkey = c.c_custkey group by 1, 2, 3, 4, 5, 6),
act as (select project_name, customer_name, gbu_id, year, month, probability,
          case when month % 4 = 0 then 0 else amount * cast(0.9 as decimal(2,1)) end as amount, date from plan),
pos as (select 'PRJ' || cast(p.customer_id % 97 as varchar) as project_name, c.c_mktsegment as customer_name,
          c.c_nationkey % 3 as gbu_id, year(p.planned_start_date) as year, month(p.planned_start_date) as month,
          count(*) as amount, unnest({_DATES_ARRAY_SQL}) as date
        from v_position p join customer c on p.customer_id = c.c_custkey group by 1, 2, 3, 4, 5)"""


def _amt_sql(s: str) -> str:
    if s == "Optimistic":
        return "amount"
    if s == "Pessimistic":
        return "case when probability >= 1 then amount else 0 end"
    if s == "Weighted":
        return "amount * probability"
    k = "((year * 4 + (month - 1) // 3) - (year(date) * 4 + (month(date) - 1) // 3))"
    return (f"case when (case when {k} <= 0 then probability >= 0.8 when {k} = 1 then probability >= 0.6 "
            f"when {k} = 2 then probability >= 0.4 else true end) then amount else 0 end")


def _idx(p: int, y: str = "year", m: str = "month") -> str:
    return f"({y} * {p} + ({m} - 1) // {12 // p})"


def _measures_sql(table: str, base: str, value: str, types, scen: bool = True, scenarios=crm.SCENARIOS,
                  ranges=tuple(crm.RANGES)) -> str:
    key = crm.BASES[base]
    cols = []
    for t in types:
        for r in ranges:
            p = crm.RANGES[r]
            hit = f"{_idx(p)} - {_idx(p, 'year(date)', 'month(date)')} = {crm.TYPES[t]}"
            for s in scenarios:
                amt = _amt_sql(s) if scen else "amount"
                cols.append(f"coalesce(cast(sum(case when {hit} then {amt} else 0 end) as double), 0.0) "
                            f"as {crm.measure_name(s, t, r, base, value)}")
    return f"select {key}, date, {', '.join(cols)} from {table} group by {key}, date"


_PREV = "((year(date) * 12 + month(date) - 1) - 1)"


def _revenue_sql(base: str) -> str:
    """Corrected revenue measures of one base (CTE body)."""
    key = crm.BASES[base]
    plan_prev = ", ".join(f"cast(sum(case when {_idx(12)} = {_PREV} then {_amt_sql(s)} else 0 end) as double) "
                          f"as plan_{s}" for s in crm.SCENARIOS)
    names = [crm.measure_name(s, t, r, base, "revenue") for t in crm.TYPES for r in crm.RANGES for s in crm.SCENARIOS]
    sel = []
    pm = f"({_PREV} % 12 + 1)"
    conds = {"month": "true", "quarter": f"{pm} in (3, 6, 9, 12)", "half_year": f"{pm} in (6, 12)",
             "year": f"{pm} = 12"}
    for n in names:
        base_expr = f"coalesce(m.{n}, 0.0)"
        parts = n.split("_")
        s, t = parts[0], parts[1]
        if t == "previous":
            r = "half_year" if "_half_year_" in n else parts[2]
            sel.append(f"case when f.plan_{s} is not null and f.plan_{s} > 0 and {conds[r].replace('date', 'm.date')} "
                       f"then {base_expr} + f.plan_{s} else {base_expr} end as {n}")
        else:
            sel.append(f"{base_expr} as {n}")
    return f"""select m.{key}, m.date, {', '.join(sel)} from
  (select coalesce(a.{key}, b.{key}) as {key}, coalesce(a.date, b.date) as date, a.* exclude ({key}, date),
          b.* exclude ({key}, date)
   from ({_measures_sql('plan', base, 'revenue', ('current', 'next'))}) a
   full join ({_measures_sql('act', base, 'revenue', ('previous',))}) b on a.{key} = b.{key} and a.date = b.date) m
left join (
  select a.{key}, a.date, {', '.join('p.plan_' + s for s in crm.SCENARIOS)} from
    (select {key}, date, count(*) filter (where year = {_PREV} // 12) as nrows,
            coalesce(cast(sum(case when {_idx(12)} = {_PREV} then amount else 0 end) as double), 0.0) as act_prev
     from act group by {key}, date) a
    join (select {key}, date, {plan_prev} from plan group by {key}, date) p on a.{key} = p.{key} and a.date = p.date
    where a.nrows > 0 and a.act_prev = 0 and day(a.date) <= 15) f
  on f.{key} = m.{key} and f.date = m.date"""


def _features_sql(bases=tuple(crm.BASES)) -> str:
    ctes = [_CRM_SQL.strip()]
    ctes.append("keys as (select distinct project_name, customer_name, gbu_id, date from pos)")
    joins, cols = [], []
    for b in bases:
        key = crm.BASES[b]
        ctes.append(f"rev_{b} as ({_revenue_sql(b)})")
        ctes.append(f"fte_{b} as ({_measures_sql('pos', b, 'positions', tuple(crm.TYPES), scen=False)})")
        joins.append(f"left join rev_{b} on rev_{b}.{key} = k.{key} and rev_{b}.date = k.date")
        joins.append(f"left join fte_{b} on fte_{b}.{key} = k.{key} and fte_{b}.date = k.date")
        for t in crm.TYPES:
            for r in crm.RANGES:
                for s in crm.SCENARIOS:
                    for v in ("revenue", "positions"):
                        n = crm.measure_name(s, t, r, b, v)
                        tab = f"rev_{b}" if v == "revenue" else f"fte_{b}"
                        cols.append(f"coalesce({tab}.{n}, 0.0) as {n}")

    def m(s, t, r, b, v):
        n = crm.measure_name(s, t, r, b, v)
        return f"coalesce({'rev' if v == 'revenue' else 'fte'}_{b}.{n}, 0.0)"

    def ratio(a, d, name):
        return f"coalesce(case when {d} = 0 then null else {a} / {d} end, 0.0) as {name}"

    for t in crm.TYPES:
        for r in crm.RANGES:
            for b in bases:
                for s in crm.SCENARIOS:
                    cols.append(ratio(m(s, t, r, b, "revenue"), m(s, t, r, b, "positions"),
                                      f"avg_run_rate_{s}_{t}_{r}_{b}"))
    for r in crm.RANGES:
        for b in bases:
            for v in ("revenue", "positions"):
                for s in crm.SCENARIOS:
                    cols.append(ratio(m(s, "current", r, b, v), m(s, "previous", r, b, v),
                                      f"ratio_current_previous_{s}_{v}_{r}_{b}"))
                    cols.append(ratio(m(s, "next", r, b, v), m(s, "current", r, b, v),
                                      f"ratio_next_current_{s}_{v}_{r}_{b}"))
    return ("with " + ",\n".join(ctes) + "\nselect k.project_name, k.customer_name, k.gbu_id, k.date, "
            + ", ".join(cols) + " from keys k " + " ".join(joins))


@register("a9_fte_by_month", """
select p.container_name, year(w.timesheet_date) as year, """ + ", ".join(
    f"coalesce(sum(case when month(w.timesheet_date) = {i + 1} then w.hours / 160.0 end), 0.0) as {mname}"
    for i, mname in enumerate(crm.MONTHS)) + """
from v_worklog w join v_position p on p.position_id = w.position_id group by 1, 2""",
          views=("v_worklog", "v_position"))
def q_fte_by_month(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = fx.v_worklog(t).join(fx.v_position(t).select("position_id", "container_name"), "position_id") \
        .withColumn("sum_fte", F.col("hours") / 160.0)
    return crm.fte_by_month(w, ["container_name"], month_col="timesheet_date")


@register("a10_crm_scenario_totals", f"""
with {_CRM_SQL.strip()}
select project_name, date, """ + ", ".join(
    f"cast(sum({_amt_sql(s)}) as double) as {s.lower()}_amount" for s in crm.SCENARIOS) + """
from plan group by 1, 2""", views=("v_position",))
def q_scenarios(spark, sf_dir):
    p = crm_plan(Tables(spark, sf_dir))
    aggs = [F.sum(crm.scenario_amount(s, F.col("amount"), F.col("probability"), F.col("year"), F.col("month"),
                                      F.col("date"))).cast("double").alias(f"{s.lower()}_amount")
            for s in crm.SCENARIOS]
    return p.groupBy("project_name", "date").agg(*aggs)


@register("a11_standard_scenario_rows", """
with c as (select *, unnest([date '1998-02-10', date '1998-05-10', date '1998-08-10', date '1998-11-20']) as date,
             cast(probability as decimal(3,2)) as prob from v_crm)
select project_name, year, month, cast(prob as double) as probability, date,
  cast(case when (case when ((year * 4 + (month - 1) // 3) - (year(date) * 4 + (month(date) - 1) // 3)) <= 0
                       then prob >= 0.8
                       when ((year * 4 + (month - 1) // 3) - (year(date) * 4 + (month(date) - 1) // 3)) = 1
                       then prob >= 0.6
                       when ((year * 4 + (month - 1) // 3) - (year(date) * 4 + (month(date) - 1) // 3)) = 2
                       then prob >= 0.4 else true end) then amount else 0 end as double) as standard_amount
from c""", views=("v_crm",))
def q_standard_rows(spark, sf_dir):
    c = fx.v_crm(Tables(spark, sf_dir)).withColumn("date", _snap_dates()) \
        .withColumn("probability", _prob("probability"))
    out = crm.apply_scenario(c, "Standard")
    return out.select("project_name", "year", "month", F.col("probability").cast("double").alias("probability"),
                      "date", F.col("amount").cast("double").alias("standard_amount"))


@register("a12_quarter_sums", """
select project_name, year, cast((month - 1) // 3 + 1 as integer) as period, cast(sum(amount) as double) as amount
from v_crm group by 1, 2, 3""", views=("v_crm",))
def q_periods(spark, sf_dir):
    c = fx.v_crm(Tables(spark, sf_dir))
    return crm.to_periods(c, ["project_name"], "quarter")


@register("a13_period_labels", """
with c as (select *, unnest([date '1998-02-10', date '1998-05-10', date '1998-08-10', date '1998-11-20']) as date
           from v_crm),
l as (select date, case (year * 2 + (month - 1) // 6) - (year(date) * 2 + (month(date) - 1) // 6)
                   when -1 then 'previous' when 0 then 'current' when 1 then 'next' end as label, amount from c)
select date, label, count(*) as n_rows, cast(sum(amount) as double) as amount from l group by 1, 2""",
          views=("v_crm",))
def q_labels(spark, sf_dir):
    c = fx.v_crm(Tables(spark, sf_dir)).withColumn("date", _snap_dates())
    lab = crm.period_label("half_year", F.col("year"), F.col("month"), F.col("date"))
    return c.groupBy("date", lab.alias("label")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                      F.sum("amount").cast("double").alias("amount"))


@register("a14_crm_measures_project", f"with {_CRM_SQL.strip()}\n" + _measures_sql("plan", "project", "revenue",
                                                                                   tuple(crm.TYPES)),
          views=("v_position",))
def q_measures(spark, sf_dir):
    return crm.crm_measures(crm_plan(Tables(spark, sf_dir)), "project", "revenue")


@register("a15_corrected_previous_revenue", f"with {_CRM_SQL.strip()}\n" + _revenue_sql("customer"),
          views=("v_position",))
def q_corrected(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plan, act = crm_plan(t), crm_actual(t)
    rev = crm.crm_measures(plan, "customer", "revenue", types=("current", "next")).join(
        crm.crm_measures(act, "customer", "revenue", types=("previous",)), ["customer_name", "date"], "full")
    names = [c for c in rev.columns if c.endswith("_revenue")]
    rev = rev.fillna(0.0, subset=names)
    return crm.correct_previous(rev, act, plan, "customer")


@register("a16_crm_features", _features_sql(), views=("v_position",))
def q_crm_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pos = crm_positions(t)
    keys = pos.select("project_name", "customer_name", "gbu_id", "date").distinct()
    return crm.crm_features(keys, crm_actual(t), crm_plan(t), pos)
