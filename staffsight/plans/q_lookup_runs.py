"""Lookup, run-version, backfill and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..operators import lookup as lk
from ..operators import quality as qa
from ..operators import runs
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .registry import register

_RUN_DATES = ("2024-01-05", "2024-01-06", "2024-01-07", "2024-01-20")
_RUN_DATES_SQL = ("select cast(d as date) as day from (values ('2024-01-05'), ('2024-01-06'), "
                  "('2024-01-07'), ('2024-01-20')) t(d)")


def _dates_df(spark, vals=_RUN_DATES, col="day"):
    from ..sources.io import days
    return days(spark, vals, col)


@register("j4_lookup", """
select w.position_id, w.employee_id, w.line_no, w.hours, p.staffing_status, p.customer_id
from v_worklog w left join v_position p on w.position_id = p.position_id""", views=("v_worklog", "v_position"))
def q_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lk.lookup(fx.v_worklog(t).select("position_id", "employee_id", "line_no", "hours"),
                     fx.v_position(t), "position_id", ["staffing_status", "customer_id"])


@register("j5_vlookup_first_row", """
with r as (select position_id, timesheet_date, employee_id, hours,
             row_number() over (partition by position_id order by timesheet_date asc nulls last,
                                employee_id asc nulls first, hours asc nulls first) as rn
           from v_worklog)
select p.position_id, p.staffing_status, r.timesheet_date, r.employee_id, r.hours
from v_position p left join r on p.position_id = r.position_id and r.rn = 1""",
          views=("v_position", "v_worklog"))
def q_vlookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lk.lookup(fx.v_position(t).select("position_id", "staffing_status"), fx.v_worklog(t),
                     "position_id", ["timesheet_date", "employee_id", "hours"], order="timesheet_date")


@register("o6_distinct_on_latest", """
with r as (select position_id, timesheet_date, employee_id, hours,
             row_number() over (partition by position_id order by timesheet_date desc nulls last,
                                employee_id desc nulls last, hours desc nulls last) as rn
           from v_worklog)
select position_id, timesheet_date, employee_id, hours from r where rn = 1""", views=("v_worklog",))
def q_distinct_on(spark, sf_dir):
    w = fx.v_worklog(Tables(spark, sf_dir))
    return lk.first_by(w, "position_id", "timesheet_date", ["timesheet_date", "employee_id", "hours"],
                       descending=True)


@register("j9_role_lookup", """
select l.l_orderkey, l.l_linenumber, s1.s_nationkey as supplier_unit, s2.s_nationkey as reviewer_unit
from lineitem l left join supplier s1 on l.l_suppkey = s1.s_suppkey
left join supplier s2 on l.l_partkey % 100 + 1 = s2.s_suppkey""")
def q_role_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             (F.col("l_partkey") % 100 + 1).alias("reviewer_id"))
    out = lk.role_lookup(fact, t.supplier, {"l_suppkey": "supplier_unit", "reviewer_id": "reviewer_unit"},
                         "s_suppkey", "s_nationkey")
    return out.select("l_orderkey", "l_linenumber", "supplier_unit", "reviewer_unit")


@register("j14_project_info", """
select p.position_id, c.c_name as project_name, c.c_acctbal as project_balance, n.n_name as comment_text,
  cast(floor((epoch_us(p.planned_start_date) - epoch_us(p.created)) / 86400000000) as bigint) as days_to_start,
  cast(floor((epoch_us(p.planned_end_date) - epoch_us(p.planned_start_date)) / 86400000000) as bigint) as planned_days
from v_position p left join customer c on p.customer_id = c.c_custkey
left join nation n on p.city_id = n.n_nationkey""", views=("v_position",))
def q_project_info(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pos = fx.v_position(t)
    projects = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("project_name"),
                                 F.col("c_acctbal").alias("project_balance"))
    comments = t.nation.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("comment_text"))
    out = lk.lookup(lk.lookup(pos, projects, "customer_id"), comments, "city_id")
    return out.select("position_id", "project_name", "project_balance", "comment_text",
                      days_between("created", "planned_start_date").alias("days_to_start"),
                      days_between("planned_start_date", "planned_end_date").alias("planned_days"))


@register("j15_reference_attachments", """
select w.position_id, w.line_no, w.employee_id, p.billing_type_id, p.container_name, s.s_nationkey as employee_location,
  p.staffing_status as final_status
from v_worklog w left join v_position p on w.position_id = p.position_id
left join supplier s on w.employee_id = s.s_suppkey""", views=("v_worklog", "v_position"))
def q_attachments(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = fx.v_worklog(t).select("position_id", "line_no", "employee_id")
    pos = fx.v_position(t).select("position_id", "billing_type_id", "container_name",
                                  F.col("staffing_status").alias("final_status"))
    emp = t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("employee_location"))
    return lk.lookup(lk.lookup(w, pos, "position_id"), emp, "employee_id")


@register("j6_latest_run", """
select run_id, day, event_type, n from v_run
where run_id in (select max(run_id) from v_run group by day)""", views=("v_run",))
def q_latest_run(spark, sf_dir):
    return runs.latest_run(fx.v_run(Tables(spark, sf_dir)), "day")


@register("j6_latest_run_strict", """
select run_id, day, event_type, n from v_run
where (day, run_id) in (select day, max(run_id) from v_run group by day)""", views=("v_run",))
def q_latest_run_strict(spark, sf_dir):
    return runs.latest_run(fx.v_run(Tables(spark, sf_dir)), "day", strict=True)


@register("j6_latest_run_date_list", f"""
with d as ({_RUN_DATES_SQL})
select run_id, day, event_type, n from v_run
where run_id in (select max(run_id) from v_run where day in (select day from d) group by day)""",
          views=("v_run",))
def q_latest_run_dates(spark, sf_dir):
    return runs.latest_run(fx.v_run(Tables(spark, sf_dir)), "day", dates=_dates_df(spark))


@register("j7_latest_run_on_dates", f"""
with d as ({_RUN_DATES_SQL})
select run_id, day, event_type, n from v_run
where run_id in (select max(run_id) from v_run group by day) and day in (select day from d)""",
          views=("v_run",))
def q_latest_run_outer(spark, sf_dir):
    return runs.latest_run_on_dates(fx.v_run(Tables(spark, sf_dir)), _dates_df(spark), "day")


@register("j8_newest_run_totals", """
select event_type, sum(n) as sum_n from v_run where run_id = (select max(run_id) from v_run)
group by event_type""", views=("v_run",))
def q_newest_run_totals(spark, sf_dir):
    return runs.newest_run_totals(fx.v_run(Tables(spark, sf_dir)), "event_type", "n")


@register("a17_complete_days", """
select day from (select day, count(distinct event_type) as k from v_run
                 where day between date '2024-01-03' and date '2024-01-25' group by day) c where k = 5""",
          views=("v_run",))
def q_complete_days(spark, sf_dir):
    return runs.complete_days(fx.v_run(Tables(spark, sf_dir)), "day", "event_type", "2024-01-03",
                              "2024-01-25", n_scopes=5)


def _params_table(t):
    r = fx.v_run(t)
    return r.select(F.col("event_type").alias("task_type"), "run_id",
                    F.to_json(F.struct(F.col("n").alias("score"))).alias("metrics"),
                    F.to_json(F.struct((F.col("run_id") % 7).alias("depth"))).alias("best_params"))


_PARAMS_SQL = """p as (select event_type as task_type, run_id, json_object('score', n) as metrics,
  json_object('depth', run_id % 7) as best_params from v_run)"""


@register("a18_best_params_newest_run", f"""
with {_PARAMS_SQL}
select cast(json_extract_string(arg_max(best_params, run_id), '$.depth') as int) as depth,
  cast(max(run_id) as double) as chosen_by from p where task_type = 'click'""", views=("v_run",))
def q_best_params(spark, sf_dir):
    b = runs.best_params(_params_table(Tables(spark, sf_dir)), "click")
    return b.select(F.get_json_object("best_params", "$.depth").cast("int").alias("depth"),
                    F.col("chosen_by").cast("double").alias("chosen_by"))


@register("a18_best_params_by_metric", f"""
with {_PARAMS_SQL},
q as (select best_params, cast(json_extract_string(metrics, '$.score') as double) as score, run_id
      from p where task_type = 'signup')
select (select cast(json_extract_string(best_params, '$.depth') as int) from q
        order by score desc, run_id desc limit 1) as depth,
  (select max(score) from q) as chosen_by""", views=("v_run",))
def q_best_params_metric(spark, sf_dir):
    b = runs.best_params(_params_table(Tables(spark, sf_dir)), "signup", by="score")
    return b.select(F.get_json_object("best_params", "$.depth").cast("int").alias("depth"),
                    F.col("chosen_by").cast("double").alias("chosen_by"))


def _registry(t):
    return (fx.v_run(t).where(F.col("run_id") % 4 == 0)
            .select(F.col("event_type").alias("scope"), F.col("day").alias("date")).distinct())


_REGISTRY_SQL = "reg as (select distinct event_type as scope, day as date from v_run where run_id % 4 = 0)"


@register("w9_model_validity", f"""
with {_REGISTRY_SQL}
select scope, date, lead(date) over (partition by scope order by date) as next_date from reg""",
          views=("v_run",))
def q_model_validity(spark, sf_dir):
    return runs.model_validity(_registry(Tables(spark, sf_dir)))


@register("m11_wanted_weekly_days_hours", """
with m as (select unnest(generate_series(date '1995-01-01', date '1998-12-01', interval 1 month)) as m),
w as (select distinct cast(d as date) as date from (
        select unnest(generate_series(cast(m as date), last_day(m), interval 7 day)) as d from m
        union all select last_day(m) from m) x)
select w.date, sum(v.hours) as hours from w join v_worklog v on v.timesheet_date = w.date
group by w.date""", views=("v_worklog",))
def q_wanted_days(spark, sf_dir):
    t = Tables(spark, sf_dir)
    wanted = runs.wanted_days(spark, "1995-01-01", "1998-12-31", weekly=True)
    w = fx.v_worklog(t).withColumnRenamed("timesheet_date", "date")
    return wanted.join(w, "date").groupBy("date").agg(F.sum("hours").alias("hours"))


@register("m12_missing_models", """
with w as (select distinct last_day(cast(m as date)) as date
           from (select unnest(generate_series(date '1995-01-01', date '1998-12-01', interval 1 month)) as m) x),
models as (select distinct cast(valid_to as date) as date from v_position where valid_to is not null)
select date from w where date not in (select date from models)""", views=("v_position",))
def q_missing_models(spark, sf_dir):
    t = Tables(spark, sf_dir)
    wanted = runs.wanted_days(spark, "1995-01-01", "1998-12-31")
    models = fx.v_position(t).where(F.col("valid_to").isNotNull()).select(F.col("valid_to").cast("date").alias("date"))
    return runs.missing_models(wanted, models)


@register("m13_missing_predictions", f"""
with {_REGISTRY_SQL},
iv as (select scope, date, coalesce(lead(date) over (partition by scope order by date), date '2024-01-30') as nd
       from reg),
d as (select distinct cast(unnest(generate_series(date, nd, interval 1 day)) as date) as day from iv),
done as (select day from v_run where n >= 20 group by day having count(distinct event_type) = 5)
select day from d where day not in (select day from done)""", views=("v_run",))
def q_missing_predictions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    preds = fx.v_run(t).where(F.col("n") >= 20).select(F.col("day").alias("date"),
                                                      F.col("event_type").alias("scope"))
    return runs.missing_predictions(_registry(t), preds, "2024-01-30", n_scopes=5)


@register("o7_distinct_union_days", """
select day from v_view union select cast(time as date) as day from v_proposal""",
          views=("v_view", "v_proposal"))
def q_distinct_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return runs.distinct_union(fx.v_view(t).select("day"),
                               fx.v_proposal(t).select(F.col("time").cast("date").alias("day")))


@register("o8_set_difference", """
select distinct position_id from v_proposal
where position_id not in (select entity_id from v_view where day >= date '2024-01-27')""",
          views=("v_proposal", "v_view"))
def q_set_difference(spark, sf_dir):
    t = Tables(spark, sf_dir)
    wanted = fx.v_proposal(t).select("position_id").distinct()
    done = fx.v_view(t).where(F.col("day") >= F.lit("2024-01-27").cast("date")) \
        .select(F.col("entity_id").alias("position_id"))
    return runs.set_difference(wanted, done, "position_id")


@register("a36_reconcile_levels", """
with a as (select p.country_id, sum(w.hours) as matrix_total from v_worklog w join v_position p
           on w.position_id = p.position_id where w.billable group by p.country_id),
b as (select p.country_id, sum(w.hours) as source_total from v_worklog w join v_position p
      on w.position_id = p.position_id group by p.country_id)
select coalesce(a.country_id, b.country_id) as country_id, round(a.matrix_total, 6) as matrix_total,
  round(b.source_total, 6) as source_total
from a full join b on a.country_id = b.country_id
where abs(coalesce(a.matrix_total, 0) - coalesce(b.source_total, 0)) > 1e-6""", views=("v_worklog", "v_position"))
def q_reconcile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = lk.lookup(fx.v_worklog(t), fx.v_position(t).select("position_id", "country_id"), "position_id") \
        .where(F.col("country_id").isNotNull())
    r = qa.reconcile(w.where("billable"), w, ["country_id"], "hours", "hours")
    return r.select("country_id", F.round("matrix_total", 6).alias("matrix_total"),
                    F.round("source_total", 6).alias("source_total"))


@register("a37_non_empty_report", """
select cast(sum(hours) as double) as sum_hours, cast(sum(line_no) as double) as sum_line_no from v_worklog""",
          views=("v_worklog",))
def q_non_empty(spark, sf_dir):
    return qa.non_empty_report(fx.v_worklog(Tables(spark, sf_dir)), ["hours", "line_no"])


@register("j4_duplicate_key_check", """
select position_id, count(*) as n_rows from v_worklog group by position_id having count(*) > 1""",
          views=("v_worklog",))
def q_duplicate_keys(spark, sf_dir):
    return qa.duplicate_keys(fx.v_worklog(Tables(spark, sf_dir)), "position_id")
