"""Importance, matching and revenue-from-utilisation queries.

Fixture mapping: employees are suppliers (forecast hours derived from their keys),
a position's assignee is the smallest supplier on its order, monthly workload is the
reported hours per position and month, candidate edges are ``v_edge``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import importance as imp
from ..operators import matching as mt
from ..operators import rollups as ru
from ..operators import snapshots as snap
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register

RUN_DATE, PERIOD = "1996-02-15", "1996-03-01"


def forecast(t):
    s = t.supplier
    k = F.col("s_suppkey")
    return s.select(k.alias("employee_id"), (k % 7).cast("double").alias("reported"),
                    (100.0 + k % 60).alias("predicted"),
                    F.when(k % 5 == 0, F.lit(None).cast("double")).when(k % 5 == 2, 12.5).otherwise(0.0).alias("ext_wl"),
                    F.lit("ext").alias("model"), F.lit(RUN_DATE).cast("date").alias("run_date"),
                    F.lit(PERIOD).cast("date").alias("period"),
                    F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country"))


def positions(t):
    assignee = t.lineitem.groupBy(F.col("l_orderkey").alias("position_id")).agg(F.min("l_suppkey").alias("assignee_id"))
    return fx.v_position(t).join(assignee, "position_id", "left")


def workload(t):
    w = fx.v_worklog(t)
    return (w.groupBy("position_id", F.trunc("timesheet_date", "MM").alias("workload_start_date"))
            .agg(F.sum("hours").alias("monthly_workload"))
            .withColumn("workload_end_date", F.last_day("workload_start_date")))


def importance(spark, t):
    pos = snap.as_at(positions(t), RUN_DATE)
    open_pos = snap.active_positions(pos, closed_statuses=("Assigned", "Terminated", "On Hold", "Closed"))
    day = io.days(spark, [RUN_DATE], "day")
    active = snap.active_positions(fx.v_position(t), billing_type=None)
    per_cust = ru.active_counts(day, active, ["customer_id"]).select(
        "customer_id", F.col("number_of_positions").alias("number_of_positions_per_customer"))
    per_cont = ru.active_counts(day, active, ["container_name"]).select(
        "container_name", F.col("number_of_positions").alias("number_of_positions_per_container"))
    p = (open_pos.join(per_cust, "customer_id", "left").join(per_cont, "container_name", "left")
         .withColumn("date", F.lit(RUN_DATE).cast("date")))
    scored = imp.position_score(p)
    urg = snap.as_at(fx.v_position(t).where(F.col("position_id") % 6 != 0)
                     .select("position_id", (1.0 + (F.col("position_id") % 4) * 0.25).alias("weight_adjusted"),
                             "valid_from", "valid_to"), RUN_DATE)
    return imp.position_importance(scored, urg)


_FIX_SQL = f"""
fc as (select s_suppkey as employee_id, cast(s_suppkey % 7 as double) as reported, 100.0 + s_suppkey % 60 as predicted,
         case when s_suppkey % 5 = 0 then null when s_suppkey % 5 = 2 then 12.5 else 0.0 end as ext_wl,
         'ext' as model, date '{RUN_DATE}' as run_date, date '{PERIOD}' as period,
         'N' || cast(s_nationkey as varchar) as country from supplier),
pos as (select p.*, a.assignee_id from v_position p left join
          (select l_orderkey as position_id, min(l_suppkey) as assignee_id from lineitem group by 1) a
          on a.position_id = p.position_id),
wl as (select position_id, cast(date_trunc('month', timesheet_date) as date) as workload_start_date,
         sum(hours) as monthly_workload, last_day(date_trunc('month', timesheet_date)) as workload_end_date
       from v_worklog group by 1, 2, 4)"""

_IMP_SQL = _FIX_SQL + f""",
act as (select * from v_position where staffing_status not in ('Terminated', 'On Hold', 'Closed')
        and valid_from <= date '{RUN_DATE}' and (valid_to is null or date '{RUN_DATE}' < valid_to)),
cust as (select customer_id, count(*) as number_of_positions_per_customer from act group by 1),
cont as (select container_name, count(*) as number_of_positions_per_container from act group by 1),
op as (select p.position_id, p.created, p.planned_start_date, p.planned_end_date,
         cust.number_of_positions_per_customer, cont.number_of_positions_per_container
       from pos p left join cust on cust.customer_id = p.customer_id
       left join cont on cont.container_name = p.container_name
       where p.valid_from <= timestamp '{RUN_DATE}' and (p.valid_to is null or timestamp '{RUN_DATE}' < p.valid_to)
         and p.staffing_status not in ('Assigned', 'Terminated', 'On Hold', 'Closed') and p.billing_type_id = '1'),
d as (select *,
        cast(floor((epoch_us(planned_end_date) - epoch_us(planned_start_date)) / 86400000000) as bigint) as duration,
        cast(floor((epoch_us(timestamp '{RUN_DATE}') - epoch_us(created)) / 86400000000) as bigint) as distance_from_created,
        cast(floor((epoch_us(planned_start_date) - epoch_us(timestamp '{RUN_DATE}')) / 86400000000) as bigint)
          as time_to_planned_start_date
      from op),
disc as (select *, case when time_to_planned_start_date >= 0
          then pow(1 / (1 + 0.12 / 365), time_to_planned_start_date) * (1 - pow(1 / (1 + 0.12 / 365), greatest(duration, 0)))
               / (1 - 1 / (1 + 0.12 / 365))
          else pow(1 / (1 + 0.24 / 365), time_to_planned_start_date)
               * (1 - pow(1 / (1 + 0.24 / 365), greatest(-time_to_planned_start_date, 0))) / (1 - 1 / (1 + 0.24 / 365))
             + (1 - pow(1 / (1 + 0.12 / 365), greatest(time_to_planned_start_date + duration, 0)))
               / (1 - 1 / (1 + 0.12 / 365)) end as discounted from d),
coef as (select *,
  case when number_of_positions_per_container is null then 2.0 when number_of_positions_per_container <= 20 then 0.8
       when number_of_positions_per_container <= 50 then 1.0 when number_of_positions_per_container <= 100 then 1.2
       when number_of_positions_per_container <= 200 then 1.5 else 2.0 end as c_cont,
  case when number_of_positions_per_customer is null then 3.0 when number_of_positions_per_customer <= 50 then 0.8
       when number_of_positions_per_customer <= 100 then 1.0 when number_of_positions_per_customer <= 250 then 1.2
       when number_of_positions_per_customer <= 500 then 1.5 when number_of_positions_per_customer <= 1000 then 2.0
       else 3.0 end as c_cust,
  case when distance_from_created <= 50 then 2.0 when distance_from_created <= 100 then 1.5
       when distance_from_created <= 150 then 1.0 when distance_from_created <= 365 then 0.5 else 0.2 end as c_age
  from disc),
urg as (select position_id, 1.0 + (position_id % 4) * 0.25 as weight_adjusted from v_position
        where position_id % 6 <> 0 and valid_from <= timestamp '{RUN_DATE}'
          and (valid_to is null or timestamp '{RUN_DATE}' < valid_to)),
imp as (select coef.*, discounted * c_cont * c_cust * c_age as score, coalesce(urg.weight_adjusted, 1.0) as weight_adjusted,
          discounted * c_cont * c_cust * c_age * coalesce(urg.weight_adjusted, 1.0) as position_importance
        from coef left join urg on urg.position_id = coef.position_id)"""


@register("d15_discounted_days", "with " + _IMP_SQL + """
select position_id, duration, time_to_planned_start_date, round(discounted, 6) as discounted from disc""",
          views=("v_position", "v_worklog"))
def q_discount(spark, sf_dir):
    i = importance(spark, Tables(spark, sf_dir))
    return i.select("position_id", "duration", "time_to_planned_start_date",
                    F.round(imp.discounted_days(F.col("duration"), F.col("time_to_planned_start_date")), 6)
                    .alias("discounted"))


@register("d16_step_coefficients", "with " + _IMP_SQL + """
select position_id, c_cont, c_cust, c_age from coef""", views=("v_position", "v_worklog"))
def q_steps(spark, sf_dir):
    i = importance(spark, Tables(spark, sf_dir))
    return i.select("position_id",
                    imp.step(F.col("number_of_positions_per_container"), imp.CONTAINER_STEPS, imp.CONTAINER_TOP).alias("c_cont"),
                    imp.step(F.col("number_of_positions_per_customer"), imp.CUSTOMER_STEPS, imp.CUSTOMER_TOP).alias("c_cust"),
                    imp.step(F.col("distance_from_created"), imp.AGE_STEPS, imp.AGE_TOP).alias("c_age"))


@register("d17_position_importance", "with " + _IMP_SQL + """
select position_id, round(score, 6) as score, weight_adjusted, round(position_importance, 6) as position_importance
from imp""", views=("v_position", "v_worklog"))
def q_importance(spark, sf_dir):
    i = importance(spark, Tables(spark, sf_dir))
    return i.select("position_id", F.round("score", 6).alias("score"), "weight_adjusted",
                    F.round("position_importance", 6).alias("position_importance"))


_J16_SQL = f"""
j16 as (select fc.employee_id, fc.reported + fc.predicted as predicted_hours, fc.ext_wl, p.position_id, p.monthly_workload
        from fc left join (select pos.position_id, pos.assignee_id, wl.monthly_workload from pos
                           join wl on wl.position_id = pos.position_id
                           where pos.billing_type_id = '1' and wl.workload_start_date = date '{PERIOD}'
                             and wl.monthly_workload > 0) p on fc.employee_id = p.assignee_id)"""


@register("j16_forecast_with_positions", "with " + _FIX_SQL + "," + _J16_SQL + " select * from j16",
          views=("v_position", "v_worklog"))
def q_forecast_positions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mt.forecast_with_positions(forecast(t), positions(t), workload(t), PERIOD)


@register("q5_employee_groups", "with " + _FIX_SQL + "," + _J16_SQL + """
select 1 as grp, count(*) as n_rows, count(distinct employee_id) as n_employees from j16 where position_id is not null
union all
select 2, count(*), count(distinct employee_id) from j16 where position_id is null and (ext_wl is null or ext_wl <> 0)
union all
select 3, count(*), count(distinct employee_id) from j16 where position_id is null and coalesce(ext_wl, 0) = 0""",
          views=("v_position", "v_worklog"))
def q_groups(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g = mt.employee_groups(mt.forecast_with_positions(forecast(t), positions(t), workload(t), PERIOD))
    parts = [d.agg(F.lit(i + 1).alias("grp"), F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct("employee_id").alias("n_employees")) for i, d in enumerate(g)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("j17_positions_in_period", "with " + _FIX_SQL + f"""
select p.position_id, p.assignee_id, w.monthly_workload from pos p join wl w on w.position_id = p.position_id
where p.billing_type_id <> '1' and w.workload_start_date <= date '{PERIOD}' and w.workload_end_date >= date '{PERIOD}'
  and w.monthly_workload > 0""", views=("v_position", "v_worklog"))
def q_positions_in_period(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mt.positions_in_period(positions(t).where(F.col("billing_type_id") != "1"), workload(t), PERIOD)


@register("p13_forecast_slice", "with " + _FIX_SQL + f"""
select employee_id, predicted, country from fc where model = 'ext' and run_date = date '{RUN_DATE}'
  and period = date '{PERIOD}' and country in ('N1', 'N2', 'N3')""", views=("v_position", "v_worklog"))
def q_slice(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mt.forecast_slice(forecast(t), "ext", RUN_DATE, PERIOD, ["N1", "N2", "N3"]).select(
        "employee_id", "predicted", "country")


def _candidates(spark, t):
    e = fx.v_edge(t)
    return e.join(importance(spark, t).select("position_id", "position_importance"), "position_id", "inner")


@register("j21_greedy_match")
def q_greedy(spark, sf_dir):
    """Rows-only: iterative; checked against a sequential pass in the unit tests."""
    return mt.greedy_match(_candidates(spark, Tables(spark, sf_dir)))


def _m14(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mt.revenue_from_utilization(forecast(t), positions(t), workload(t), importance(spark, t), fx.v_edge(t),
                                       PERIOD, RUN_DATE)


@register("m14_revenue_from_utilization")
def q_m14(spark, sf_dir):
    return mt.placed_only(_m14(spark, sf_dir))


@register("a38_placement_summary")
def q_placement(spark, sf_dir):
    return mt.placement_summary(_m14(spark, sf_dir))


#: Both periods of a run: its next month and the month after.
PERIODS = (PERIOD, "1996-04-01")


@register("m14_both_periods")
def q_both_periods(spark, sf_dir):
    """Rows-only: M14 for both periods of a run, each on its own slice of the forecast."""
    t = Tables(spark, sf_dir)
    rows = forecast(t)
    later = rows.withColumn("period", F.lit(PERIODS[1]).cast("date")).withColumn("predicted", F.col("predicted") * 0.9)
    every = rows.unionByName(later)
    parts = [mt.revenue_from_utilization(mt.forecast_slice(every, "ext", RUN_DATE, p), positions(t), workload(t), importance(spark, t),
                                         fx.v_edge(t), p, RUN_DATE) for p in PERIODS]
    return mt.placed_only(parts[0].unionByName(parts[1]))
