"""Snapshot queries: minimum slice, validity joins, active predicate, billable span."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import month_offset_class
from ..operators import snapshots as snap
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register

# Snapshot days used by the snapshot queries (one before all data, two inside it).
SLICE_DAYS = ("1990-01-01", "1996-01-01", "1998-06-01")
EXCLUDED_CUSTOMERS = (1,)
CREATED_FROM = "1995-01-01"

_DAYS_SQL = "select cast(d as date) as day from (values ('1990-01-01'), ('1996-01-01'), ('1998-06-01')) t(d)"
_ACTIVE_SQL = ("select * from v_position where staffing_status not in ('Terminated', 'On Hold', 'Closed') "
               "and billing_type_id = '1' and created >= timestamp '1995-01-01' and customer_id not in (1)")


def open_positions_by_class(days: DataFrame, positions: DataFrame, worklog: DataFrame) -> DataFrame:
    """Minimum slice: open positions on given days with the month-offset class of their
    first billable day, counted per (day, class)."""
    active = snap.active_positions(positions, created_from=CREATED_FROM,
                                   exclude_customers=EXCLUDED_CUSTOMERS)
    joined = snap.validity_join(days, active.select("position_id", "valid_from", "valid_to"))
    span = snap.billable_span(worklog).select("position_id", "first_billable_date")
    with_span = joined.join(span, "position_id", "left")
    kept = snap.before_event(with_span, "day", "first_billable_date", "either")
    return (kept.withColumn("month_class", month_offset_class("day", "first_billable_date"))
            .groupBy("day", "month_class")
            .agg(F.count("position_id").alias("n_positions")))


@register("minimum_slice_open_positions", f"""
with days as ({_DAYS_SQL}),
p as ({_ACTIVE_SQL}),
j as (select d.day, p.position_id from days d left join p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
t as (select position_id, min(timesheet_date) as first_billable_date from v_worklog where billable
      group by position_id),
k as (select j.day, j.position_id, t.first_billable_date,
        (year(t.first_billable_date) * 12 + month(t.first_billable_date)) - (year(j.day) * 12 + month(j.day)) as m
      from j left join t on j.position_id = t.position_id
      where t.first_billable_date is null or j.day < t.first_billable_date)
select day, cast(case when m between 0 and 2 then m else 3 end as int) as month_class,
  count(position_id) as n_positions
from k group by 1, 2""", views=("v_position", "v_worklog"))
def q_minimum_slice(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return open_positions_by_class(io.days(spark, SLICE_DAYS), fx.v_position(t), fx.v_worklog(t))


@register("j1_validity_join", f"""
with days as ({_DAYS_SQL})
select d.day, p.position_id, p.staffing_status, p.customer_id from days d left join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)""", views=("v_position",))
def q_validity_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pos = fx.v_position(t).select("position_id", "staffing_status", "customer_id", "valid_from", "valid_to")
    return snap.validity_join(io.days(spark, SLICE_DAYS), pos).drop("valid_from", "valid_to")


@register("j1_validity_join_many_days", """
with days as (select cast(unnest(generate_series(date '1994-12-01', date '1999-12-31', interval 1 day)) as date) as day)
select d.day, count(p.position_id) as n_open from days d left join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)
group by d.day""", views=("v_position",))
def q_validity_join_many(spark, sf_dir):
    """J1 over ~1 800 days with the broadcast bound set low: exercises the expansion path."""
    t = Tables(spark, sf_dir)
    days = io.date_series(spark, "1994-12-01", "1999-12-31", 1)
    pos = fx.v_position(t).select("position_id", "valid_from", "valid_to")
    j = snap.validity_join(days, pos)
    return j.groupBy("day").agg(F.count("position_id").alias("n_open"))


@register("j2_as_at", """
select position_id, staffing_status from v_position
where valid_from <= timestamp '1997-03-15 12:00:00'
  and (valid_to is null or timestamp '1997-03-15 12:00:00' < valid_to)""", views=("v_position",))
def q_as_at(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return snap.as_at(fx.v_position(t), "1997-03-15 12:00:00").select("position_id", "staffing_status")


@register("j3_open_workload", f"""
with days as ({_DAYS_SQL}),
w as (select country_id, planned_start_date, cast(primary_skill_id + 1 as double) as fte, valid_from, valid_to
      from v_position)
select d.day, w.country_id, sum(w.fte) as total_workload from days d join w
  on w.valid_from <= d.day and (w.valid_to is null or d.day < w.valid_to) and d.day <= w.planned_start_date
group by 1, 2""", views=("v_position",))
def q_open_workload(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = fx.v_position(t).withColumn("fte", (F.col("primary_skill_id") + 1).cast("double"))
    return snap.open_workload(io.days(spark, SLICE_DAYS), w, "country_id", "planned_start_date", "fte")


@register("p1_active_positions", f"select position_id, customer_id, staffing_status from ({_ACTIVE_SQL})",
          views=("v_position",))
def q_active(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return snap.active_positions(fx.v_position(t), created_from=CREATED_FROM,
                                 exclude_customers=EXCLUDED_CUSTOMERS
                                 ).select("position_id", "customer_id", "staffing_status")


@register("p2_same_day_of_month_series", """
with days as (select cast(unnest(generate_series(date '1998-06-30', date '1996-01-01', -interval 1 day)) as date) as day),
s as (select day from days where extract(day from day) = 15)
select s.day, count(p.position_id) as n_open from s left join v_position p
  on p.valid_from <= s.day and (p.valid_to is null or s.day < p.valid_to)
group by s.day""", views=("v_position",))
def q_same_day(spark, sf_dir):
    """S9 + P2: a backwards daily series, the days sharing the anchor's day of month,
    then open positions per day."""
    t = Tables(spark, sf_dir)
    days = io.same_day_of_month(io.date_series(spark, "1998-06-30", "1996-01-01", -1), "1998-03-15")
    j = snap.validity_join(days, fx.v_position(t).select("position_id", "valid_from", "valid_to"))
    return j.groupBy("day").agg(F.count("position_id").alias("n_open"))


def _event_modes_sql(mode_cond: str) -> str:
    return f"""
with days as ({_DAYS_SQL}),
j as (select d.day, p.position_id from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
t as (select position_id, min(timesheet_date) as first_billable_date from v_worklog where billable
      group by position_id)
select j.day, j.position_id, t.first_billable_date from j left join t on j.position_id = t.position_id
where {mode_cond}"""


def _event_modes(spark, sf_dir, mode):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, SLICE_DAYS),
                           fx.v_position(t).select("position_id", "valid_from", "valid_to"), how="inner")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", "first_billable_date")
    return snap.before_event(j.join(span, "position_id", "left"), "day", "first_billable_date", mode) \
        .select("day", "position_id", "first_billable_date")


for _mode, _cond in (("before", "j.day < t.first_billable_date"),
                     ("missing", "t.first_billable_date is null"),
                     ("either", "t.first_billable_date is null or j.day < t.first_billable_date")):
    register(f"p3_before_event_{_mode}", _event_modes_sql(_cond), views=("v_position", "v_worklog"))(
        lambda spark, sf_dir, _m=_mode: _event_modes(spark, sf_dir, _m))


@register("p4_restrict_to_keys", """
select w.position_id, w.employee_id, w.hours from v_worklog w
where w.position_id in (select position_id from v_position where staffing_status = 'Assigned')""",
          views=("v_worklog", "v_position"))
def q_restrict(spark, sf_dir):
    t = Tables(spark, sf_dir)
    keys = fx.v_position(t).where(F.col("staffing_status") == "Assigned").select("position_id")
    return snap.restrict_to(fx.v_worklog(t), keys, "position_id").select("position_id", "employee_id", "hours")


@register("p5_latest_snapshot", """
select day, run_id, event_type, n from v_run where day = (select max(day) from v_run)""", views=("v_run",))
def q_latest_snapshot(spark, sf_dir):
    return snap.latest_snapshot(fx.v_run(Tables(spark, sf_dir)), "day").select("day", "run_id", "event_type", "n")


@register("a1_billable_span", """
select position_id, min(timesheet_date) as first_billable_date, max(timesheet_date) as last_billable_date
from v_worklog where billable group by position_id""", views=("v_worklog",))
def q_billable_span(spark, sf_dir):
    return snap.billable_span(fx.v_worklog(Tables(spark, sf_dir)))


@register("w10_group_max", """
select entity_id, day, views, max(day) over (partition by entity_id) as max_date from v_view""",
          views=("v_view",))
def q_group_max(spark, sf_dir):
    return snap.with_group_max(fx.v_view(Tables(spark, sf_dir)), "entity_id", "day") \
        .select("entity_id", "day", "views", "max_date")
