"""History queries: events, running counts, as-of reads, trailing / peak / growth views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ratios
from ..functions.dates import days_between
from ..operators import history as hist
from ..operators import snapshots as snap
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register

_SNAPS_SQL = "snaps as (select distinct position_id, cast(time as date) as day from v_proposal)"

# Status → running-count column of the proposal history.
STATUS_COLUMNS = {
    "rejected_proposals": "Rejected",
    "cancelled_proposals": "Cancelled",
    "proposed_proposals": "Proposed",
    "booked_proposals": "Booked",
    "onboarding_proposals": "Onboarding",
    "preselected_proposals": "Preselected",
}


def _snaps(t):
    return fx.v_proposal(t).select("position_id", F.col("time").cast("date").alias("day")).distinct()


def _views(t):
    return fx.v_view(t).withColumnRenamed("entity_id", "position_id")


@register("a2_daily_views", """
select user_id as entity_id, cast(ts as date) as day, event_type, count(*) as views from events
group by 1, 2, 3""")
def q_daily_views(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumnRenamed("user_id", "entity_id")
    return hist.daily_counts(e, "entity_id", "ts", ["event_type"])


@register("w1_first_event", """
select position_id, staffing_status, time, proposal_id from (
  select *, row_number() over (partition by position_id, staffing_status
                               order by time asc nulls last, proposal_id asc nulls first) as rn from v_proposal) q
where rn = 1""", views=("v_proposal",))
def q_first_event(spark, sf_dir):
    return hist.first_event(fx.v_proposal(Tables(spark, sf_dir)), ["position_id", "staffing_status"], "time",
                            ["time", "proposal_id"])


@register("w2_last_event", """
select position_id, staffing_status, time, proposal_id from (
  select *, row_number() over (partition by position_id, staffing_status
                               order by time desc nulls first, proposal_id desc nulls last) as rn from v_proposal) q
where rn = 1""", views=("v_proposal",))
def q_last_event(spark, sf_dir):
    return hist.last_event(fx.v_proposal(Tables(spark, sf_dir)), ["position_id", "staffing_status"], "time",
                           ["time", "proposal_id"])


@register("w3_days_since_first_booking", f"""
with {_SNAPS_SQL},
f as (select position_id, min(time) as first_booking_date from v_proposal where staffing_status = 'Booked'
      group by position_id)
select s.position_id, s.day, f.first_booking_date,
  case when cast(s.day as timestamp) > f.first_booking_date
       then cast(floor((epoch_us(cast(s.day as timestamp)) - epoch_us(f.first_booking_date)) / 86400000000) as bigint)
       else 0 end as time_from_first_booking
from snaps s left join f on s.position_id = f.position_id""", views=("v_proposal",))
def q_days_since(spark, sf_dir):
    t = Tables(spark, sf_dir)
    booked = fx.v_proposal(t).where(F.col("staffing_status") == "Booked")
    first = hist.first_event(booked, "position_id", "time", ["time"])
    return hist.days_since(_snaps(t), first, "position_id", "day", "time", "first_booking")


@register("w4_running_status_counts", """
with s as (select distinct position_id, cast(time as date) as day from v_proposal),
c as (select s.position_id, s.day,
        count(*) filter (where p.staffing_status = 'Rejected') as rejected_proposals,
        count(*) filter (where p.staffing_status = 'Cancelled') as cancelled_proposals,
        count(*) filter (where p.staffing_status = 'Proposed') as proposed_proposals,
        count(*) filter (where p.staffing_status = 'Booked') as booked_proposals,
        count(*) filter (where p.staffing_status = 'Onboarding') as onboarding_proposals,
        count(*) filter (where p.staffing_status = 'Preselected') as preselected_proposals
      from s join v_proposal p on p.position_id = s.position_id and cast(p.time as date) <= s.day
      group by 1, 2)
select *, rejected_proposals + cancelled_proposals + proposed_proposals + booked_proposals
  + onboarding_proposals + preselected_proposals as total_proposals_changes from c""", views=("v_proposal",))
def q_running_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return hist.running_status_counts(_snaps(t), fx.v_proposal(t), "position_id", "day", "time",
                                      "staffing_status", STATUS_COLUMNS)


@register("w11_event_ordinal", """
select proposal_id, position_id, row_number() over (partition by position_id order by time, proposal_id) as ordinal
from v_proposal""", views=("v_proposal",))
def q_ordinal(spark, sf_dir):
    p = fx.v_proposal(Tables(spark, sf_dir))
    return hist.event_ordinal(p, "position_id", "time", "proposal_id").select("proposal_id", "position_id", "ordinal")


@register("j20_asof_last_views", f"""
with {_SNAPS_SQL},
m as (select s.position_id, s.day, max(v.day) as vday from snaps s
      left join v_view v on v.entity_id = s.position_id and v.day <= s.day group by 1, 2)
select m.position_id, m.day, v.views from m left join v_view v on v.entity_id = m.position_id and v.day = m.vday""",
          views=("v_proposal", "v_view"))
def q_asof(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return hist.asof(_snaps(t), _views(t), "position_id", "day", ["views"])


@register("a3_proposal_counts", """
select position_id, cast(time as date) as day,
  count(*) filter (where staffing_status = 'Proposed') as proposed_total_current_proposals,
  count(*) filter (where staffing_status = 'Booked') as booked_total_current_proposals,
  count(*) filter (where staffing_status = 'Onboarding') as onboarding_total_current_proposals,
  count(*) filter (where staffing_status = 'Preselected') as preselected_total_current_proposals,
  count(*) as total_total,
  count(*) filter (where applicant = 'external' and staffing_status = 'Proposed') as proposed_external_current_proposals,
  count(*) filter (where applicant = 'external' and staffing_status = 'Booked') as booked_external_current_proposals,
  count(*) filter (where applicant = 'external' and staffing_status = 'Onboarding') as onboarding_external_current_proposals,
  count(*) filter (where applicant = 'external' and staffing_status = 'Preselected') as preselected_external_current_proposals,
  count(*) filter (where applicant = 'external') as total_external,
  count(*) filter (where applicant = 'internal' and staffing_status = 'Proposed') as proposed_internal_current_proposals,
  count(*) filter (where applicant = 'internal' and staffing_status = 'Booked') as booked_internal_current_proposals,
  count(*) filter (where applicant = 'internal' and staffing_status = 'Onboarding') as onboarding_internal_current_proposals,
  count(*) filter (where applicant = 'internal' and staffing_status = 'Preselected') as preselected_internal_current_proposals,
  count(*) filter (where applicant = 'internal') as total_internal
from v_proposal group by 1, 2""", views=("v_proposal",))
def q_proposal_counts(spark, sf_dir):
    p = fx.v_proposal(Tables(spark, sf_dir)).withColumn("day", F.col("time").cast("date"))
    return hist.proposal_counts(p, "position_id", "day")


def _bd_back_sql(d: str, n: int) -> str:
    """DuckDB twin of ``subtract_business_days``."""
    wd0 = f"(isodow({d}) - 1)"
    rolled = f"(case when {wd0} >= 5 then {d} + cast(7 - {wd0} as integer) else {d} end)"
    w, r = divmod(n, 5)
    return (f"cast({rolled} - cast({7 * w + r} + case when {r} > (isodow({rolled}) - 1) then 2 else 0 end "
            f"as integer) as date)")


@register("w5_trailing_views", f"""
with {_SNAPS_SQL},
s2 as (select position_id, day, {_bd_back_sql('day', 5)} as prev_day from snaps),
t as (select s2.position_id, s2.day,
        coalesce((select sum(views) from v_view v where v.entity_id = s2.position_id and v.day <= s2.day), 0) as td,
        coalesce((select sum(views) from v_view v where v.entity_id = s2.position_id and v.day <= s2.prev_day), 0) as tb
      from s2)
select position_id, day, td - tb as last_5_days_views,
  coalesce(case when td = 0 then null else (td - tb) * 1.0 / td end, 0) as last_5_days_views_div_total_prev_views
from t""", views=("v_proposal", "v_view"))
def q_trailing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return hist.trailing_views(_snaps(t), _views(t), "position_id", 5)


@register("w6_peak_day_asof", f"""
with {_SNAPS_SQL},
b as (select s.position_id, s.day, sum(v.views) as total_prev_views,
        arg_max(v.day, v.views * 100000 - (v.day - date '2000-01-01')) as date_of_max_views
      from snaps s left join v_view v on v.entity_id = s.position_id and v.day <= s.day group by 1, 2)
select b.position_id, b.day,
  case when b.total_prev_views is null then null else b.date_of_max_views end as date_of_max_views,
  coalesce(b.total_prev_views, 0) as total_prev_views, coalesce(v.views, 0) as views,
  coalesce(case when coalesce(b.total_prev_views, 0) = 0 then null
                else coalesce(v.views, 0) * 100.0 / b.total_prev_views end, 0) as daily_views_div_total_prev_views
from b left join v_view v on v.entity_id = b.position_id and v.day = b.day""", views=("v_proposal", "v_view"))
def q_peak(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return hist.peak_day_asof(_snaps(t), _views(t), "position_id")


@register("w7_weekly_growth_asof", f"""
with {_SNAPS_SQL},
wk as (select entity_id, date_trunc('week', day) as week, sum(views) as week_views from v_view group by 1, 2),
r as (select entity_id, cast(week as date) as week, week_views,
        week_views * 1.0 / lag(week_views) over (partition by entity_id order by week) as ratio from wk),
best as (select s.position_id, s.day,
           arg_max(struct_pack(ratio := r.ratio, week := r.week, v := r.week_views),
                   r.ratio * 1e9 - (r.week - date '2000-01-01')) as b
         from snaps s join r on r.entity_id = s.position_id and r.week < s.day and r.ratio is not null
         group by 1, 2),
tot as (select s.position_id, s.day, coalesce(sum(v.views), 0) as total_views from snaps s
        left join v_view v on v.entity_id = s.position_id and v.day <= s.day group by 1, 2)
select tot.position_id, tot.day,
  case when best.b.ratio >= 1 then best.b.ratio end as growth_ratio,
  case when best.b.ratio >= 1 then best.b.week end as growth_week,
  case when best.b.ratio >= 1 then best.b.v else 0 end as best_week_views,
  tot.total_views,
  coalesce(case when (case when best.b.ratio >= 1 then best.b.v else 0 end) + tot.total_views = 0 then null
       else tot.total_views * 100.0 / ((case when best.b.ratio >= 1 then best.b.v else 0 end) + tot.total_views) end, 0)
    as weekly_view_div_total_prev_views,
  cast(date_trunc('week', tot.day) as date) as snapshot_week
from tot left join best on best.position_id = tot.position_id and best.day = tot.day""",
          views=("v_proposal", "v_view"))
def q_weekly_growth(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return hist.best_weekly_growth_asof(_snaps(t), _views(t), "position_id")


@register("w8_version_growth_asof", f"""
with {_SNAPS_SQL},
wk as (select entity_id, cast(date_trunc('week', day) as date) as week, cast(min(views) as double) as vmin,
         cast(max(views) as double) as vmax from v_view group by 1, 2),
best as (select s.position_id, s.day,
           arg_max(struct_pack(g := wk.vmax / wk.vmin, week := wk.week, vmin := wk.vmin, vmax := wk.vmax),
                   (wk.vmax / wk.vmin) * 1e9 - (wk.week - date '2000-01-01')) as b
         from snaps s join wk on wk.entity_id = s.position_id and wk.week < s.day group by 1, 2)
select s.position_id, s.day, best.b.g as version_growth, best.b.week as growth_week,
  best.b.vmin as version_min, best.b.vmax as version_max,
  coalesce(cast(v.views as double), 0.0) as current_version,
  coalesce(case when coalesce(v.views, 0) = 0 then null
                else (best.b.vmax - best.b.vmin) / v.views end, 0) as max_growth_per_week_div_current_version
from snaps s join best on best.position_id = s.position_id and best.day = s.day
left join v_view v on v.entity_id = s.position_id and v.day = s.day
where best.b.g >= 1
union all
select s.position_id, s.day, null, null, null, null, null, null from snaps s
where not exists (select 1 from best where best.position_id = s.position_id and best.day = s.day and best.b.g >= 1)""",
          views=("v_proposal", "v_view"))
def q_version_growth(spark, sf_dir):
    t = Tables(spark, sf_dir)
    versions = _views(t).withColumnRenamed("views", "version")
    return hist.best_version_growth_asof(_snaps(t), versions, "position_id")


_SNAP_POS_SQL = """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1998-06-01')) t(d)),
j as (select d.day, p.* from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to))"""


def _snap_positions(spark, t):
    return snap.validity_join(io.days(spark, ["1996-01-01", "1998-06-01"]), fx.v_position(t), how="inner")


def _fd(a: str, b: str) -> str:
    return f"cast(floor((epoch_us(cast({b} as timestamp)) - epoch_us(cast({a} as timestamp))) / 86400000000) as bigint)"


@register("d11_distance_features", _SNAP_POS_SQL + f"""
, x as (select position_id, day, created, planned_start_date, {_fd('created', 'planned_end_date')} as planned_staffing_period
       from j)
select position_id, day,
  case when cast(day as timestamp) >= created then {_fd('created', 'day')} else 0 end as time_from_created,
  case when cast(day as timestamp) >= created then {_fd('created', 'planned_start_date')} else 0 end
    as time_from_created_to_planned_start,
  coalesce(case when planned_staffing_period = 0 then null else
    (case when cast(day as timestamp) >= created then {_fd('created', 'day')} else 0 end) * 100.0
     / planned_staffing_period end, 0) as time_from_created_div_planned_staffing_period,
  coalesce(case when planned_staffing_period = 0 then null else
    (case when cast(day as timestamp) >= created then {_fd('created', 'planned_start_date')} else 0 end) * 100.0
     / planned_staffing_period end, 0) as time_from_created_to_planned_start_div_planned_staffing_period
from x""", views=("v_position",))
def q_distance(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = _snap_positions(spark, t).withColumn("planned_staffing_period",
                                             days_between("created", "planned_end_date"))
    out = hist.distance_features(j, "created", denominators=["planned_staffing_period"])
    return out.select("position_id", "day", "time_from_created", "time_from_created_to_planned_start",
                      "time_from_created_div_planned_staffing_period",
                      "time_from_created_to_planned_start_div_planned_staffing_period")


def _r(num: str, den: str) -> str:
    return f"coalesce(case when {den} = 0 then null else {num} * 100.0 / {den} end, 0) as {num}_div_{den}"


@register("d12_time_relation_ratios", _SNAP_POS_SQL + f"""
, x as (select position_id, day,
          {_fd('created', 'day')} as time_after_creation,
          {_fd('created', 'planned_end_date')} as planned_staffing_period,
          {_fd('day', 'planned_start_date')} as time_to_planned_start_date,
          {_fd('valid_from', 'coalesce(valid_to, planned_end_date)')} as proj_duration,
          {_fd('planned_start_date', 'planned_end_date')} as planned_position_period,
          {_fd('day', 'planned_end_date')} as time_to_planned_end_date
        from j)
select position_id, day, {_r('time_to_planned_start_date', 'time_after_creation')},
  {_r('time_after_creation', 'planned_staffing_period')}, {_r('time_to_planned_start_date', 'planned_staffing_period')},
  {_r('planned_staffing_period', 'proj_duration')}, {_r('planned_position_period', 'proj_duration')},
  {_r('time_to_planned_end_date', 'proj_duration')}
from x""", views=("v_position",))
def q_time_ratios(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = _snap_positions(spark, t).select(
        "position_id", "day",
        days_between("created", "day").alias("time_after_creation"),
        days_between("created", "planned_end_date").alias("planned_staffing_period"),
        days_between("day", "planned_start_date").alias("time_to_planned_start_date"),
        days_between("valid_from", F.coalesce("valid_to", "planned_end_date")).alias("proj_duration"),
        days_between("planned_start_date", "planned_end_date").alias("planned_position_period"),
        days_between("day", "planned_end_date").alias("time_to_planned_end_date"))
    out = ratios.time_relation_ratios(j)
    keep = [c for c in out.columns if c.endswith(tuple(f"_div_{d}" for _, d in ratios.TIME_RELATION_PAIRS))]
    return out.select("position_id", "day", *keep)


@register("d13_assignment_ratios", _SNAP_POS_SQL + f"""
, x as (select position_id, day,
          {_fd('valid_from', 'coalesce(valid_to, planned_end_date)')} as proj_duration,
          {_fd('valid_from', 'planned_start_date')} as start_pos_in_proj,
          {_fd('valid_from', 'planned_end_date')} as end_pos_in_proj,
          {_fd('created', 'planned_end_date')} as planned_staffing_period
        from j)
select position_id, day, {_r('start_pos_in_proj', 'proj_duration')}, {_r('end_pos_in_proj', 'proj_duration')},
  {_r('planned_staffing_period', 'proj_duration')}
from x""", views=("v_position",))
def q_assignment_ratios(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = _snap_positions(spark, t).select(
        "position_id", "day",
        days_between("valid_from", F.coalesce("valid_to", "planned_end_date")).alias("proj_duration"),
        days_between("valid_from", "planned_start_date").alias("start_pos_in_proj"),
        days_between("valid_from", "planned_end_date").alias("end_pos_in_proj"),
        days_between("created", "planned_end_date").alias("planned_staffing_period"))
    out = ratios.assignment_ratios(j)
    return out.select("position_id", "day", *[c for c in out.columns if "_div_" in c])
