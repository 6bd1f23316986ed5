"""Hour-movement queries over ``v_snap`` (three snapshots of the time entries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_offset_class
from ..operators import movement as mv
from ..operators import snapshots as snap
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register

SNAPS = (1, 2, 3)


def entries(t):
    """v_snap with the project / account / billing-type attributes used by the buckets."""
    i = F.col("id")
    return (fx.v_snap(t)
            .withColumn("project_uid_projection", F.when(i % 10 == 0, "npa").when(i % 10 == 1, "vac")
                        .otherwise(F.concat(F.lit("P"), (i % 7).cast("string"))))
            .withColumn("account", F.when(i % 7 == 3, "OWN").otherwise(F.concat(F.lit("ACC"), (i % 4).cast("string"))))
            .withColumn("billing_type_name", F.when(i % 5 == 0, "On Training").when(i % 5 == 1, "Temporary")
                        .otherwise("Regular"))
            .withColumn("person", (i / 1000).cast("long")))


_ENTRIES_SQL = """
e as (select *, case when id % 10 = 0 then 'npa' when id % 10 = 1 then 'vac' else 'P' || cast(id % 7 as varchar) end
        as project_uid_projection,
        case when id % 7 = 3 then 'OWN' else 'ACC' || cast(id % 4 as varchar) end as account,
        case when id % 5 = 0 then 'On Training' when id % 5 = 1 then 'Temporary' else 'Regular' end as billing_type_name,
        id // 1000 as person
      from v_snap),
b as (select *, case when project_uid_projection = 'npa' then 'NPA' when project_uid_projection = 'vac' then 'VAC'
                     else account end as bucket,
        case when project_uid_projection = 'vac' then 'Acc_vac' when billable then 'Acc_bill'
             when project_uid_projection = 'npa' or billing_type_name = 'On Training' then 'Acc_npa'
             when account = 'OWN' and billing_type_name = 'Temporary' then 'OWN_npa' else 'Acc_nonbill' end
          as billing_bucket
      from e)"""


@register("j18_membership_both", """
select a.snap, a.id, a.billable, a.hours from v_snap a
semi join (select id, billable from v_snap where snap = 2) b on b.id = a.id and b.billable = a.billable
where a.snap = 1""",
          views=("v_snap",))
def q_both(spark, sf_dir):
    return mv.membership(fx.v_snap(Tables(spark, sf_dir)), 1, 2, "both").select("snap", "id", "billable", "hours")


@register("j18_membership_a_not_b", """
select a.snap, a.id, a.billable, a.hours from v_snap a
anti join (select id, billable from v_snap where snap = 3) b on b.id = a.id and b.billable = a.billable
where a.snap = 2""",
          views=("v_snap",))
def q_a_not_b(spark, sf_dir):
    return mv.membership(fx.v_snap(Tables(spark, sf_dir)), 2, 3, "a_not_b").select("snap", "id", "billable", "hours")


@register("j19_pivot_snapshots", """
select billable, id % 10 as k, sum(hours) filter (where snap = 1) as snap_1, sum(hours) filter (where snap = 2) as snap_2,
  sum(hours) filter (where snap = 3) as snap_3 from v_snap group by 1, 2""", views=("v_snap",))
def q_pivot(spark, sf_dir):
    d = fx.v_snap(Tables(spark, sf_dir)).withColumn("k", F.col("id") % 10)
    return mv.pivot_snapshots(d, ["billable", "k"], SNAPS)


def _movement_sql(corr: bool) -> str:
    c = ""
    if corr:
        c = """,
corr as (select f.billable, sum(f.hours) as c from v_snap f
         where f.snap = (select min(snap) from v_snap) and exists (select 1 from v_snap l
           where l.snap = (select max(snap) from v_snap) and l.id = f.id and l.billable = f.billable)
         group by f.billable)"""
    kept = "m.kept_hours - coalesce(corr.c, 0.0)" if corr else "m.kept_hours"
    return f"""with pairs as (select snap, lead(snap) over (order by snap) as next_snap from (select distinct snap from v_snap) s),
m as (select p.snap, p.next_snap, f.billable,
        coalesce(sum(a.hours) filter (where exists (select 1 from v_snap b where b.snap = p.next_snap and b.id = a.id
                                                    and b.billable = a.billable)), 0.0) as kept_hours,
        coalesce(sum(a.hours) filter (where not exists (select 1 from v_snap b where b.snap = p.next_snap
                                                        and b.id = a.id and b.billable = a.billable)), 0.0) as cancelled_hours
      from pairs p cross join (select true as billable union all select false) f
      join v_snap a on a.snap = p.snap and a.billable = f.billable
      where p.next_snap is not null group by 1, 2, 3),
n as (select p.snap, p.next_snap, b.billable, sum(b.hours) as new_hours from pairs p join v_snap b on b.snap = p.next_snap
      where p.next_snap is not null and not exists (select 1 from v_snap a where a.snap = p.snap and a.id = b.id
                                                    and a.billable = b.billable)
      group by 1, 2, 3){c}
select m.snap, m.next_snap, m.billable, round({kept}, 6) as kept_hours, round(m.cancelled_hours, 6) as cancelled_hours,
  round(coalesce(n.new_hours, 0.0), 6) as new_hours
from m left join n on n.snap = m.snap and n.next_snap = m.next_snap and n.billable = m.billable
{"left join corr on corr.billable = m.billable" if corr else ""}"""


def _rounded(df):
    return df.select("snap", "next_snap", "billable",
                     *[F.round(c, 6).alias(c) for c in ("kept_hours", "cancelled_hours", "new_hours")])


@register("a31_hour_movement", _movement_sql(False), views=("v_snap",))
def q_movement(spark, sf_dir):
    return _rounded(mv.hour_movement(fx.v_snap(Tables(spark, sf_dir))))


@register("a31_hour_movement_corrected", _movement_sql(True), views=("v_snap",))
def q_movement_corr(spark, sf_dir):
    return _rounded(mv.hour_movement(fx.v_snap(Tables(spark, sf_dir)), corr=True))


@register("a31_movement_edges", """
with mm as (""" + _movement_sql(False).replace("with pairs", "with pairs", 1) + """)
select cast(snap as varchar) || ' ' || case when billable then 'billable' else 'non billable' end as source,
  cast(next_snap as varchar) || ' ' || case when billable then 'billable' else 'non billable' end as target,
  kept_hours as value from mm
union all
select cast(snap as varchar) || ' ' || case when billable then 'billable' else 'non billable' end, 'cancelled',
  cancelled_hours from mm
union all
select 'new', cast(next_snap as varchar) || ' ' || case when billable then 'billable' else 'non billable' end,
  new_hours from mm""", views=("v_snap",))
def q_edges(spark, sf_dir):
    return mv.movement_edges(_rounded(mv.hour_movement(fx.v_snap(Tables(spark, sf_dir)))))


@register("a30_hours_by_bucket", f"""
with {_ENTRIES_SQL}
select bucket, billable, billing_bucket, round(sum(hours) filter (where snap = 1), 6) as snap_1,
  round(sum(hours) filter (where snap = 2), 6) as snap_2, round(sum(hours) filter (where snap = 3), 6) as snap_3
from b group by 1, 2, 3""", views=("v_snap",))
def q_buckets(spark, sf_dir):
    out = mv.hours_by_bucket(entries(Tables(spark, sf_dir)), SNAPS)
    return out.select("bucket", "billable", "billing_bucket", *[F.round(f"snap_{s}", 6).alias(f"snap_{s}") for s in SNAPS])


@register("a32_split_days", f"""
with {_ENTRIES_SQL}
select person, snap, count(distinct (billable, bucket)) as n_groups from b group by 1, 2
having count(distinct (billable, bucket)) > 1""", views=("v_snap",))
def q_split_days(spark, sf_dir):
    return mv.split_days(mv.with_buckets(entries(Tables(spark, sf_dir))), "person", "snap")


_OUTCOME_STATUSES = ("Assigned", "Proposed", "Open", "On Hold", "Closed")


@register("a33_outcome_by_snapshot", """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1997-01-01'), ('1998-06-01')) t(d)),
j as (select d.day, p.position_id, p.staffing_status from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
t as (select position_id, min(timesheet_date) as f from v_worklog where billable group by 1),
k as (select j.*, (year(t.f) * 12 + month(t.f)) - (year(j.day) * 12 + month(j.day)) as m
      from j left join t on t.position_id = j.position_id)
select day, count(*) as n_rows,
  count(*) filter (where (case when m between 0 and 2 then m else 3 end) = 0) as class_0,
  count(*) filter (where (case when m between 0 and 2 then m else 3 end) = 1) as class_1,
  count(*) filter (where (case when m between 0 and 2 then m else 3 end) = 2) as class_2,
  count(*) filter (where (case when m between 0 and 2 then m else 3 end) = 3) as class_3,
  count(*) filter (where staffing_status = 'Assigned') as status_assigned,
  count(*) filter (where staffing_status = 'Proposed') as status_proposed,
  count(*) filter (where staffing_status = 'Open') as status_open,
  count(*) filter (where staffing_status = 'On Hold') as status_on_hold,
  count(*) filter (where staffing_status = 'Closed') as status_closed
from k group by day""", views=("v_position", "v_worklog"))
def q_outcome(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, ["1996-01-01", "1997-01-01", "1998-06-01"]),
                           fx.v_position(t).select("position_id", "staffing_status", "valid_from", "valid_to"),
                           how="inner")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", "first_billable_date")
    k = j.join(span, "position_id", "left").withColumn("month_class",
                                                         month_offset_class("day", "first_billable_date"))
    return mv.outcome_by_snapshot(k, "day", "month_class", "staffing_status", statuses=_OUTCOME_STATUSES)


@register("p15_pick_snapshots", """
with d as (select distinct day from v_view)
select day from d where (date_trunc('month', day) = date '2023-12-01')
  or (extract(day from day) = 1 and day > date '2023-12-01') or day = (select max(day) from d)""", views=("v_view",))
def q_pick(spark, sf_dir):
    d = fx.v_view(Tables(spark, sf_dir)).select("day").distinct()
    return mv.pick_snapshots(d, "2023-11-05")
