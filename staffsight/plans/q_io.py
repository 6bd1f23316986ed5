"""Source / sink, scalar date feature and ordering queries."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from ..functions.dates import days_between, iso_year_week, period_bounds, week_start
from ..operators import lifecycle as lc
from ..operators import position_features as pf
from ..operators import snapshots as snap
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register


def _scratch(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location (never a local temp)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/staffsight-{name}-{uuid.uuid4().hex}"


@register("s1_parameterised_sql", """
select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from orders
where o_orderdate >= timestamp '1996-01-01' and o_orderstatus = 'F' group by 1""")
def q_sql(spark, sf_dir):
    t = Tables(spark, sf_dir)
    view = f"orders_{uuid.uuid4().hex[:8]}"
    t.orders.createOrReplaceTempView(view)
    return io.sql_query(spark, f"""select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total
                                   from {view} where o_orderdate >= :since and o_orderstatus = :status
                                   group by o_orderpriority""",
                        since=dt.datetime(1996, 1, 1), status="F")


@register("s2_pruned_read", """
select l_orderkey, l_quantity from lineitem where l_shipdate >= timestamp '1998-01-01' and l_quantity > 45""")
def q_read(spark, sf_dir):
    return io.read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"],
                         (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 45))


@register("s3_append_run", """
with c as (select day as date, cast(sum(n) as bigint) as events from v_run group by 1)
select date, events, cast(1700000000 as bigint) as run_id, timestamp '2023-11-14 22:13:20' as date_of_processing from c
union all select date, events + 1, 1700000100, timestamp '2023-11-14 22:15:00' from c where events % 2 = 0""", views=("v_run",))
def q_append(spark, sf_dir):
    """Two runs of a daily counter, the first of them tried twice: each is seen once."""
    t = Tables(spark, sf_dir)
    path = _scratch(spark, "append")
    counts = fx.v_run(t).groupBy(F.col("day").alias("date")).agg(F.sum("n").alias("events"))
    lc.publish_run(counts.withColumn("events", F.col("events") * 100), path, run_id=1_700_000_000)
    lc.publish_run(counts.where("events % 2 = 0").withColumn("events", F.col("events") + 1), path, run_id=1_700_000_100)
    lc.publish_run(counts, path, run_id=1_700_000_000)
    rows = lc.read_runs(spark, path)
    return rows.select(F.col("date").cast("date").alias("date"), "events", "run_id",
                       F.col("date_of_processing").cast("timestamp_ntz").alias("date_of_processing"))


@register("s4_run_log", """
select cast(run_id as bigint) as run_id, cast(min(day) as timestamp) as start_time, cast(max(day) as timestamp) as end_time, '1.0' as code_version,
  'events=' || cast(cast(sum(n) as bigint) as varchar) as comment, sum(n) > 1 as success, event_type as task_type
from v_run group by run_id, event_type""", views=("v_run",))
def q_run_log(spark, sf_dir):
    """A log row per run and task of the runs table; a failed first attempt of each is superseded."""
    t = Tables(spark, sf_dir)
    path = _scratch(spark, "runlog")
    rows = fx.v_run(t).groupBy("run_id", F.col("event_type").alias("task_type")).agg(
        F.min("day").cast("timestamp").alias("start_time"), F.max("day").cast("timestamp").alias("end_time"),
        F.lit("1.0").alias("code_version"), F.concat(F.lit("events="), F.sum("n").cast("string")).alias("comment"),
        (F.sum("n") > 1).alias("success")).withColumn("run_id", F.col("run_id").cast("long"))
    first = rows.withColumns({"end_time": F.col("start_time") - F.expr("interval 1 hour"), "success": F.lit(False), "comment": F.lit("failed")})
    lc.log_rows(first, path)
    lc.log_rows(rows, path)
    log = lc.read_log(spark, path)
    return log.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


@register("s5_snapshot_roundtrip", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders""")
def q_roundtrip(spark, sf_dir):
    """Dump the orders as CSV and read them back with a schema."""
    t = Tables(spark, sf_dir)
    path = _scratch(spark, "snapshot")
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    io.save_snapshot(df, path, fmt="csv")
    return io.load_snapshot(spark, path, fmt="csv", schema=df.schema)


@register("s6_evolve_result", """
select o_orderkey, o_orderstatus, o_totalprice * 2 as doubled from orders where not (o_orderpriority = '5-LOW')""")
def q_evolve(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    out = io.evolve(o, add={"doubled": F.col("o_totalprice") * 2}, drop=["o_totalprice"],
                    delete_where=F.col("o_orderpriority") == "5-LOW")
    return out.drop("o_orderpriority")


@register("s7_run_id_to_timestamp", """
select distinct run_id, to_timestamp(run_id * 1000000 + 1500000000) :: timestamp as date_of_processing from v_run""",
          views=("v_run",))
def q_run_ts(spark, sf_dir):
    r = fx.v_run(Tables(spark, sf_dir)).select("run_id").distinct()
    r = r.withColumn("__s", F.col("run_id") * 1_000_000 + 1_500_000_000)
    out = io.run_id_to_timestamp(r, "__s").select("run_id", F.col("date_of_processing").cast("timestamp_ntz")
                                                  .alias("date_of_processing"))
    return out


@register("s8_day_list_counts", """
with days as (select cast(d as date) as day from (values ('1995-06-01'), ('1996-06-01'), ('1997-06-01'),
                                                         ('1998-06-01')) t(d))
select d.day, count(p.position_id) as n_open from days d left join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to) group by 1""", views=("v_position",))
def q_days(spark, sf_dir):
    d = io.days(spark, ["1998-06-01", "1995-06-01", "1997-06-01", "1996-06-01"])
    j = snap.validity_join(d, fx.v_position(Tables(spark, sf_dir)).select("position_id", "valid_from", "valid_to"))
    return j.groupBy("day").agg(F.count("position_id").alias("n_open"))


@register("s9_weekly_series_back", """
with m as (select max(o_orderdate) as m from orders),
days as (select cast(unnest(generate_series(m.m, m.m - interval 182 day, -interval 7 day)) as date) as day from m)
select d.day, count(p.position_id) as n_open from days d left join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to) group by 1""", views=("v_position",))
def q_series_back(spark, sf_dir):
    """Weekly snapshot days walking half a year back from the newest order day."""
    t = Tables(spark, sf_dir)
    newest = t.orders.agg(F.max("o_orderdate").alias("m"))
    d = io.date_series_between(newest, F.col("m"), F.date_sub(F.col("m"), 182), -7)
    j = snap.validity_join(d, fx.v_position(t).select("position_id", "valid_from", "valid_to"))
    return j.groupBy("day").agg(F.count("position_id").alias("n_open"))


@register("o2_latest_proposal_per_position", """
select position_id, time as last_time, proposal_id as last_proposal_id, staffing_status as last_status from (
  select *, row_number() over (partition by position_id order by time desc, proposal_id desc) as rn from v_proposal)
where rn = 1""", views=("v_proposal",))
def q_top1(spark, sf_dir):
    """O2: top-1 row per group by (time, id) descending. Written as ``max`` of a struct — an
    aggregate with a map-side partial step — so a position holding a large share of the
    rows is reduced in every task before the shuffle instead of sorted in one."""
    p = fx.v_proposal(Tables(spark, sf_dir))
    best = F.max(F.struct("time", "proposal_id", "staffing_status")).alias("b")
    return p.groupBy("position_id").agg(best).select(
        "position_id", F.col("b.time").alias("last_time"), F.col("b.proposal_id").alias("last_proposal_id"),
        F.col("b.staffing_status").alias("last_status"))


@register("d22_safe_ratio", """
with c as (select customer_id, count(*) filter (where staffing_status = 'Assigned') as n_assigned,
             count(*) filter (where staffing_status = 'Proposed') as n_proposed,
             count(*) filter (where staffing_status = 'Open') as n_open from v_position group by 1)
select customer_id, n_assigned, n_proposed, n_open,
  coalesce(case when n_open = 0 then null else n_assigned * 1.0 / n_open end, 0) as assigned_per_open,
  coalesce(case when n_open = 0 then null else n_proposed * 1.0 / n_open end, 0) as proposed_per_open
from c""", views=("v_position",))
def q_safe_ratio(spark, sf_dir):
    """Ratios whose zero / null denominators give 0 instead of an ANSI error."""
    from ..functions.ratios import safe_ratio
    st = F.col("staffing_status")
    c = fx.v_position(Tables(spark, sf_dir)).groupBy("customer_id").agg(
        F.count_if(st == "Assigned").alias("n_assigned"), F.count_if(st == "Proposed").alias("n_proposed"),
        F.count_if(st == "Open").alias("n_open"))
    return c.select("*", safe_ratio("n_assigned", "n_open").alias("assigned_per_open"),
                    safe_ratio("n_proposed", "n_open").alias("proposed_per_open"))


@register("d1_whole_day_distance", """
select l_orderkey, l_linenumber,
  cast(floor((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 86400000000) as bigint) as ship_days,
  cast(floor((epoch_us(o.o_orderdate + interval 7 hour) - epoch_us(l.l_shipdate)) / 86400000000) as bigint) as back_days
from lineitem l join orders o on o.o_orderkey = l.l_orderkey""")
def q_distance(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        o, F.col("l_orderkey") == F.col("o_orderkey"))
    shifted = F.timestamp_add("HOUR", F.lit(7), F.col("o_orderdate"))
    return j.select("l_orderkey", "l_linenumber", days_between("o_orderdate", "l_shipdate").alias("ship_days"),
                    days_between("l_shipdate", shifted).alias("back_days"))


_D2_SQL = """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1998-06-01')) t(d)),
j as (select d.day as date, p.*, cast(p.planned_start_date as date) + 10 as workload_start_date,
        'Position ' || p.container_name as description from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to))"""


def _fd(a, b):
    return f"cast(floor((epoch_us(cast({b} as timestamp)) - epoch_us(cast({a} as timestamp))) / 86400000000) as integer)"


@register("d2_position_date_features", _D2_SQL + f"""
select position_id, date, {_fd('created', 'workload_start_date')} as distance_between_creation_and_workload_start_date,
  {_fd('date', 'workload_start_date')} as distance_between_snap_date_and_workload_start_date,
  {_fd('workload_start_date', 'planned_end_date')} as distance_between_workload_start_date_and_planned_end_date,
  {_fd('created', 'planned_start_date')} as planned_staffing_period,
  {_fd('planned_start_date', 'planned_end_date')} as planned_position_period,
  {_fd('created', 'date')} as time_after_creation, {_fd('date', 'planned_start_date')} as time_to_planned_start_date,
  {_fd('date', 'planned_end_date')} as time_to_planned_end_date,
  cast(case when (year(workload_start_date) * 12 + month(workload_start_date)) - (year(date) * 12 + month(date))
       between 0 and 2 then (year(workload_start_date) * 12 + month(workload_start_date)) - (year(date) * 12 + month(date))
       else 3 end as integer) as wkl_target,
  month(created) as creation_month,
  case when cast(date as timestamp) > planned_start_date then 1 else 0 end as overdue_planned,
  case when {_fd('date', 'planned_start_date')} <= 14 and {_fd('date', 'planned_start_date')} > 0 then 'yes' else 'no' end
    as two_weeks_to_planned_start_date,
  length(description) as len_description, split_part(container_name, '-', 1) as project_prefix
from j""", views=("v_position",))
def q_position_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, ["1996-01-01", "1998-06-01"]), fx.v_position(t), how="inner")
    j = (j.withColumnRenamed("day", "date")
         .withColumn("workload_start_date", F.date_add(F.col("planned_start_date").cast("date"), 10))
         .withColumn("description", F.concat(F.lit("Position "), F.col("container_name"))))
    out = pf.position_date_features(j.select("position_id", "date", "created", "planned_start_date", "planned_end_date",
                                             "workload_start_date", "description", "container_name"))
    return out.drop("created", "planned_start_date", "planned_end_date", "workload_start_date", "description",
                    "container_name")


@register("d3_assignment_date_features", _D2_SQL + f"""
select position_id, date, {_fd('valid_from', 'date')} as time_of_assignment,
  {_fd('created', 'planned_start_date')} as planned_staffing_period,
  {_fd('planned_start_date', 'planned_end_date')} as planned_position_period,
  {_fd('date', 'planned_end_date')} as time_to_planned_end_date, {_fd('created', 'date')} as time_after_creation,
  {_fd('planned_start_date', 'date')} as time_after_planned_start_date, month(created) as creation_month,
  case when month(planned_end_date) = 12 and day(planned_end_date) > 15 then 1 else 0 end as ped_in_the_end_of_Dec,
  case when month(planned_end_date) = 6 and day(planned_end_date) > 15 then 1 else 0 end as ped_in_the_end_of_Jun,
  case when day(planned_end_date) > 24 then 1 else 0 end as ped_at_the_end_of_month,
  case when day(planned_end_date) < 5 then 1 else 0 end as ped_at_the_begining_of_month,
  case when (month(planned_end_date) = 2 and day(planned_end_date) in (28, 29))
         or (month(planned_end_date) <> 2 and cast(planned_end_date as date) = last_day(planned_end_date))
       then 1 else 0 end as ped_is_last_day_of_month,
  case when day(planned_end_date) = 1 then 1 else 0 end as ped_is_first_day_of_month,
  {_fd('planned_end_date', "make_date(year(planned_end_date), 7, 1)")} as time_distance_between_ped_end_middle_of_the_year,
  {_fd('planned_end_date', "make_date(year(planned_end_date), 12, 31)")} as time_distance_between_ped_end_end_of_the_year
from j""", views=("v_position",))
def q_assignment_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, ["1996-01-01", "1998-06-01"]), fx.v_position(t), how="inner")
    j = j.withColumnRenamed("day", "date").withColumn("last_assigned_date", F.col("valid_from"))
    out = pf.assignment_date_features(j.select("position_id", "date", "created", "planned_start_date",
                                               "planned_end_date", "last_assigned_date"))
    return out.drop("created", "planned_start_date", "planned_end_date", "last_assigned_date")


@register("d10_iso_weeks", """
select distinct cast(ts as date) as day, cast(date_trunc('week', cast(ts as date)) as date) as week_start,
  yearweek(cast(ts as date)) as iso_year_week from events""")
def q_weeks(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(F.col("ts").cast("date").alias("day")).distinct()
    return e.select("day", week_start("day").alias("week_start"), iso_year_week("day").cast("bigint").alias("iso_year_week"))


@register("d23_period_bounds", """
select distinct cast(o_orderdate as date) as run_date, cast(date_trunc('month', o_orderdate) as date) as period_start,
  cast(date_trunc('month', o_orderdate) + interval 1 month as date) as next_period_start from orders""")
def q_period_bounds(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderdate").cast("date").alias("run_date")).distinct()
    a, b = period_bounds("run_date")
    return o.select("run_date", a.alias("period_start"), b.alias("next_period_start"))


@register("o1_ordered_days", """
select day, count(*) as n from v_view group by day order by day""", views=("v_view",))
def q_ordered(spark, sf_dir):
    return fx.v_view(Tables(spark, sf_dir)).groupBy("day").agg(F.count(F.lit(1)).alias("n")).orderBy("day")


@register("o4_frequency_ranking", """
select container_name, count(*) as n from v_position group by 1 order by n desc, container_name limit 10""",
          views=("v_position",))
def q_top(spark, sf_dir):
    p = fx.v_position(Tables(spark, sf_dir))
    return (p.groupBy("container_name").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("container_name")).limit(10))


@register("o5_union_all", """
select 'view' as kind, entity_id as key, day from v_view
union all select 'proposal', position_id, cast(time as date) from v_proposal""", views=("v_view", "v_proposal"))
def q_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = fx.v_view(t).select(F.lit("view").alias("kind"), F.col("entity_id").alias("key"), "day")
    b = fx.v_proposal(t).select(F.lit("proposal").alias("kind"), F.col("position_id").alias("key"),
                                F.col("time").cast("date").alias("day"))
    return a.unionByName(b)
