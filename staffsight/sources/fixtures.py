"""Derived views that map the driver's TPC-H-style tables onto the staffing data model.

Each ``v_*`` function is the DataFrame form of a view; ``VIEW_SQL`` holds the same view
in a dialect DuckDB accepts, used as a CTE by the oracle queries. The two forms must stay
in step: a change to one is a change to both.

Only the fixed 25-row ``nation`` and 5-row ``region`` tables are broadcast explicitly;
``customer`` is left to Catalyst, which broadcasts it only under the size threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .tables import Tables


def add_days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n.cast("int"), ts)


def v_position(t: Tables) -> DataFrame:
    o, c, n = t.orders, t.customer, t.nation
    k = F.col("o_orderkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("position_id"),
            F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit("PRJ"), (F.col("o_custkey") % 97).cast("string"), F.lit("-"),
                     (k % 5).cast("string")).alias("container_name"),
            F.col("o_orderdate").alias("created"),
            add_days(F.col("o_orderdate"), k % 60).alias("planned_start_date"),
            add_days(F.col("o_orderdate"), 30 + k % 300).alias("planned_end_date"),
            F.col("o_orderdate").alias("valid_from"),
            F.when(F.col("o_orderstatus") == "F",
                   add_days(F.col("o_orderdate"), 45 + k % 200)).alias("valid_to"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Assigned")
            .when(F.col("o_orderpriority") == "2-HIGH", "Proposed")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Open")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "On Hold")
            .otherwise("Closed").alias("staffing_status"),
            F.when(k % 7 == 0, "No staffing required").otherwise("Internal").alias("first_channel"),
            F.when(k % 4 == 0, "2").otherwise("1").alias("billing_type_id"),
            (k % 12).alias("primary_skill_id"),
            ((k % 12) % 4).alias("primary_skill_category_id"),
            F.col("c_nationkey").alias("city_id"),
            F.col("n_regionkey").alias("country_id"),
        )
    )


def v_worklog(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("position_id"),
        F.col("l_suppkey").alias("employee_id"),
        F.col("l_shipdate").cast("date").alias("timesheet_date"),
        F.col("l_quantity").alias("hours"),
        (F.col("l_returnflag") != "R").alias("billable"),
        F.col("l_linenumber").alias("line_no"),
    )


def v_proposal(t: Tables) -> DataFrame:
    et = F.col("event_type")
    return t.events.where(et != "view").select(
        F.col("event_id").alias("proposal_id"),
        F.col("user_id").alias("position_id"),
        F.col("ts").alias("time"),
        F.when(et == "signup", "Proposed").when(et == "click", "Preselected")
        .when(et == "purchase", "Booked").otherwise("Rejected").alias("staffing_status"),
        F.when(F.col("event_id") % 3 == 0, "external").otherwise("internal").alias("applicant"),
    )


def v_view(t: Tables) -> DataFrame:
    return (t.events.where(F.col("event_type") == "view")
            .groupBy(F.col("user_id").alias("entity_id"), F.col("ts").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("views")))


def v_location(t: Tables) -> DataFrame:
    cities = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("location_id"),
        F.col("n_name").alias("location_name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_location_id"),
        F.lit(6).alias("location_type_id"))
    countries = t.region.select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("location_id"),
        F.col("r_name").alias("location_name"),
        F.lit(None).cast("string").alias("parent_location_id"),
        F.lit(5).alias("location_type_id"))
    return cities.unionByName(countries)


def v_run(t: Tables) -> DataFrame:
    run_id = (F.col("event_id") % 4 + 10 * F.dayofmonth("ts").cast("int")).alias("run_id")
    return (t.events.groupBy(run_id, F.col("ts").cast("date").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("n")))


def v_edge(t: Tables) -> DataFrame:
    return (t.lineitem.groupBy(F.col("l_orderkey").alias("position_id"),
                               F.col("l_suppkey").alias("employee_id"))
            .agg(F.max("l_extendedprice").alias("score")))


def v_crm(t: Tables) -> DataFrame:
    o, c = t.orders, t.customer
    prio = F.col("o_orderpriority")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_mktsegment").alias("project_name"),
                     F.year("o_orderdate").alias("year"),
                     F.month("o_orderdate").alias("month"),
                     F.when(prio == "1-URGENT", 1.0).when(prio == "2-HIGH", 0.8)
                     .when(prio == "3-MEDIUM", 0.6).when(prio == "4-NOT SPECIFIED", 0.4)
                     .otherwise(0.1).alias("probability"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")))


def v_snap(t: Tables) -> DataFrame:
    """Hour entries present in each of three snapshots.

    The reference view pairs every line with the three snapshot numbers; here each line
    carries ``array(1,2,3)`` and is exploded, which is the same rows without a join.
    """
    l = t.lineitem
    k = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("snap")
    return (l.select(k, "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
            .where((F.col("l_orderkey") + F.col("l_linenumber")) % 5 != F.col("snap"))
            .groupBy("snap",
                     (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100
                      + F.col("l_partkey") % 100).alias("id"),
                     (F.col("l_returnflag") != "R").alias("billable"))
            .agg(F.sum("l_quantity").alias("hours")))


def v_score(t: Tables) -> DataFrame:
    l, d = t.labels, t.documents
    return (l.join(d.select("doc_id", "n_chars"), "doc_id")
            .select("doc_id", F.col("quality").alias("y"),
                    ((F.col("n_chars") % 1000).cast("double") / F.lit(1000.0)).alias("p")))


# Same views for the DuckDB oracle (used as CTEs).
VIEW_SQL = {
    "v_position": """
select o.o_orderkey as position_id, o.o_custkey as customer_id,
  'PRJ' || cast(o.o_custkey % 97 as varchar) || '-' || cast(o.o_orderkey % 5 as varchar) as container_name,
  o.o_orderdate as created,
  o.o_orderdate + (o.o_orderkey % 60) * interval '1' day as planned_start_date,
  o.o_orderdate + (30 + o.o_orderkey % 300) * interval '1' day as planned_end_date,
  o.o_orderdate as valid_from,
  case when o.o_orderstatus = 'F' then o.o_orderdate + (45 + o.o_orderkey % 200) * interval '1' day end as valid_to,
  case o.o_orderpriority when '1-URGENT' then 'Assigned' when '2-HIGH' then 'Proposed' when '3-MEDIUM' then 'Open'
       when '4-NOT SPECIFIED' then 'On Hold' else 'Closed' end as staffing_status,
  case when o.o_orderkey % 7 = 0 then 'No staffing required' else 'Internal' end as first_channel,
  case when o.o_orderkey % 4 = 0 then '2' else '1' end as billing_type_id,
  o.o_orderkey % 12 as primary_skill_id, (o.o_orderkey % 12) % 4 as primary_skill_category_id,
  c.c_nationkey as city_id, n.n_regionkey as country_id
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey""",
    "v_worklog": """
select l_orderkey as position_id, l_suppkey as employee_id, cast(l_shipdate as date) as timesheet_date,
  l_quantity as hours, l_returnflag <> 'R' as billable, l_linenumber as line_no from lineitem""",
    "v_proposal": """
select event_id as proposal_id, user_id as position_id, ts as time,
  case event_type when 'signup' then 'Proposed' when 'click' then 'Preselected' when 'purchase' then 'Booked'
       else 'Rejected' end as staffing_status,
  case when event_id % 3 = 0 then 'external' else 'internal' end as applicant
from events where event_type <> 'view'""",
    "v_view": """
select user_id as entity_id, cast(ts as date) as day, count(*) as views
from events where event_type = 'view' group by user_id, cast(ts as date)""",
    "v_location": """
select 'N' || cast(n_nationkey as varchar) as location_id, n_name as location_name,
  'R' || cast(n_regionkey as varchar) as parent_location_id, 6 as location_type_id from nation
union all
select 'R' || cast(r_regionkey as varchar), r_name, cast(null as varchar), 5 from region""",
    "v_run": """
select event_id % 4 + 10 * cast(extract(day from ts) as int) as run_id, cast(ts as date) as day, event_type,
  count(*) as n
from events group by event_id % 4 + 10 * cast(extract(day from ts) as int), cast(ts as date), event_type""",
    "v_edge": """
select l_orderkey as position_id, l_suppkey as employee_id, max(l_extendedprice) as score
from lineitem group by l_orderkey, l_suppkey""",
    "v_crm": """
select c.c_mktsegment as project_name, cast(extract(year from o.o_orderdate) as int) as year,
  cast(extract(month from o.o_orderdate) as int) as month,
  case o.o_orderpriority when '1-URGENT' then 1.0 when '2-HIGH' then 0.8 when '3-MEDIUM' then 0.6
       when '4-NOT SPECIFIED' then 0.4 else 0.1 end as probability,
  sum(cast(o.o_totalprice as decimal(18,2))) as amount
from orders o join customer c on o.o_custkey = c.c_custkey group by 1, 2, 3, 4""",
    "v_snap": """
select s.k as snap, l.l_orderkey * 1000 + l.l_linenumber * 100 + l.l_partkey % 100 as id,
  l.l_returnflag <> 'R' as billable, sum(l.l_quantity) as hours
from lineitem l cross join (select 1 as k union all select 2 union all select 3) s
where (l.l_orderkey + l.l_linenumber) % 5 <> s.k group by 1, 2, 3""",
    "v_score": """
select l.doc_id, l.quality as y, cast(d.n_chars % 1000 as double) / cast(1000 as double) as p
from labels l join documents d on l.doc_id = d.doc_id""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as CTEs (oracle side)."""
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]}\n)" for n in names)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
