"""Location, roll-up and daily-counter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import locations as loc
from ..operators import rollups as ru
from ..operators import snapshots as snap
from ..operators.text import printable_ascii
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register

ROLLUP_DAYS = ("1996-01-01", "1998-06-01")
TARGETS = ("Assigned", "Proposed", "Open")

_ROLLUP_BASE_SQL = """
days as (select cast(d as date) as day from (values ('1996-01-01'), ('1998-06-01')) t(d)),
j as (select d.day, p.* from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)
      where p.staffing_status not in ('Terminated', 'On Hold', 'Closed')),
pos as (select distinct j.position_id, j.day, j.container_name, cast(j.primary_skill_id as varchar) as primary_skill_id,
          cast(j.primary_skill_category_id as varchar) as primary_skill_category_id,
          'P' || cast(j.primary_skill_category_id % 2 as varchar) as skill_prefix,
          cast(u.city as varchar) as city_id, cast(n.n_regionkey as varchar) as country_id
        from j, unnest(list_distinct([j.city_id, (j.city_id + j.position_id % 3) % 25])) u(city)
        join nation n on n.n_nationkey = u.city),
feat as (select day, container_name, cast(primary_skill_id as varchar) as primary_skill_id,
           cast(primary_skill_category_id as varchar) as primary_skill_category_id,
           'P' || cast(primary_skill_category_id % 2 as varchar) as skill_prefix,
           cast(city_id as varchar) as city_id, cast(country_id as varchar) as country_id,
           staffing_status as target, count(*) as value
         from j group by all),
k as (select distinct position_id, day, container_name, primary_skill_id, primary_skill_category_id, skill_prefix
      from pos)"""


def _rollup_oracle(prefix: str, scope: str | None, extra_select: str = "", feat_sql: str = "",
                   targets=TARGETS, res_type: str = "integer") -> str:
    """Brute-force twin of A4: one correlated sum per output column. ``feat_sql`` adds CTEs
    after the base ones and must define ``feat2`` to replace the position counts."""
    cols = []
    src = "feat2" if feat_sql else "feat"
    for lv in (ru.CITY_LEVEL, ru.COUNTRY_LEVEL, ru.TOTAL):
        for sk in (*ru.SKILL_LEVELS, ru.TOTAL):
            for t in targets:
                name = f"{prefix}_{ru.target_slug(t)}_{ru.level_suffix(lv, sk)}"
                cond = [f"f.day = k.day", f"f.target = '{t}'"]
                if scope:
                    cond.append(f"f.{scope} = k.{scope}")
                if sk != ru.TOTAL:
                    cond.append(f"f.{sk} = k.{sk}")
                if lv == ru.CITY_LEVEL:
                    cond.append("f.city_id in (select city_id from pos q where q.position_id = k.position_id "
                                "and q.day = k.day)")
                elif lv == ru.COUNTRY_LEVEL:
                    cond.append("f.country_id in (select country_id from pos q where q.position_id = k.position_id "
                                "and q.day = k.day)")
                cols.append(f"cast(coalesce((select sum(f.value) from {src} f where {' and '.join(cond)}), 0) "
                            f"as {res_type}) as \"{name}\"")
    keys = "k.position_id, k.day" + (f", k.{scope}" if scope else "")
    return f"with {_ROLLUP_BASE_SQL}{feat_sql}\nselect {keys}, {', '.join(cols)}{extra_select} from k"


def _rollup_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    active = snap.active_positions(fx.v_position(t), billing_type=None)
    j = snap.validity_join(io.days(spark, ROLLUP_DAYS), active, how="inner")
    j = j.withColumn("skill_prefix", F.concat(F.lit("P"), (F.col("primary_skill_category_id") % 2).cast("string")))
    feat = j.groupBy("day", "container_name", "primary_skill_id", "primary_skill_category_id", "skill_prefix",
                     "city_id", "country_id", F.col("staffing_status").alias("target")).agg(
        F.count(F.lit(1)).alias("value"))
    cities = F.explode(F.array_distinct(F.array(F.col("city_id"), (F.col("city_id") + F.col("position_id") % 3) % 25)))
    pos = (j.select("position_id", "day", "container_name", "primary_skill_id", "primary_skill_category_id",
                    "skill_prefix", cities.alias("city_id"))
           .join(F.broadcast(t.nation.select(F.col("n_nationkey").alias("city_id"),
                                             F.col("n_regionkey").alias("country_id"))), "city_id"))
    return pos, feat


@register("a4_rollup_features", _rollup_oracle("positions", None), views=("v_position",))
def q_rollup(spark, sf_dir):
    pos, feat = _rollup_inputs(spark, sf_dir)
    return ru.rollup_features(pos, feat, "target", "value", "positions", TARGETS)


@register("a6_rollup_same_container", _rollup_oracle("container_positions", "container_name"),
          views=("v_position",))
def q_rollup_scoped(spark, sf_dir):
    pos, feat = _rollup_inputs(spark, sf_dir)
    return ru.rollup_features(pos, feat, "target", "value", "container_positions", TARGETS,
                              scope_key="container_name")


# --- A5: the other roll-up uses -----------------------------------------------------------
# Employees have no skill of their own in the fixture tables; their skill keys follow the
# same rule as positions' (id % 12, category % 4, prefix by category parity).
_EMP_LEVELS_SQL = """cast(s.s_suppkey % 12 as varchar) as primary_skill_id,
    cast((s.s_suppkey % 12) % 4 as varchar) as primary_skill_category_id,
    'P' || cast(((s.s_suppkey % 12) % 4) % 2 as varchar) as skill_prefix,
    cast(s.s_nationkey as varchar) as city_id, cast(n.n_regionkey as varchar) as country_id"""

_A5_BENCH_SQL = f""",
efirst as (select employee_id, min(timesheet_date) as f from v_worklog group by employee_id),
ed as (select d.day, e.employee_id from days d join efirst e on e.f <= d.day),
lb as (select ed.day, ed.employee_id, max(w.timesheet_date) as last_billable from ed
       left join v_worklog w on w.employee_id = ed.employee_id and w.billable and w.timesheet_date <= ed.day
       group by 1, 2),
bench as (select day, employee_id, datediff('day', last_billable, day) as bench_days from lb
          where last_billable is null or datediff('day', last_billable, day) >= 14),
feat2 as (select b.day, null as container_name, {_EMP_LEVELS_SQL},
    case when bench_days is null then '90+' when bench_days <= 30 then '0-30' when bench_days <= 60 then '31-60'
      when bench_days <= 90 then '61-90' else '90+' end as target, 1 as value
  from bench b join supplier s on s.s_suppkey = b.employee_id join nation n on n.n_nationkey = s.s_nationkey)"""

_HOUR_MEASURES = ("total_hours", "billable_hours", "in_trip_hours")
_A5_HOURS_SQL = f""",
wd as (select w.*, {_EMP_LEVELS_SQL} from v_worklog w join days d on w.timesheet_date = d.day
       join supplier s on s.s_suppkey = w.employee_id join nation n on n.n_nationkey = s.s_nationkey),
feat2 as (select timesheet_date as day, null as container_name, primary_skill_id, primary_skill_category_id,
    skill_prefix, city_id, country_id, m.target,
    case m.target when 'total_hours' then hours when 'billable_hours' then case when billable then hours else 0 end
      else case when line_no = 1 then hours else 0 end end as value
  from wd, (values ('total_hours'), ('billable_hours'), ('in_trip_hours')) m(target))"""


def _employee_levels(t: Tables, df: DataFrame) -> DataFrame:
    sk = F.col("employee_id") % 12
    return (df.join(t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("city_id")),
                    "employee_id")
            .join(F.broadcast(t.nation.select(F.col("n_nationkey").alias("city_id"),
                                              F.col("n_regionkey").alias("country_id"))), "city_id")
            .withColumn("primary_skill_id", sk).withColumn("primary_skill_category_id", sk % 4)
            .withColumn("skill_prefix", F.concat(F.lit("P"), (sk % 4 % 2).cast("string"))))


@register("a5_rollup_bench_buckets",
          _rollup_oracle("bench_buckets", None, feat_sql=_A5_BENCH_SQL,
                         targets=tuple(l for _, l in ru.BENCH_BUCKETS) + (ru.BENCH_TOP,)),
          views=("v_position", "v_worklog"))
def q_rollup_bench(spark, sf_dir):
    """A5: bench employees per bucket rolled up to each position's locations and skills."""
    t = Tables(spark, sf_dir)
    pos, _ = _rollup_inputs(spark, sf_dir)
    b = ru.bench_rows(io.days(spark, ROLLUP_DAYS), fx.v_worklog(t)).withColumn("bucket", ru.bench_bucket("bench_days"))
    feat = _employee_levels(t, b).withColumn("value", F.lit(1))
    return ru.rollup_features(pos, feat, "bucket", "value", "bench_buckets",
                              [l for _, l in ru.BENCH_BUCKETS] + [ru.BENCH_TOP])


@register("a5_rollup_time_reporting",
          _rollup_oracle("time_reporting", None, feat_sql=_A5_HOURS_SQL, targets=_HOUR_MEASURES,
                         res_type="double"),
          views=("v_position", "v_worklog"))
def q_rollup_hours(spark, sf_dir):
    """A5: reported hours on the snapshot day — total, billable, in trip — rolled up in one
    pass: the three measures are unpivoted into (target, value) rows so the twelve
    grouping sets are aggregated once, not once per measure."""
    t = Tables(spark, sf_dir)
    pos, _ = _rollup_inputs(spark, sf_dir)
    w = fx.v_worklog(t).join(F.broadcast(io.days(spark, ROLLUP_DAYS)),
                             F.col("timesheet_date") == F.col("day")).drop("timesheet_date")
    w = _employee_levels(t, w)
    hours = F.col("hours").cast("double")
    long = w.select("day", "primary_skill_id", "primary_skill_category_id", "skill_prefix", "city_id", "country_id",
                    F.explode(F.array(
                        F.struct(F.lit("total_hours").alias("m"), hours.alias("v")),
                        F.struct(F.lit("billable_hours").alias("m"),
                                 F.when(F.col("billable"), hours).otherwise(0.0).alias("v")),
                        F.struct(F.lit("in_trip_hours").alias("m"),
                                 F.when(F.col("line_no") == 1, hours).otherwise(0.0).alias("v")))).alias("mv"))
    long = long.select("*", "mv.m", "mv.v").drop("mv")
    return ru.rollup_features(pos, long, "m", "v", "time_reporting", _HOUR_MEASURES, res_type="double")


def _suffixes():
    return [ru.level_suffix(lv, sk) for lv in (ru.CITY_LEVEL, ru.COUNTRY_LEVEL, ru.TOTAL)
            for sk in (*ru.SKILL_LEVELS, ru.TOTAL)]


@register("a7_total_positions", "with r as (" + _rollup_oracle("positions", None) + ")\nselect position_id, day, "
          + ", ".join(" + ".join(f"positions_{ru.target_slug(t)}_{s}" for t in TARGETS) + f" as positions_total_{s}"
                      for s in _suffixes()) + " from r", views=("v_position",))
def q_total_positions(spark, sf_dir):
    pos, feat = _rollup_inputs(spark, sf_dir)
    r = ru.total_over_targets(ru.rollup_features(pos, feat, "target", "value", "positions", TARGETS),
                              "positions", TARGETS)
    return r.select("position_id", "day", *[f"positions_total_{s}" for s in _suffixes()])


@register("a8_supply_vs_demand", "with r as (" + _rollup_oracle("positions", None) + ")\nselect position_id, day, "
          + ", ".join(f"coalesce(case when positions_open_{s} = 0 then null else "
                      f"positions_assigned_{s} * 1.0 / positions_open_{s} end, 0) as supply_vs_demand_{s}"
                      for s in _suffixes()) + " from r", views=("v_position",))
def q_supply_demand(spark, sf_dir):
    pos, feat = _rollup_inputs(spark, sf_dir)
    r = ru.rollup_features(pos, feat, "target", "value", "positions", TARGETS)
    r = ru.supply_vs_demand(r, "positions_assigned", "positions_open")
    return r.select("position_id", "day", *[f"supply_vs_demand_{s}" for s in _suffixes()])


# --- A5: total proposals and bench count; A6: customer scope; A8: bench over positions ------
ALL = "all"
_A5_PROPOSALS_SQL = """,
feat2 as (select j.day, null as container_name, cast(j.primary_skill_id as varchar) as primary_skill_id,
    cast(j.primary_skill_category_id as varchar) as primary_skill_category_id, 'P' || cast(j.primary_skill_category_id % 2 as varchar) as skill_prefix,
    cast(j.city_id as varchar) as city_id, cast(j.country_id as varchar) as country_id, 'all' as target, count(*) as value
  from j join v_proposal v on v.position_id = j.position_id and cast(v.time as date) <= j.day group by all)"""
_A5_COUNT_SQL = _A5_BENCH_SQL.replace("feat2 as (", "feat1 as (") + f""",
feat2 as (select * replace ('{ALL}' as target) from feat1)"""


def proposals_feature(spark, t):
    """Proposals known by each day, by skill and place of their position."""
    active = snap.active_positions(fx.v_position(t), billing_type=None)
    j = snap.validity_join(io.days(spark, ROLLUP_DAYS), active, how="inner")
    v = fx.v_proposal(t).groupBy("position_id", F.col("time").cast("date").alias("on")).agg(F.count(F.lit(1)).alias("n"))
    rows = j.join(v, "position_id").where(F.col("on") <= F.col("day"))
    rows = rows.withColumn("skill_prefix", F.concat(F.lit("P"), (F.col("primary_skill_category_id") % 2).cast("string")))
    return rows.groupBy("day", "primary_skill_id", "primary_skill_category_id", "skill_prefix", "city_id", "country_id").agg(
        F.sum("n").alias("value")).withColumn("target", F.lit(ALL))


def bench_feature(spark, t):
    """Employees on the bench on each day, by skill and place."""
    b = ru.bench_rows(io.days(spark, ROLLUP_DAYS), fx.v_worklog(t))
    return _employee_levels(t, b).withColumn("value", F.lit(1)).withColumn("target", F.lit(ALL))


@register("a5_rollup_total_proposals", _rollup_oracle("total_proposals", None, feat_sql=_A5_PROPOSALS_SQL, targets=(ALL,)),
          views=("v_position", "v_proposal"))
def q_rollup_proposals(spark, sf_dir):
    pos, _ = _rollup_inputs(spark, sf_dir)
    return ru.rollup_features(pos, proposals_feature(spark, Tables(spark, sf_dir)), "target", "value", "total_proposals", (ALL,))


@register("a5_rollup_bench_count", _rollup_oracle("on_bench", None, feat_sql=_A5_COUNT_SQL, targets=(ALL,)), views=("v_position", "v_worklog"))
def q_rollup_bench_count(spark, sf_dir):
    pos, _ = _rollup_inputs(spark, sf_dir)
    return ru.rollup_features(pos, bench_feature(spark, Tables(spark, sf_dir)), "target", "value", "on_bench", (ALL,))


def _customer_sql() -> str:
    sql = _rollup_oracle("customer_positions", "container_name")
    name = "'Cst #' || cast({}customer_id as varchar) as container_name,"
    sql = sql.replace("j.container_name,", name.format("j.")).replace("select day, container_name,", "select day, " + name.format(""))
    return "with r as (" + sql + ") select * exclude (container_name), container_name as customer_name from r"


@register("a6_rollup_same_customer", _customer_sql(), views=("v_position",))
def q_rollup_customer(spark, sf_dir):
    """A6 within the position's customer, whose name is cleaned to printable ASCII first."""
    t = Tables(spark, sf_dir)
    pos, _ = _rollup_inputs(spark, sf_dir)
    name = printable_ascii(F.concat(F.lit("C\u00fcst\u200b #"), F.col("customer_id").cast("string")))
    names = fx.v_position(t).select("position_id", name.alias("customer_name"))
    active = snap.validity_join(io.days(spark, ROLLUP_DAYS), snap.active_positions(fx.v_position(t), billing_type=None), how="inner")
    active = active.withColumn("skill_prefix", F.concat(F.lit("P"), (F.col("primary_skill_category_id") % 2).cast("string")))
    feat = active.groupBy("day", name.alias("customer_name"), "primary_skill_id", "primary_skill_category_id", "skill_prefix", "city_id", "country_id",
                          F.col("staffing_status").alias("target")).agg(F.count(F.lit(1)).alias("value"))
    return ru.rollup_features(pos.join(names, "position_id"), feat, "target", "value", "customer_positions", TARGETS, scope_key="customer_name")


@register("a8_bench_vs_positions", "with r as (" + _rollup_oracle("positions", None) + "),\nb as ("
          + _rollup_oracle("on_bench", None, feat_sql=_A5_COUNT_SQL, targets=(ALL,)) + ")\nselect r.position_id, r.day, "
          + ", ".join("coalesce(case when " + " + ".join(f"positions_{ru.target_slug(t)}_{s}" for t in TARGETS) + f" = 0 then null else on_bench_all_{s} * 1.0 / ("
                      + " + ".join(f"positions_{ru.target_slug(t)}_{s}" for t in TARGETS) + f") end, 0) as supply_vs_demand_{s}" for s in _suffixes())
          + " from r join b on b.position_id = r.position_id and b.day = r.day", views=("v_position", "v_worklog"))
def q_bench_positions(spark, sf_dir):
    """Employees on the bench over all active positions at the twelve levels."""
    pos, feat = _rollup_inputs(spark, sf_dir)
    total = ru.total_over_targets(ru.rollup_features(pos, feat, "target", "value", "positions", TARGETS), "positions", TARGETS)
    bench = ru.rollup_features(pos, bench_feature(spark, Tables(spark, sf_dir)), "target", "value", "on_bench", (ALL,))
    both = ru.supply_vs_demand(total.join(bench, ["position_id", "day"]), f"on_bench_{ALL}", "positions_total")
    return both.select("position_id", "day", *(f"supply_vs_demand_{s}" for s in _suffixes()))


# --- locations -----------------------------------------------------------------------
def _location_json(c) -> F.Column:
    """Fixture JSON location lists in the five shapes of the reference's literals."""
    k = F.col("position_id") % 5
    city = F.col("city_id").cast("string")
    country = F.col("country_id").cast("string")
    nxt_city = ((F.col("city_id") + 1) % 25).cast("string")
    nxt_country = ((F.col("country_id") + 1) % 5).cast("string")
    return (F.when(k == 0, F.lit('[{"id": "-1", "name": "Any location"}]'))
            .when(k == 1, F.concat(F.lit('[{"id": "N'), city, F.lit('", "name": "c"}]')))
            .when(k == 2, F.concat(F.lit('[{"id": "R'), country, F.lit('", "name": "k"}, {"id": "N'), nxt_city,
                                   F.lit('", "name": "c"}]')))
            .when(k == 3, F.concat(F.lit('[{"id": "N'), city, F.lit('", "name": "c", "parent": {"id": "R'), country,
                                   F.lit('", "name": "k"}}]')))
            .otherwise(F.concat(F.lit('[{"id": "R'), nxt_country, F.lit('", "name": "k"}, {"id": "N'), city,
                                F.lit('", "name": "c", "parent": {"id": "R'), country,
                                F.lit('", "name": "k"}}, {"id": "X9", "name": "unknown"}]'))))


_LOC_JSON_SQL = """case position_id % 5
  when 0 then '[{"id": "-1", "name": "Any location"}]'
  when 1 then '[{"id": "N' || cast(city_id as varchar) || '", "name": "c"}]'
  when 2 then '[{"id": "R' || cast(country_id as varchar) || '", "name": "k"}, {"id": "N' || cast((city_id + 1) % 25 as varchar) || '", "name": "c"}]'
  when 3 then '[{"id": "N' || cast(city_id as varchar) || '", "name": "c", "parent": {"id": "R' || cast(country_id as varchar) || '", "name": "k"}}]'
  else '[{"id": "R' || cast((country_id + 1) % 5 as varchar) || '", "name": "k"}, {"id": "N' || cast(city_id as varchar) || '", "name": "c", "parent": {"id": "R' || cast(country_id as varchar) || '", "name": "k"}}, {"id": "X9", "name": "unknown"}]'
end"""

_TREE_SQL = """tree as (select c.location_id as city_id, c.location_name as city, c.parent_location_id as country_id,
                 k.location_name as country, k.parent_location_id as region_id, r.location_name as region
               from v_location c left join v_location k on c.parent_location_id = k.location_id
               left join v_location r on k.parent_location_id = r.location_id
               where c.location_type_id = 6)"""


@register("j10_location_tree", f"with {_TREE_SQL} select * from tree", views=("v_location",))
def q_tree(spark, sf_dir):
    return loc.location_tree(fx.v_location(Tables(spark, sf_dir)))


def _pos_locations(t):
    return fx.v_position(t).select("position_id", _location_json(None).alias("staffing_locations"))


def _expand_sql(names: bool) -> str:
    c, k = ("city", "country") if names else ("city_id", "country_id")
    cc, kk = ("staffing_locations_cities", "staffing_locations_countries") if names else \
        ("staffing_locations_city_ids", "staffing_locations_country_ids")
    if names:
        ids = ("ids as (select position_id, list_filter(flatten(list_transform(l, lambda x: [x.id, x.parent.id])), "
               "lambda i: i is not null) as ids from parsed)")
    else:
        ids = ("ids as (select position_id, case when list_bool_or(list_transform(l, lambda x: x.parent is not null)) "
               "then list_transform(list_filter(l, lambda x: x.parent is not null), lambda x: x.id) "
               "else list_transform(l, lambda x: x.id) end as ids from parsed)")
    return f"""with {_TREE_SQL},
src as (select position_id, {_LOC_JSON_SQL} as s from v_position),
parsed as (select position_id, from_json(s, '[{{"id": "VARCHAR", "name": "VARCHAR", "parent": {{"id": "VARCHAR", "name": "VARCHAR"}}}}]') as l from src),
{ids},
m as (select city_id as mid, {c} as mc, {k} as mk from tree union all select country_id, {c}, {k} from tree),
e as (select position_id, unnest(ids) as i from ids where coalesce(ids[1], '') <> '-1'),
g as (select e.position_id, list_sort(list(distinct m.mc)) as cc, list_sort(list(distinct m.mk)) as kk
      from e join m on e.i = m.mid group by e.position_id),
alls as (select list_sort(list(distinct {c})) as ac, list_sort(list(distinct {k})) as ak from tree)
select ids.position_id,
  case when coalesce(ids.ids[1], '') = '-1' then (select ac from alls) else coalesce(g.cc, []) end as {cc},
  case when coalesce(ids.ids[1], '') = '-1' then (select ak from alls) else coalesce(g.kk, []) end as {kk}
from ids left join g on ids.position_id = g.position_id"""


@register("j11_expand_location_ids", _expand_sql(False), views=("v_location", "v_position"))
def q_expand_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tree = loc.location_tree(fx.v_location(t))
    return loc.expand_location_ids(_pos_locations(t), ["position_id"], "staffing_locations", tree)


@register("j12_expand_location_names", _expand_sql(True), views=("v_location", "v_position"))
def q_expand_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tree = loc.location_tree(fx.v_location(t))
    return loc.expand_location_names(_pos_locations(t), ["position_id"], "staffing_locations", tree)


@register("j13_explode_cities", "with x as (" + _expand_sql(False) + f"""),
{_TREE_SQL}
select x.position_id, u.c as city_id, tree.country_id from x left join lateral
  (select unnest(case when len(x.staffing_locations_city_ids) = 0 then [null]
                      else x.staffing_locations_city_ids end) as c) u on true
left join tree on tree.city_id = u.c""".replace("with x as (with ", "with x as (with "),
          views=("v_location", "v_position"))
def q_explode_cities(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tree = loc.location_tree(fx.v_location(t))
    ex = loc.expand_location_ids(_pos_locations(t), ["position_id"], "staffing_locations", tree)
    return loc.explode_cities(ex, "staffing_locations_city_ids", tree).select("position_id", "city_id", "country_id")


@register("d18_location_names", f"""
select position_id, list_transform(from_json({_LOC_JSON_SQL}, '[{{"name": "VARCHAR"}}]'), lambda x: x.name) as names
from v_position""", views=("v_position",))
def q_location_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _pos_locations(t).select("position_id", loc.location_names(F.col("staffing_locations")).alias("names"))


@register("d19_location_ids_any_flag", f"""
with parsed as (select position_id, from_json({_LOC_JSON_SQL}, '[{{"id": "VARCHAR", "parent": {{"id": "VARCHAR"}}}}]') as l
                from v_position),
ids as (select position_id, case when list_bool_or(list_transform(l, lambda x: x.parent is not null))
          then list_transform(list_filter(l, lambda x: x.parent is not null), lambda x: x.id)
          else list_transform(l, lambda x: x.id) end as ids from parsed)
select position_id, ids, coalesce(ids[1] = '-1', false) as is_any_location from ids""", views=("v_position",))
def q_location_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = loc.location_ids(F.col("staffing_locations"))
    return _pos_locations(t).select("position_id", ids.alias("ids"), loc.is_any_location(ids).alias("is_any_location"))


# --- daily counters --------------------------------------------------------------------
_COUNTER_DAYS_SQL = "days as (select cast(d as date) as day from (values ('1996-01-01'), ('1998-06-01')) t(d))"


def _counter_sql(by: str) -> str:
    return f"""with {_COUNTER_DAYS_SQL}
select d.day, {by}, count(*) as number_of_positions from days d join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)
where p.staffing_status not in ('Terminated', 'On Hold', 'Closed') group by all"""


def _active(spark, sf_dir):
    return snap.active_positions(fx.v_position(Tables(spark, sf_dir)), billing_type=None)


@register("a19_daily_counter_skill_place_status",
          _counter_sql("p.primary_skill_id, p.city_id, p.country_id, p.staffing_status"), views=("v_position",))
def q_counter(spark, sf_dir):
    return ru.active_counts(io.days(spark, ROLLUP_DAYS), _active(spark, sf_dir),
                            ["primary_skill_id", "city_id", "country_id", "staffing_status"])


@register("a20_daily_counter_per_customer", _counter_sql("p.customer_id"), views=("v_position",))
def q_counter_customer(spark, sf_dir):
    return ru.active_counts(io.days(spark, ROLLUP_DAYS), _active(spark, sf_dir), ["customer_id"])


@register("a21_daily_counter_per_project", _counter_sql("p.container_name"), views=("v_position",))
def q_counter_project(spark, sf_dir):
    return ru.active_counts(io.days(spark, ROLLUP_DAYS), _active(spark, sf_dir), ["container_name"])


@register("a19_daily_status_counts_many_days", """
with days as (select cast(unnest(generate_series(date '1994-12-01', date '1999-12-31', interval 1 day)) as date) as day)
select d.day, p.staffing_status, count(*) as number_of_positions from days d join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)
group by 1, 2""", views=("v_position",))
def q_counter_many_days(spark, sf_dir):
    """A19 over a five-year daily series: the sweep keeps the work at rows + status × days."""
    days = io.date_series(spark, "1994-12-01", "1999-12-31", 1)
    pos = fx.v_position(Tables(spark, sf_dir))
    return ru.active_counts(days, pos, ["staffing_status"])


_BENCH_DAYS = ("1996-01-01", "1997-03-03", "1998-06-01")
_BENCH_SQL = """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1997-03-03'), ('1998-06-01')) t(d)),
first as (select employee_id, min(timesheet_date) as f from v_worklog group by employee_id),
ed as (select d.day, e.employee_id from days d join first e on e.f <= d.day),
lb as (select ed.day, ed.employee_id, max(w.timesheet_date) as last_billable from ed
       left join v_worklog w on w.employee_id = ed.employee_id and w.billable and w.timesheet_date <= ed.day
       group by 1, 2),
bench as (select day, employee_id, last_billable, datediff('day', last_billable, day) as bench_days from lb
          where last_billable is null or datediff('day', last_billable, day) >= 14)"""


@register("a22_daily_bench_count", _BENCH_SQL + """
select b.day, s.s_nationkey as city_id, count(*) as number_of_employees
from bench b join supplier s on s.s_suppkey = b.employee_id group by 1, 2""", views=("v_worklog",))
def q_bench_count(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = ru.bench_rows(io.days(spark, _BENCH_DAYS), fx.v_worklog(t))
    b = b.join(t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("city_id")),
               "employee_id")
    return ru.daily_counter(b, ["city_id"], out_col="number_of_employees")


@register("a23_daily_bench_buckets", _BENCH_SQL + """
select day, case when bench_days is null then '90+' when bench_days <= 30 then '0-30' when bench_days <= 60 then '31-60'
  when bench_days <= 90 then '61-90' else '90+' end as bucket, count(*) as number_of_employees
from bench group by 1, 2""", views=("v_worklog",))
def q_bench_buckets(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = ru.bench_rows(io.days(spark, _BENCH_DAYS), fx.v_worklog(t)).withColumn("bucket", ru.bench_bucket("bench_days"))
    return ru.daily_counter(b, ["bucket"], out_col="number_of_employees")


@register("a24_daily_hours", """
select w.timesheet_date, s.s_nationkey as location_id, sum(w.hours) as total_hours,
  sum(case when w.billable then w.hours else 0 end) as billable_hours,
  sum(case when w.line_no = 1 then w.hours else 0 end) as in_trip_hours
from v_worklog w join supplier s on s.s_suppkey = w.employee_id group by 1, 2""", views=("v_worklog",))
def q_daily_hours(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = fx.v_worklog(t).join(t.supplier.select(F.col("s_suppkey").alias("employee_id"),
                                               F.col("s_nationkey").alias("location_id")), "employee_id") \
        .withColumn("on_trip", F.col("line_no") == 1)
    out = ru.daily_hours(w, ["location_id"], trip_col="on_trip")
    return out.select("timesheet_date", "location_id", *[F.round(c, 6).alias(c) for c in
                                                         ("total_hours", "billable_hours", "in_trip_hours")])


@register("a25_daily_counter_proposals", """
select cast(time as date) as day, staffing_status, applicant, count(*) as number_of_proposals from v_proposal
group by 1, 2, 3""", views=("v_proposal",))
def q_counter_proposals(spark, sf_dir):
    p = fx.v_proposal(Tables(spark, sf_dir)).withColumn("day", F.col("time").cast("date"))
    return ru.daily_counter(p, ["staffing_status", "applicant"], out_col="number_of_proposals")


_STATE_DAYS = ("2024-01-05", "2024-01-15", "2024-01-29")


@register("a26_proposal_state", """
with days as (select cast(d as date) as day from (values ('2024-01-05'), ('2024-01-15'), ('2024-01-29')) t(d)),
h as (select position_id, staffing_status, time as valid_from,
        lead(time) over (partition by position_id order by time, staffing_status) as valid_to from v_proposal)
select d.day, h.position_id, h.staffing_status from days d join h
  on h.valid_from <= d.day and (h.valid_to is null or d.day < h.valid_to)""", views=("v_proposal",))
def q_proposal_state(spark, sf_dir):
    p = fx.v_proposal(Tables(spark, sf_dir))
    return ru.proposal_state(io.days(spark, _STATE_DAYS), p, key="position_id").select(
        "day", "position_id", "staffing_status")


@register("a27_version_state", """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1998-06-01')) t(d))
select d.day, p.position_id, p.primary_skill_id % 5 + 1 as version from days d join v_position p
  on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)""", views=("v_position",))
def q_version_state(spark, sf_dir):
    t = Tables(spark, sf_dir)
    v = fx.v_position(t).select("position_id", (F.col("primary_skill_id") % 5 + 1).alias("version"),
                                "valid_from", "valid_to")
    return snap.validity_join(io.days(spark, ROLLUP_DAYS), v, how="inner").drop("valid_from", "valid_to")


@register("a28_first_workload_month", """
select position_id, min(date_trunc('month', timesheet_date)) :: date as first_workload_month from v_worklog
group by 1""", views=("v_worklog",))
def q_first_month(spark, sf_dir):
    return ru.first_month(fx.v_worklog(Tables(spark, sf_dir)), "position_id", "timesheet_date")


@register("a29_fte_counts", """
select cast(date_trunc('month', w.timesheet_date) as date) as workload_month, s.s_nationkey as unit_id,
  p.container_name, p.customer_id, round(sum(w.hours / 160.0), 6) as sum_fte
from v_worklog w join v_position p on p.position_id = w.position_id join supplier s on s.s_suppkey = w.employee_id
group by 1, 2, 3, 4""", views=("v_worklog", "v_position"))
def q_fte(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = (fx.v_worklog(t).join(fx.v_position(t).select("position_id", "container_name", "customer_id"), "position_id")
         .join(t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("unit_id")),
               "employee_id")
         .select(F.trunc("timesheet_date", "MM").alias("workload_month"), "unit_id", "container_name", "customer_id",
                 (F.col("hours") / 160.0).alias("fte")))
    out = ru.fte_counts(w, ["workload_month", "unit_id", "container_name", "customer_id"])
    return out.withColumn("sum_fte", F.round("sum_fte", 6))
