"""Location × skill × target roll-ups and the daily counters that feed them
(SURVEY A4–A8, A19–A29).

A4 in Spark terms: the feature rows are aggregated once over twelve grouping sets
({city, country, all} × {skill, category, prefix, all}), the targets side by side. The
positions' distinct sets of skills and places are expanded to one row per (level, location
key, skill key) — the distinct cities / countries for the location levels — and joined to
the aggregate on (level, day, keys) in a single equi-join; one aggregate per set turns
levels × targets into columns, which every position of the set then gets in one join.
AQE's skew handling splits a set that very many positions share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ratios import safe_ratio
from .snapshots import validity_counts, validity_join

UNDEFINED = "__UNDEFINED__"
# Level names used in feature column names.
CITY_LEVEL = "staffing_locations_city_id"
COUNTRY_LEVEL = "staffing_locations_country_id"
SKILL_LEVELS = ("primary_skill_id", "primary_skill_category_id", "skill_prefix")
TOTAL = "total"
CELL = ("__ll", "__lk", "__sl", "__sk")


def target_slug(target: str) -> str:
    return str(target).replace(" ", "_").lower()


def _slug(col: str) -> Column:
    return F.lower(F.regexp_replace(F.col(col).cast("string"), " ", "_"))


def level_suffix(loc: str, skill: str) -> str:
    if loc == TOTAL and skill == TOTAL:
        return "company"
    if loc == TOTAL:
        return skill
    if skill == TOTAL:
        return loc
    return f"{loc}_{skill}"


def feature_names(prefix: str, targets: Sequence[str]) -> list[str]:
    return [f"{prefix}_{target_slug(t)}_{level_suffix(l, s)}"
            for l in (CITY_LEVEL, COUNTRY_LEVEL, TOTAL) for s in (*SKILL_LEVELS, TOTAL) for t in targets]


def _checked_targets(targets: Sequence[str]) -> list[str]:
    """The targets, none of which may share a column name with another."""
    by_slug: dict[str, str] = {}
    for t in targets:
        other = by_slug.setdefault(target_slug(t), t)
        if other != t:
            raise ValueError(f"targets {other!r} and {t!r} share the column name {target_slug(t)!r}")
    return list(by_slug.values())


def level_sums(feat: DataFrame, base: Sequence[str], target_col: str, value_col: str, city_col: str = "city_id",
               country_col: str = "country_id") -> DataFrame:
    """The feature summed over the twelve grouping sets: base, ``__target``, location level and
    key ``__ll``/``__lk``, skill level and key ``__sl``/``__sk``, sum ``__v``."""
    lvl_cols = [city_col, country_col, *SKILL_LEVELS]
    f = feat.select(*base, F.col(target_col).alias("__target"), F.col(value_col).alias("__value"),
                    *[F.col(c).cast("string").alias(c) for c in lvl_cols])
    sets = []
    for loc in (city_col, country_col, None):
        for sk in (*SKILL_LEVELS, None):
            sets.append([*base, "__target", *([loc] if loc else []), *([sk] if sk else [])])
    agg = f.groupingSets(sets, *base, "__target", *lvl_cols).agg(
        F.sum("__value").alias("__v"), *[F.grouping(c).alias(f"__g_{c}") for c in lvl_cols])
    loc_level = (F.when(F.col(f"__g_{city_col}") == 0, F.lit(CITY_LEVEL))
                 .when(F.col(f"__g_{country_col}") == 0, F.lit(COUNTRY_LEVEL)).otherwise(F.lit(TOTAL)))
    loc_key = F.coalesce(F.when(F.col(f"__g_{city_col}") == 0, F.col(city_col))
                         .when(F.col(f"__g_{country_col}") == 0, F.col(country_col)).otherwise(F.lit("")),
                         F.lit(UNDEFINED))
    sk_level = F.lit(TOTAL)
    sk_key = F.lit("")
    for s in reversed(SKILL_LEVELS):
        sk_level = F.when(F.col(f"__g_{s}") == 0, F.lit(s)).otherwise(sk_level)
        sk_key = F.when(F.col(f"__g_{s}") == 0, F.coalesce(F.col(s), F.lit(UNDEFINED))).otherwise(sk_key)
    return agg.select(*base, "__target", "__v", loc_level.alias("__ll"), loc_key.alias("__lk"),
                      sk_level.alias("__sl"), sk_key.alias("__sk"))


def position_cells(pos: DataFrame, key: str, base: Sequence[str], city_col: str = "city_id",
                   country_col: str = "country_id") -> DataFrame:
    """The distinct (level, key) cells that a position reads, as (key, base, ``__ll``, ``__lk``, ``__sl``, ``__sk``)."""
    skills = F.array(*[F.struct(F.lit(s).alias("__sl"), F.coalesce(F.col(s).cast("string"), F.lit(UNDEFINED))
                                .alias("__sk")) for s in SKILL_LEVELS],
                     F.struct(F.lit(TOTAL).alias("__sl"), F.lit("").alias("__sk")))
    # one pass over the positions: their distinct locations of each level, then one row per (level, skill) key
    near = pos.groupBy(key, *base, *SKILL_LEVELS).agg(
        F.collect_set(F.col(city_col).cast("string")).alias("__cities"), F.collect_set(F.col(country_col).cast("string")).alias("__countries"))
    at = lambda level: lambda k: F.struct(F.lit(level).alias("__ll"), k.alias("__lk"))
    places = F.concat(F.transform("__cities", at(CITY_LEVEL)), F.transform("__countries", at(COUNTRY_LEVEL)), F.array(at(TOTAL)(F.lit(""))))
    return (near.select(key, *base, F.explode(places).alias("__p"), skills.alias("__skills"))
            .select(key, *base, "__p.*", F.explode("__skills").alias("__s"))
            .select(key, *base, "__ll", "__lk", "__s.__sl", "__s.__sk"))


def feature_name(prefix: str) -> Column:
    """The name of the feature column of a row with ``__ll``, ``__sl`` and ``__target``."""
    suffix = (F.when((F.col("__ll") == TOTAL) & (F.col("__sl") == TOTAL), F.lit("company"))
              .when(F.col("__ll") == TOTAL, F.col("__sl"))
              .when(F.col("__sl") == TOTAL, F.col("__ll"))
              .otherwise(F.concat(F.col("__ll"), F.lit("_"), F.col("__sl"))))
    return F.concat(F.lit(prefix + "_"), _slug("__target"), F.lit("_"), suffix)


def rollup_features(pos: DataFrame, feat: DataFrame, target_col: str, value_col: str, prefix: str,
                    targets: Sequence[str], key: str = "position_id", day_col: str = "day",
                    city_col: str = "city_id", country_col: str = "country_id",
                    scope_key: str | None = None, res_type: str = "int") -> DataFrame:
    """A4: feature summed at twelve location × skill levels per target, attached to each
    (position, day).

    ``pos``: one row per (position, day, location) with ``city_col``/``country_col`` and
    the skill columns ``primary_skill_id``, ``primary_skill_category_id``,
    ``skill_prefix``. ``feat``: rows (day, skill columns, city, country, target, value).
    Location levels add each *distinct* city (country) of the position once; the other
    levels read the value at the position's own skill key. Missing → 0; the result is cast
    to ``res_type``. ``targets`` names the values that become columns (their names must
    differ after lower-casing; rows with other or null targets count nowhere). ``scope_key`` (A6) is an extra key on both sides (customer,
    container). Output: ``key, day[, scope], <prefix>_<target>_<level>...``.
    """
    base = [day_col] + ([scope_key] if scope_key else [])
    near = position_places(pos, key, base, city_col, country_col)
    return rollup_at_places(near, feat, target_col, value_col, prefix, targets, key, day_col, city_col, country_col, scope_key, res_type)


def position_places(pos: DataFrame, key: str, base: Sequence[str], city_col: str = "city_id", country_col: str = "country_id") -> DataFrame:
    """(key, base, ``__places``): a position's distinct sets of skills and place, in order."""
    place = F.struct(*SKILL_LEVELS, F.col(city_col).cast("string").alias(city_col), F.col(country_col).cast("string").alias(country_col))
    return pos.groupBy(key, *base).agg(F.array_sort(F.collect_set(place)).alias("__places"))


def rollup_at_places(near: DataFrame, feat: DataFrame, target_col: str, value_col: str, prefix: str, targets: Sequence[str],
                     key: str = "position_id", day_col: str = "day", city_col: str = "city_id", country_col: str = "country_id",
                     scope_key: str | None = None, res_type: str = "int") -> DataFrame:
    """``rollup_features`` for positions whose ``position_places`` are known, so that several roll-ups can share them."""
    tv = _checked_targets(targets)
    base = [day_col] + ([scope_key] if scope_key else [])
    # a cell has its targets side by side, so that a position meets it once
    slug = _slug("__target")
    sums = [F.sum(F.when(slug == target_slug(t), F.col("__v"))).alias(f"__t{i}") for i, t in enumerate(tv)]
    agg = level_sums(feat, base, target_col, value_col, city_col, country_col).groupBy(*base, *CELL).agg(*sums)
    # what a position reads follows from its skills and places alone: each set of them is looked up once
    sets = near.select(*base, "__places").distinct()
    plong = position_cells(sets.select(*base, "__places", F.inline("__places")), "__places", base, city_col, country_col)
    joined = plong.join(agg, [*base, *CELL], "left")
    levels = [(l, s) for l in (CITY_LEVEL, COUNTRY_LEVEL, TOTAL) for s in (*SKILL_LEVELS, TOTAL)]
    names = feature_names(prefix, tv)
    wide = joined.groupBy("__places", *base).agg(*(
        F.sum(F.when((F.col("__ll") == l) & (F.col("__sl") == s), F.col(f"__t{i}"))).alias(f"__f{j * len(tv) + i}")
        for j, (l, s) in enumerate(levels) for i in range(len(tv))))
    wide = wide.select(F.col("__places").alias("__set"), *(F.col(c).alias(f"__b{i}") for i, c in enumerate(base)),
                       *(F.coalesce(F.col(f"__f{i}"), F.lit(0)).cast(res_type).alias(n) for i, n in enumerate(names)))
    same = F.col("__places") == F.col("__set")
    for i, c in enumerate(base):
        same = same & F.col(c).eqNullSafe(F.col(f"__b{i}"))
    return near.join(wide, same).select(key, *base, *names)


def total_over_targets(df: DataFrame, prefix: str, targets: Sequence[str], out_slug: str = "total") -> DataFrame:
    """Sum of the target columns at each of the twelve levels."""
    exprs = []
    for l in (CITY_LEVEL, COUNTRY_LEVEL, TOTAL):
        for s in (*SKILL_LEVELS, TOTAL):
            suf = level_suffix(l, s)
            exprs.append(sum((F.col(f"{prefix}_{target_slug(t)}_{suf}") for t in targets), F.lit(0))
                         .alias(f"{prefix}_{out_slug}_{suf}"))
    return df.select("*", *exprs)


def supply_vs_demand(df: DataFrame, supply_prefix: str, demand_prefix: str,
                     out_prefix: str = "supply_vs_demand") -> DataFrame:
    """Supply / demand at the twelve levels (undefined → 0). Column pairs are
    ``<supply_prefix>_<suffix>`` over ``<demand_prefix>_<suffix>``."""
    exprs = []
    for l in (CITY_LEVEL, COUNTRY_LEVEL, TOTAL):
        for s in (*SKILL_LEVELS, TOTAL):
            suf = level_suffix(l, s)
            exprs.append(safe_ratio(F.col(f"{supply_prefix}_{suf}"), F.col(f"{demand_prefix}_{suf}"))
                         .alias(f"{out_prefix}_{suf}"))
    return df.select("*", *exprs)


# --- daily counters (A19–A29, inferred from their consumers) -------------------------
def daily_counter(snap_rows: DataFrame, by: Sequence[str], day_col: str = "day",
                  out_col: str = "number_of_positions", distinct_of: str | None = None) -> DataFrame:
    """Rows per (day, by...) — or distinct ``distinct_of`` values."""
    agg = F.countDistinct(distinct_of) if distinct_of else F.count(F.lit(1))
    return snap_rows.groupBy(day_col, *by).agg(agg.alias(out_col))


def active_counts(days: DataFrame, positions: DataFrame, by: Sequence[str], day_col: str = "day",
                  out_col: str = "number_of_positions") -> DataFrame:
    """Positions valid on each snapshot day, counted per keys (the sweep form
    of a validity join + count, see ``validity_counts``)."""
    return validity_counts(days, positions.select(*by, "valid_from", "valid_to"), by, day_col=day_col,
                           out_col=out_col)


# Bench duration buckets (upper bounds in days, inclusive) and labels.
BENCH_BUCKETS = ((30, "0-30"), (60, "31-60"), (90, "61-90"))
BENCH_TOP = "90+"


def bench_rows(days: DataFrame, worklog: DataFrame, employee: str = "employee_id", day_col: str = "day",
               ts_col: str = "timesheet_date", billable_col: str = "billable", min_gap: int = 14) -> DataFrame:
    """A22/A23 input: for each snapshot day and each employee known by then, the days
    since the employee's last billable day on or before the snapshot; bench when that
    gap is ≥ ``min_gap`` or there was none.

    Employees per day come from their first timesheet (validity from it, open end), so
    the day × employee rows are a validity join of a broadcast day list.
    """
    from .history import asof
    first = (worklog.groupBy(employee).agg(F.min(F.col(ts_col).cast("date")).alias("valid_from"))
             .withColumn("valid_to", F.lit(None).cast("date")))
    emp_days = validity_join(days, first, day_col=day_col, how="inner").select(day_col, employee)
    bill = (worklog.where(F.col(billable_col)).select(employee, F.col(ts_col).cast("date").alias(day_col))
            .distinct().withColumn("last_billable", F.col(day_col)))
    got = asof(emp_days, bill, employee, day_col, ["last_billable"])
    gap = F.datediff(F.col(day_col), F.col("last_billable"))
    return got.withColumn("bench_days", gap).where(F.col("last_billable").isNull() | (gap >= min_gap))


def bench_bucket(days_col) -> "F.Column":
    """Bucket label of a bench duration."""
    c = F.col(days_col) if isinstance(days_col, str) else days_col
    out = F.lit(BENCH_TOP)
    for upper, label in reversed(BENCH_BUCKETS):
        out = F.when(c <= upper, F.lit(label)).otherwise(out)
    return F.when(c.isNull(), F.lit(BENCH_TOP)).otherwise(out)


def daily_hours(worklog: DataFrame, by: Sequence[str], day_col: str = "timesheet_date",
                hours_col: str = "hours", billable_col: str = "billable", trip_col: str | None = None) -> DataFrame:
    """Total, in-trip and billable hours per (day, by...)."""
    aggs = [F.sum(hours_col).alias("total_hours"),
            F.sum(F.when(F.col(billable_col), F.col(hours_col)).otherwise(0.0)).alias("billable_hours")]
    if trip_col:
        aggs.append(F.sum(F.when(F.col(trip_col), F.col(hours_col)).otherwise(0.0)).alias("in_trip_hours"))
    return worklog.groupBy(day_col, *by).agg(*aggs)


def proposal_state(days: DataFrame, proposals: DataFrame, key: str = "proposal_id",
                   time_col: str = "time", status_col: str = "staffing_status", day_col: str = "day",
                   carry: Sequence[str] = ()) -> DataFrame:
    """Per snapshot day, each key's latest status on or before the day (events
    ordered by time, then status; the last one wins).

    Skew-safe form: a snapshot day sees an event from the event's *effective day* (its
    date when it falls on midnight, else the next day). Events are first reduced to the
    last one per (key, effective day) — a ``max`` of a struct, combined map-side — so the
    ``lead`` that turns them into ranges [day, next day) runs over at most one row per
    key and calendar day, however many events a hot key holds; then a validity join with
    the day list."""
    from pyspark.sql import Window
    from .snapshots import _first_last_day
    eff, _ = _first_last_day(F.col(time_col), F.lit(None))
    last = (proposals.select(key, eff.alias("__e"), F.struct(F.col(time_col).alias("__t"), F.col(status_col).alias("__s"),
                                                             *[F.col(c) for c in carry]).alias("__x"))
            .groupBy(key, "__e").agg(F.max("__x").alias("__x")))
    w = Window.partitionBy(key).orderBy("__e")
    hist = last.select(key, *[F.col(f"__x.{c}").alias(c) for c in carry], F.col("__x.__s").alias(status_col),
                       F.col("__e").alias("valid_from"), F.lead("__e").over(w).alias("valid_to"))
    return validity_join(days, hist, day_col=day_col, how="inner").drop("valid_from", "valid_to")


def first_month(df: DataFrame, key: str, month_col: str, out_col: str = "first_workload_month") -> DataFrame:
    """First workload month per key."""
    return df.groupBy(key).agg(F.min(F.trunc(F.col(month_col).cast("date"), "MM")).alias(out_col))


def fte_counts(df: DataFrame, by: Sequence[str], fte_col: str = "fte", out_col: str = "sum_fte") -> DataFrame:
    """FTE summed per workload month and keys."""
    return df.groupBy(*by).agg(F.sum(fte_col).alias(out_col))
