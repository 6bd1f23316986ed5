"""Event history features: first/last events, running counts, as-of reads, trailing and
weekly growth measures (SURVEY W1–W8, W11, J20, A2, A3, D11).

Scale rule used throughout: events are first aggregated to the (key, day) grain, so a
window partition holds at most one row per day of a key (plus the snapshot probes), never
the raw events of a hot key. As-of reads are unions of probes and facts ordered by day
with a running aggregate — no range join, no pair emission.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import days_between, days_since_if_after, subtract_business_days, week_start
from ..functions.ratios import safe_ratio
from .lookup import first_by

_UNB = Window.unboundedPreceding


def daily_counts(views: DataFrame, key: str, time_col: str, by: Sequence[str] = (),
                 out_col: str = "views") -> DataFrame:
    """A2: events per (key, day[, by...])."""
    return (views.groupBy(key, F.col(time_col).cast("date").alias("day"), *by)
            .agg(F.count(F.lit(1)).alias(out_col)))


def first_event(events: DataFrame, key: str | Sequence[str], time_col: str,
                values: Sequence[str] | None = None) -> DataFrame:
    """Earliest event per key (``DISTINCT ON ... ORDER BY time``; null times last)."""
    return first_by(events, key, time_col, values)


def last_event(events: DataFrame, key: str | Sequence[str], time_col: str,
               values: Sequence[str] | None = None) -> DataFrame:
    """Latest event per key; null times first, as PostgreSQL orders ``DESC``."""
    return first_by(events, key, time_col, values, descending=True, nulls_last=False)


def days_since(snaps: DataFrame, events: DataFrame, key: str, day_col: str, time_col: str,
               name: str) -> DataFrame:
    """``first_<name>_date`` joined per key and ``time_from_first_<name>`` = floor days
    from it to the snapshot day when the day is after it, else 0 (also when missing)."""
    ev = events.select(F.col(key), F.col(time_col).alias(f"{name}_date"))
    out = snaps.join(ev, key, "left")
    return out.withColumn(f"time_from_{name}", days_since_if_after(F.col(day_col), F.col(f"{name}_date")))


def first_and_last_days(snaps: DataFrame, events: DataFrame, key: str, day_col: str, time_col: str, status_col: str,
                        names: dict[str, str]) -> DataFrame:
    """W3 in all forms: for every status (``names``: status to name) the first and the last event's
    date, ``first_<name>_date`` and ``last_<name>_date``, and the days since them at the snapshot.

    One conditional aggregate over the events and one join for all forms. As W1 and W2 order null
    times, a null time is no first event but is the last one.
    """
    aggs = []
    for status, name in names.items():
        hit = F.col(status_col) == status
        aggs.append(F.min(F.when(hit, F.col(time_col))).alias(f"first_{name}_date"))
        last = F.max(F.when(hit, F.struct(F.col(time_col).isNull(), time_col)))
        aggs.append(last[time_col].alias(f"last_{name}_date"))
    dates = events.where(F.col(status_col).isin(*names)).groupBy(key).agg(*aggs)
    out = snaps.join(dates, key, "left")
    return out.withColumns({f"time_from_{which}_{name}": days_since_if_after(F.col(day_col), F.col(f"{which}_{name}_date"))
                            for name in names.values() for which in ("first", "last")})


def event_ordinal(events: DataFrame, key: str, time_col: str, tie: str, out_col: str = "ordinal") -> DataFrame:
    """1-based position of each event inside its key, ordered by (time, tie).

    Skew-safe form: events per (key, day) are counted and accumulated over days (a small
    window), then numbered inside (key, day) — a hot key is spread over its days.
    """
    ev = events.withColumn("__day", F.col(time_col).cast("date"))
    per_day = ev.groupBy(key, "__day").agg(F.count(F.lit(1)).alias("__n"))
    before = per_day.withColumn(
        "__before", F.coalesce(F.sum("__n").over(Window.partitionBy(key).orderBy("__day")
                                                 .rowsBetween(_UNB, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(key, "__day").orderBy(time_col, tie))
    return (ev.withColumn("__r", inside)
            .join(before.select(key, "__day", "__before"), [key, "__day"])
            .withColumn(out_col, (F.col("__before") + F.col("__r")).cast("long"))
            .drop("__day", "__r", "__before"))


def running_status_counts(snaps: DataFrame, events: DataFrame, key: str, day_col: str, time_col: str,
                          status_col: str, statuses: dict[str, str],
                          total_col: str = "total_proposals_changes") -> DataFrame:
    """For each snapshot (key, day) and each status, the number of the key's events
    with that status on or before the day; ``total_col`` sums them.

    ``statuses`` maps output column → status value. Same-day events all count (RANGE
    frame semantics, quirk Q8). Events are reduced to daily counts before the window.
    """
    daily = (events.groupBy(F.col(key), F.col(time_col).cast("date").alias(day_col))
             .agg(*[F.count_if(F.col(status_col) == v).alias(c) for c, v in statuses.items()]))
    probes = snaps.select(key, F.col(day_col).cast("date").alias(day_col)).distinct()
    zeros = probes.select(key, day_col, *[F.lit(0).cast("long").alias(c) for c in statuses])
    w = Window.partitionBy(key).orderBy(day_col).rangeBetween(_UNB, 0)
    unioned = daily.withColumn("__probe", F.lit(False)).unionByName(zeros.withColumn("__probe", F.lit(True)))
    run = unioned.select(key, day_col, "__probe", *[F.sum(c).over(w).alias(c) for c in statuses])
    run = run.where("__probe").drop("__probe")
    run = run.withColumn(total_col, sum((F.col(c) for c in statuses), F.lit(0)))
    return snaps.join(run, [key, day_col], "left").fillna(0, subset=[*statuses, total_col])


def asof(left: DataFrame, right: DataFrame, key: str, day_col: str, cols: Sequence[str],
         strict: bool = False) -> DataFrame:
    """For each left row, the right values of the latest right row with day ≤ left
    day (``strict``: <). Union + ``last(ignorenulls)`` over a per-key day order. Of several
    right rows on one day the one with the largest values (column by column) counts."""
    lkeys = left.select(key, day_col).distinct()
    one = right.groupBy(key, day_col).agg(F.max(F.struct(*cols)).alias("__r"))
    r = one.select(key, day_col, *[F.col("__r")[c].alias(c) for c in cols]).withColumn("__k", F.lit(0 if not strict else 1))
    probe = lkeys.withColumn("__k", F.lit(1 if not strict else 0))
    for c in cols:
        probe = probe.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
    u = r.withColumn("__p", F.lit(False)).unionByName(probe.withColumn("__p", F.lit(True)))
    w = Window.partitionBy(key).orderBy(day_col, "__k").rowsBetween(_UNB, 0)
    vals = [F.last(F.when(~F.col("__p"), F.struct(*cols)), ignorenulls=True).over(w).alias("__v")]
    got = u.select(key, day_col, "__p", *vals).where("__p")
    got = got.select(key, day_col, *[F.col("__v")[c].alias(c) for c in cols])
    return left.join(got, [key, day_col], "left")


def _cumulative(daily: DataFrame, probes: DataFrame, key: str, value: str, out: str,
                inclusive: bool = True) -> DataFrame:
    """Per probe (key, day): sum of ``value`` over daily rows with day ≤ probe day (< when
    not inclusive)."""
    d = daily.select(key, "day", F.col(value).cast("long").alias("__v"), F.lit(0 if inclusive else 1).alias("__k"),
                     F.lit(False).alias("__p"))
    p = probes.select(key, "day", F.lit(None).cast("long").alias("__v"), F.lit(1 if inclusive else 0).alias("__k"),
                      F.lit(True).alias("__p"))
    w = Window.partitionBy(key).orderBy("day", "__k").rowsBetween(_UNB, 0)
    return (d.unionByName(p).select(key, "day", "__p", F.coalesce(F.sum("__v").over(w), F.lit(0)).alias(out))
            .where("__p").drop("__p"))


def trailing_views(snaps: DataFrame, views: DataFrame, key: str, n: int = 5, day_col: str = "day",
                   views_col: str = "views") -> DataFrame:
    """Cumulative views T(d), views in the last ``n`` business days
    ``T(d) - T(d - n business days)`` and their ratio (not ×100); 0 and 0 without views."""
    daily = views.groupBy(key, F.col(day_col).cast("date").alias("day")).agg(F.sum(views_col).alias("__views"))
    s = snaps.select(key, F.col(day_col).cast("date").alias("day")).distinct() \
        .withColumn("prev_day", subtract_business_days(F.col("day"), n))
    probes = s.select(key, "day").unionByName(s.select(key, F.col("prev_day").alias("day"))).distinct()
    cum = _cumulative(daily, probes, key, "__views", "__t")
    cur = cum.withColumnRenamed("__t", "total_views")
    prev = cum.select(key, F.col("day").alias("prev_day"), F.col("__t").alias("__tb"))
    last_n = f"last_{n}_days_views"
    feats = (s.join(cur, [key, "day"], "left").join(prev, [key, "prev_day"], "left")
             .select(key, F.col("day").alias(day_col),
                     (F.coalesce(F.col("total_views"), F.lit(0)) - F.coalesce(F.col("__tb"), F.lit(0)))
                     .alias(last_n), F.col("total_views")))
    feats = feats.withColumn(f"{last_n}_div_total_prev_views",
                             safe_ratio(F.col(last_n).cast("double"), F.col("total_views").cast("double")))
    return snaps.join(feats.drop("total_views"), [key, day_col], "left") \
        .fillna(0, subset=[last_n, f"{last_n}_div_total_prev_views"])


def peak_day_asof(snaps: DataFrame, views: DataFrame, key: str, day_col: str = "day",
                  views_col: str = "views") -> DataFrame:
    """Among the key's view days ≤ the snapshot, the day with the most views (ties:
    earliest day), total views so far, views on the snapshot day and
    ``100·views(d)/T(d)``. Unlike the reference, snapshots after the last view day also
    get the as-of values (it dropped them)."""
    daily = views.groupBy(key, F.col(day_col).cast("date").alias("day")).agg(F.sum(views_col).alias("__views"))
    probes = snaps.select(key, F.col(day_col).cast("date").alias("day")).distinct()
    d = daily.select(key, "day", F.col("__views"), F.lit(False).alias("__p"))
    p = probes.select(key, "day", F.lit(None).cast("long").alias("__views"), F.lit(True).alias("__p"))
    w = Window.partitionBy(key).orderBy("day", "__p").rowsBetween(_UNB, 0)
    best = F.max(F.when(~F.col("__p"), F.struct(F.col("__views").alias("v"),
                                                (-F.unix_date("day")).alias("neg_day"))))
    run = (d.unionByName(p)
           .select(key, "day", "__p", best.over(w).alias("__best"),
                   F.sum("__views").over(w).alias("total_prev_views"))
           .where("__p"))
    run = run.select(key, "day", F.date_from_unix_date(-F.col("__best.neg_day")).alias("date_of_max_views"),
                     F.coalesce(F.col("total_prev_views"), F.lit(0)).cast("long").alias("total_prev_views"))
    run = run.join(daily, [key, "day"], "left").withColumn("views", F.coalesce(F.col("__views"), F.lit(0)).cast("long")) \
        .drop("__views")
    run = run.withColumn("daily_views_div_total_prev_views",
                         safe_ratio(F.col("views") * 100.0, F.col("total_prev_views").cast("double")))
    return snaps.join(run.withColumnRenamed("day", day_col), [key, day_col], "left")


def best_weekly_growth_asof(snaps: DataFrame, views: DataFrame, key: str, day_col: str = "day",
                            views_col: str = "views") -> DataFrame:
    """Weekly view sums per ISO week; ratio to the previous week that has views (the
    first week has none). For a snapshot day d: the best ratio over weeks whose Monday is
    before d (ties: earliest week), kept only if ≥ 1; that week's views V, total views
    so far T and ``100·T/(V+T)``. Clear names here (``growth_week``, ``best_week_views``,
    ``total_views``), and ``snapshot_week`` separately (quirks Q3, Q4)."""
    daily = views.groupBy(key, F.col(day_col).cast("date").alias("day")).agg(F.sum(views_col).alias("__views"))
    weekly = daily.groupBy(key, week_start("day").alias("week")).agg(F.sum("__views").alias("week_views"))
    wl = Window.partitionBy(key).orderBy("week")
    weekly = (weekly.withColumn("__prev", F.lag("week_views").over(wl))
              .where(F.col("__prev").isNotNull())
              .withColumn("ratio", F.col("week_views") / F.col("__prev")))
    probes = snaps.select(key, F.col(day_col).cast("date").alias("day")).distinct()
    wk = weekly.select(key, F.col("week").alias("day"), F.lit(1).alias("__k"), F.lit(False).alias("__p"),
                       F.struct(F.col("ratio"), (-F.unix_date("week")).alias("neg_week"),
                                F.col("week_views")).alias("__s"))
    pr = probes.select(key, "day", F.lit(0).alias("__k"), F.lit(True).alias("__p"),
                       F.lit(None).cast(wk.schema["__s"].dataType).alias("__s"))
    w = Window.partitionBy(key).orderBy("day", "__k").rowsBetween(_UNB, 0)
    best = (wk.unionByName(pr).select(key, "day", "__p", F.max("__s").over(w).alias("__b")).where("__p")
            .where(F.col("__b.ratio") >= 1)
            .select(key, "day", F.col("__b.ratio").alias("growth_ratio"),
                    F.date_from_unix_date(-F.col("__b.neg_week")).alias("growth_week"),
                    F.col("__b.week_views").alias("best_week_views")))
    total = _cumulative(daily, probes, key, "__views", "total_views")
    feats = probes.join(total, [key, "day"], "left").join(best, [key, "day"], "left")
    v = F.coalesce(F.col("best_week_views"), F.lit(0)).cast("double")
    tt = F.coalesce(F.col("total_views"), F.lit(0)).cast("double")
    feats = feats.select(key, F.col("day").alias(day_col), "growth_ratio", "growth_week",
                         F.coalesce(F.col("best_week_views"), F.lit(0)).cast("long").alias("best_week_views"),
                         F.coalesce(F.col("total_views"), F.lit(0)).cast("long").alias("total_views"),
                         safe_ratio(tt * 100.0, v + tt).alias("weekly_view_div_total_prev_views"),
                         week_start(F.col("day")).alias("snapshot_week"))
    return snaps.join(feats, [key, day_col], "left")


def best_version_growth_asof(snaps: DataFrame, versions: DataFrame, key: str, day_col: str = "day",
                             version_col: str = "version") -> DataFrame:
    """Per ISO week the min and max version; growth = max/min; for snapshot day d the
    best growth over weeks whose Monday is before d (ties: earliest week), kept if ≥ 1,
    and ``(max − min) / version(d)`` with version(d) the version on day d (missing → 0 →
    ratio 0, quirk Q10)."""
    v = versions.select(key, F.col(day_col).cast("date").alias("day"), F.col(version_col).cast("double").alias("__v"))
    weekly = (v.groupBy(key, week_start("day").alias("week"))
              .agg(F.min("__v").alias("version_min"), F.max("__v").alias("version_max"))
              .withColumn("growth", safe_ratio(F.col("version_max"), F.col("version_min"), None)))
    probes = snaps.select(key, F.col(day_col).cast("date").alias("day")).distinct()
    wk = weekly.select(key, F.col("week").alias("day"), F.lit(1).alias("__k"), F.lit(False).alias("__p"),
                       F.struct(F.col("growth"), (-F.unix_date("week")).alias("neg_week"),
                                "version_min", "version_max").alias("__s"))
    pr = probes.select(key, "day", F.lit(0).alias("__k"), F.lit(True).alias("__p"),
                       F.lit(None).cast(wk.schema["__s"].dataType).alias("__s"))
    w = Window.partitionBy(key).orderBy("day", "__k").rowsBetween(_UNB, 0)
    best = (wk.unionByName(pr).select(key, "day", "__p", F.max("__s").over(w).alias("__b")).where("__p")
            .where(F.col("__b.growth") >= 1)
            .select(key, "day", F.col("__b.growth").alias("version_growth"),
                    F.date_from_unix_date(-F.col("__b.neg_week")).alias("growth_week"),
                    F.col("__b.version_min").alias("version_min"), F.col("__b.version_max").alias("version_max")))
    cur = v.groupBy(key, "day").agg(F.max("__v").alias("current_version"))
    feats = best.join(cur, [key, "day"], "left").withColumn(
        "current_version", F.coalesce(F.col("current_version"), F.lit(0.0)))
    feats = feats.withColumn("max_growth_per_week_div_current_version",
                             safe_ratio(F.col("version_max") - F.col("version_min"), F.col("current_version")))
    return snaps.join(feats.withColumnRenamed("day", day_col), [key, day_col], "left")


# Proposal statuses and applicant kinds counted per position and day.
PROPOSAL_STATUSES = ("Proposed", "Booked", "Onboarding", "Preselected")
APPLICANT_KINDS = ("total", "external", "internal")


def proposal_counts(df: DataFrame, key: str, day_col: str, status_col: str = "staffing_status",
                    kind_col: str = "applicant", statuses: Sequence[str] = PROPOSAL_STATUSES,
                    kinds: Sequence[str] = APPLICANT_KINDS) -> DataFrame:
    """A3: current proposals per (key, day): for each kind (total / external / internal)
    the count per status (``<status>_<kind>_current_proposals``) and over all statuses
    (``total_<kind>``); one aggregate with conditional counts."""
    aggs = []
    for kind in kinds:
        kc = F.lit(True) if kind == "total" else (F.col(kind_col) == kind)
        for s in statuses:
            aggs.append(F.count_if(kc & (F.col(status_col) == s)).alias(f"{s.lower()}_{kind}_current_proposals"))
        aggs.append(F.count_if(kc).alias(f"total_{kind}"))
    return df.groupBy(key, day_col).agg(*aggs)


def distance_features(df: DataFrame, date_col: str, day_col: str = "day",
                      planned_start_col: str = "planned_start_date",
                      denominators: Sequence[str] = ()) -> DataFrame:
    """For date column x: ``time_from_<x>`` = floor days(d − x) if d ≥ x else 0;
    ``time_from_<x>_to_planned_start`` = floor days(planned_start − x) if d ≥ x else 0;
    each also ×100 over every denominator column (null / ±inf / 0 → 0)."""
    after = F.col(day_col).cast("timestamp") >= F.col(date_col).cast("timestamp")
    a = F.when(after, days_between(date_col, day_col)).otherwise(0)
    b = F.when(after, days_between(date_col, planned_start_col)).otherwise(0)
    na, nb = f"time_from_{date_col}", f"time_from_{date_col}_to_planned_start"
    out = df.withColumn(na, a).withColumn(nb, b)
    for den in denominators:
        out = out.withColumn(f"{na}_div_{den}", safe_ratio(F.col(na) * 100.0, F.col(den)))
        out = out.withColumn(f"{nb}_div_{den}", safe_ratio(F.col(nb) * 100.0, F.col(den)))
    return out
