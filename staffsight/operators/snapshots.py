"""Bitemporal snapshots.

History tables carry a half-open validity range ``[valid_from, valid_to)``; a null
``valid_to`` is open. A snapshot day ``d`` sees a row when
``valid_from <= d AND (valid_to IS NULL OR d < valid_to)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def valid_on(day: Column, frm: Column, to: Column) -> Column:
    d = day.cast("timestamp_ntz")
    return (frm.cast("timestamp_ntz") <= d) & (to.isNull() | (d < to.cast("timestamp_ntz")))


def validity_join(days: DataFrame, hist: DataFrame, frm: str = "valid_from", to: str = "valid_to",
                  day_col: str = "day", how: str = "left") -> DataFrame:
    """Attach to each snapshot day every history row valid on that day.

    ``how='left'`` keeps days that see no row (history columns null), ``'inner'`` drops
    them. Each history row is expanded to the months of its range inside the day span and
    equi-joined with the days on the month; the exact range test is the join's residual.
    A row without a start is never valid.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    days = days.select(F.col(day_col).cast("date").alias(day_col)).distinct()
    lo, hi = days.agg(F.min(day_col), F.max(day_col)).first()  # two scalars
    first, last = _first_last_day(F.col(frm), F.col(to))
    a, b = F.greatest(first, F.lit(lo).cast("date")), F.least(last, F.lit(hi).cast("date"))
    months = F.sequence(F.trunc(a, "MM"), F.trunc(b, "MM"), F.expr("interval 1 month"))
    by_month = hist.where(F.col(frm).isNotNull() & (a <= b)).withColumn("__m", F.explode(months))
    on_day = days.select(F.col(day_col).alias("__day"), F.trunc(day_col, "MM").alias("__month"))
    matched = by_month.join(on_day, (F.col("__m") == F.col("__month")) & valid_on(F.col("__day"), F.col(frm), F.col(to)))
    matched = matched.select(F.col("__day").alias(day_col), *[c for c in hist.columns if c != day_col])
    if how == "inner":
        return matched
    # days some row covers, from the sweep (O(rows)) rather than from the joined rows,
    # which would run the whole join a second time
    seen = validity_counts(days, hist.select(frm, to), [], frm, to, day_col, "__n").select(day_col)
    empty_days = days.join(seen, day_col, "left_anti")
    return matched.unionByName(empty_days, allowMissingColumns=True)


def _first_last_day(frm: Column, to: Column) -> tuple[Column, Column]:
    """First and last calendar day a ``[frm, to)`` range is valid on (days at midnight):
    a start with a time of day begins the next day; an end at midnight excludes that day;
    an open end gives a null last day."""
    f, t = frm.cast("timestamp_ntz"), to.cast("timestamp_ntz")
    first = F.when(f.cast("date").cast("timestamp_ntz") == f, f.cast("date")).otherwise(F.date_add(f.cast("date"), 1))
    last = F.when(t.cast("date").cast("timestamp_ntz") == t, F.date_sub(t.cast("date"), 1)).otherwise(t.cast("date"))
    return first, last


def validity_counts(days: DataFrame, hist: DataFrame, by: Sequence[str] = (), frm: str = "valid_from",
                    to: str = "valid_to", day_col: str = "day", out_col: str = "n") -> DataFrame:
    """J1 + count: rows of ``hist`` valid on each snapshot day per ``by`` keys — the same
    result as ``validity_join(...).groupBy(day, *by).count()`` (days without rows absent)
    without materialising one row per (row, day).

    Sweep: every row adds +1 on its first valid day and -1 the day after its last; the
    deltas are summed per (keys, day) map-side, a running sum per key over the event days
    gives constant segments ``[event, next event)``, and the day list is joined to the
    segments. Work is O(rows + keys × event days) instead of O(rows × days); a key holding
    a large share of the rows costs no more than its distinct event days."""
    from pyspark.sql import Window
    by = list(by)
    first, last = _first_last_day(F.col(frm), F.col(to))
    ev = hist.where(F.col(frm).isNotNull()).select(*by, first.alias("__a"), last.alias("__b")).where(F.col("__b").isNull() | (F.col("__a") <= F.col("__b")))
    deltas = F.array(F.struct(F.col("__a").alias("__e"), F.lit(1).alias("__d")),
                     F.struct(F.date_add(F.col("__b"), 1).alias("__e"), F.lit(-1).alias("__d")))
    ev = (ev.select(*by, F.explode(deltas).alias("__x")).where(F.col("__x.__e").isNotNull())
          .groupBy(*by, F.col("__x.__e").alias("__e")).agg(F.sum("__x.__d").alias("__d")))
    w = Window.partitionBy(*by).orderBy("__e")
    seg = ev.select(*by, "__e", F.sum("__d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                    .alias(out_col), F.lead("__e").over(w).alias("__next")).where(F.col(out_col) != 0)
    j = validity_join(days, seg, frm="__e", to="__next", day_col=day_col, how="inner")
    return j.select(day_col, *by, F.col(out_col).cast("long").alias(out_col))


def as_at(hist: DataFrame, ts, frm: str = "valid_from", to: str = "valid_to") -> DataFrame:
    """The rows of a validity table valid at one instant (a pushed-down filter)."""
    return hist.where(valid_on(F.lit(ts), F.col(frm), F.col(to)))


def open_workload(days: DataFrame, workload: DataFrame, key: str, start_col: str, value_col: str,
                  frm: str = "valid_from", to: str = "valid_to", day_col: str = "day",
                  out_col: str = "total_workload") -> DataFrame:
    """Per (day, key) the sum of ``value_col`` over workload rows valid on the day whose
    ``start_col`` is on or after the day."""
    j = validity_join(days, workload.select(key, start_col, value_col, frm, to), frm, to, day_col, "inner")
    return (j.where(F.col(day_col).cast("timestamp_ntz") <= F.col(start_col).cast("timestamp_ntz"))
            .groupBy(day_col, key).agg(F.sum(value_col).alias(out_col)))


# Statuses the reference treats as not active.
CLOSED_STATUSES = ("Terminated", "On Hold", "Closed")


def active_positions(df: DataFrame, created_from=None, closed_statuses: Sequence[str] = CLOSED_STATUSES,
                     billing_type: str | None = "1", exclude_customers: Iterable = (),
                     status_col: str = "staffing_status", created_col: str = "created",
                     billing_col: str = "billing_type_id", customer_col: str = "customer_id") -> DataFrame:
    """Active-position predicate. A null status drops the row, as in SQL ``NOT IN``."""
    cond = F.col(status_col).isNotNull() & ~F.col(status_col).isin(*closed_statuses)
    if created_from is not None:
        cond = cond & (F.col(created_col) >= F.lit(created_from).cast("timestamp_ntz"))
    if billing_type is not None:
        cond = cond & (F.col(billing_col) == F.lit(billing_type))
    excl = list(exclude_customers)
    if excl:
        cond = cond & ~F.col(customer_col).isin(*excl)
    return df.where(cond)


def before_event(df: DataFrame, day_col: str, event_col: str, mode: str = "either") -> DataFrame:
    """Keep snapshot rows before an event. ``before``: day strictly before the event
    (rows without the event drop, as in SQL); ``missing``: the event is absent;
    ``either``: one or the other."""
    before = F.col(day_col).cast("timestamp_ntz") < F.col(event_col).cast("timestamp_ntz")
    missing = F.col(event_col).isNull()
    cond = {"before": before, "missing": missing, "either": missing | before}.get(mode)
    if cond is None:
        raise ValueError("mode must be before, missing or either")
    return df.where(cond)


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key is in ``keys`` (a semi join; Catalyst broadcasts the key
    side when it is small and shuffles both sides otherwise)."""
    return df.join(keys.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_semi")


def latest_snapshot(df: DataFrame, day_col: str = "day") -> DataFrame:
    """P5: rows of the newest snapshot day only (scalar max subquery)."""
    newest = df.agg(F.max(day_col).alias("__newest"))
    return df.join(F.broadcast(newest), F.col(day_col) == F.col("__newest"), "left_semi")


def billable_span(worklog: DataFrame, key: str = "position_id", day_col: str = "timesheet_date",
                  billable_col: str = "billable") -> DataFrame:
    """A1: first and last billable day per key in one aggregate."""
    return (worklog.where(F.col(billable_col))
            .groupBy(key).agg(F.min(day_col).alias("first_billable_date"),
                              F.max(day_col).alias("last_billable_date")))


def with_group_max(df: DataFrame, key: str | Sequence[str], col: str, out_col: str = "max_date") -> DataFrame:
    """The group's maximum of ``col`` carried on every row.

    Written as a partial aggregate joined back rather than a window, so a key holding a
    large share of the rows is not sorted in one task (AQE splits the skewed join side).
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(df.groupBy(*keys).agg(F.max(col).alias(out_col)), keys, "left")
