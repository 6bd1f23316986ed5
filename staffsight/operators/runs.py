"""Run-versioned results and backfill planning.

Result tables are appended once per run; readers want the newest run per business date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def latest_run(df: DataFrame, date_col: str = "date", run_col: str = "run_id",
               dates: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Keep rows of the newest run of each date.

    Default (``strict=False``) reproduces the reference: rows are kept when their
    ``run_id`` is the newest of *some* date, so a run newest for one date also brings its
    rows of other dates (quirk Q1). ``strict=True`` matches on (date, run_id). ``dates``
    restricts the dates considered when choosing runs (the inner ``IN`` list).
    The per-date maxima are a small aggregate; the semi join is broadcast by Catalyst.
    """
    src = df if dates is None else df.join(dates.select(F.col(dates.columns[0]).alias(date_col)),
                                           date_col, "left_semi")
    newest = src.groupBy(date_col).agg(F.max(run_col).alias(run_col))
    if strict:
        return df.join(newest, [date_col, run_col], "left_semi")
    return df.join(newest.select(run_col).distinct(), run_col, "left_semi")


def latest_run_on_dates(df: DataFrame, dates: DataFrame, date_col: str = "date",
                        run_col: str = "run_id") -> DataFrame:
    """Latest-run read (over all dates) whose rows are then restricted to ``dates``."""
    keep = dates.select(F.col(dates.columns[0]).alias(date_col))
    return latest_run(df, date_col, run_col).join(keep, date_col, "left_semi")


def newest_run_totals(df: DataFrame, key: str, value: str, run_col: str = "run_id",
                      out_col: str | None = None) -> DataFrame:
    """Rows of the newest run of the whole table, summed per key."""
    newest = df.agg(F.max(run_col).alias(run_col))
    return (df.join(F.broadcast(newest), run_col, "left_semi")  # one row
            .groupBy(key).agg(F.sum(value).alias(out_col or f"sum_{value}")))


def complete_days(pred: DataFrame, date_col: str, scope_col: str, start=None, end=None,
                  n_scopes: int = 3) -> DataFrame:
    """Days (inside [start, end]) having predictions for ``n_scopes`` distinct scopes."""
    p = pred
    if start is not None:
        p = p.where(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        p = p.where(F.col(date_col) <= F.lit(end).cast("date"))
    return (p.select(date_col, scope_col).distinct().groupBy(date_col)
            .agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == n_scopes).select(date_col))


def best_params(df: DataFrame, task: str, by: str = "run_id", task_col: str = "task_type",
                params_col: str = "best_params", metrics_col: str = "metrics") -> DataFrame:
    """Stored parameters of the newest run (``by='run_id'``) or of the best value of a
    metric inside the ``metrics`` JSON (largest wins, as in the reference; equal metric
    values go to the newest run). One row."""
    d = df.where(F.col(task_col) == task)
    if by == "run_id":
        key = F.col("run_id")
        order = key
    else:
        key = F.get_json_object(F.col(metrics_col), f"$.{by}").cast("double")
        order = F.struct(key, F.col("run_id"))
    return d.agg(F.max_by(F.col(params_col), order).alias(params_col), F.max(key).alias("chosen_by"))


def model_validity(registry: DataFrame, scope_col: str = "scope", date_col: str = "date",
                   path_col: str = "path") -> DataFrame:
    """Per scope, each model's ``next_date`` (the next model's date); consecutive
    intervals share the boundary day (Q19). ``path`` is forward-filled over nulls."""
    w = Window.partitionBy(scope_col).orderBy(date_col)
    out = registry.withColumn("next_date", F.lead(date_col).over(w))
    if path_col in registry.columns:
        out = out.withColumn(path_col, F.last(path_col, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
    return out


def wanted_days(spark: SparkSession, start, end, weekly: bool = False, col: str = "date") -> DataFrame:
    """Training days between ``start`` and ``end``: month ends, or (``weekly``) every
    seventh day from each month's first day plus the month end."""
    s = F.trunc(F.lit(start).cast("date"), "MM")
    months = spark.range(1).select(F.explode(F.sequence(s, F.lit(end).cast("date"),
                                                        F.expr("interval 1 month"))).alias("m"))
    if not weekly:
        out = months.select(F.last_day("m").alias(col))
    else:
        out = months.select(F.explode(F.array_union(
            F.sequence(F.col("m"), F.last_day("m"), F.expr("interval 7 day")),
            F.array(F.last_day("m")))).alias(col))
    return out.where((F.col(col) >= F.lit(start).cast("date")) & (F.col(col) <= F.lit(end).cast("date")))


def missing_models(wanted: DataFrame, models: DataFrame, date_col: str = "date") -> DataFrame:
    """Wanted days without a model of any scope (anti join)."""
    return wanted.join(models.select(date_col).distinct(), date_col, "left_anti")


def missing_predictions(registry: DataFrame, predictions: DataFrame, until, scope_col: str = "scope",
                        date_col: str = "date", n_scopes: int = 3) -> DataFrame:
    """For each model interval [date, next_date] (the newest model runs until
    ``until``), the days not fully predicted (fewer than ``n_scopes`` scopes)."""
    iv = model_validity(registry.select(scope_col, date_col).distinct(), scope_col, date_col)
    upto = F.coalesce(F.col("next_date"), F.lit(until).cast("date"))
    # a newest model after ``until`` has no day to predict; sequence() would count backwards
    days = iv.where(F.col(date_col) <= upto).select(F.explode(F.sequence(F.col(date_col), upto)).alias("day")).distinct()
    done = complete_days(predictions, date_col, scope_col, n_scopes=n_scopes)
    return days.join(done.withColumnRenamed(date_col, "day"), "day", "left_anti")


def distinct_union(*dfs: DataFrame) -> DataFrame:
    """Distinct union of day sets."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def set_difference(wanted: DataFrame, done: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``wanted`` whose key is not in ``done``."""
    return wanted.join(done, on, "left_anti")
