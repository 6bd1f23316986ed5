"""Data-quality checks.

The lazy forms (``duplicate_keys``, ``reconcile``, ``non_empty_report``) return
DataFrames; the ``assert_*`` forms run one small action and raise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(dim: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once (empty means a lookup cannot change row counts)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique(dim: DataFrame, keys: Sequence[str] | str) -> None:
    bad = duplicate_keys(dim, keys).limit(5).collect()
    if bad:
        raise AssertionError(f"lookup keys not unique, e.g. {bad}")


def reconcile(matrix: DataFrame, source: DataFrame, keys: Sequence[str], matrix_value: str,
              source_value: str, tolerance: float = 1e-6) -> DataFrame:
    """Totals per level key in the feature matrix against the source; returns the
    levels that differ (full outer, so a level missing on either side shows too).

    The reference checked one random key; this compares every key in one job.
    """
    a = matrix.groupBy(*keys).agg(F.sum(matrix_value).alias("matrix_total"))
    b = source.groupBy(*keys).agg(F.sum(source_value).alias("source_total"))
    j = a.join(b, list(keys), "full")
    diff = F.abs(F.coalesce(F.col("matrix_total"), F.lit(0)) - F.coalesce(F.col("source_total"), F.lit(0)))
    return j.where(diff > tolerance)


def non_empty_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A37 (lazy): one row with the sum of each feature column."""
    return df.agg(*[F.sum(c).cast("double").alias(f"sum_{c}") for c in cols])


def assert_non_empty(df: DataFrame, cols: Sequence[str]) -> None:
    """Every listed feature column sums to more than zero."""
    row = non_empty_report(df, cols).first().asDict()
    empty = [k for k, v in row.items() if not v or v <= 0]
    if empty:
        raise AssertionError(f"empty feature columns: {empty}")
