"""Reconciliation of a roll-up matrix with its source on all twelve levels.

The check goes down the lattice and opens only what differs:

1. per feature column (level and target) one checksum over all rows, on the matrix side a
   single aggregate without a join, on the source side the cell sums times the weights of the
   positions that read the cell;
2. per day, for the columns that differ;
3. per cell (day, places, skill), for the days and columns that differ.

A checksum is the sum of value x weight, the weight of a (position, day) being taken from its
hash, so that errors of opposite sign do not cancel. Sums are exact decimals with six places.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from . import rollups as ru

WEIGHTS = 65521
_EXACT = "decimal(26,6)"
_LEVEL = ["__ll", "__lk", "__sl", "__sk"]


@dataclass
class Sides:
    """The two sides of a comparison: the matrix, and the sums and positions behind it."""
    matrix: DataFrame
    sums: DataFrame        # base, cell, feature, __v
    cells: DataFrame       # base, cell, weight of the positions that read it
    places: DataFrame      # key, base, cell
    key: str
    base: list[str]
    columns: list[str]


def _weight(key: str, base: Sequence[str]) -> Column:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *base)]
    return (F.pmod(F.xxhash64(*text), F.lit(WEIGHTS)) + 1).cast("decimal(6,0)")


def sides(matrix: DataFrame, pos: DataFrame, feat: DataFrame, target_col: str, value_col: str, prefix: str,
          targets: Sequence[str], key: str = "position_id", day_col: str = "day", city_col: str = "city_id",
          country_col: str = "country_id", scope_key: str | None = None) -> Sides:
    """The inputs of ``rollup_features`` and its result, made ready for the comparison.

    The sums and the cells' weights are read at every step and are written once to the shared
    checkpoint folder; they have one row per cell, not per position.
    """
    ensure_checkpoint_dir(matrix.sparkSession)
    base = [day_col] + ([scope_key] if scope_key else [])
    columns = ru.feature_names(prefix, targets)
    sums = (ru.level_sums(feat, base, target_col, value_col, city_col, country_col)
            .select(*base, *_LEVEL, ru.feature_name(prefix).alias("feature"), F.col("__v").cast(_EXACT).alias("__v"))
            .where(F.col("feature").isin(columns)).checkpoint())
    places = ru.position_cells(pos, key, base, city_col, country_col)
    cells = places.groupBy(*base, *_LEVEL).agg(F.sum(_weight(key, base)).alias("__w")).checkpoint()
    return Sides(matrix, sums, cells, places, key, base, columns)


def _matrix_checksums(s: Sides, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, feature, checksum, n_null) of the matrix; only ``columns`` are read."""
    weight = _weight(s.key, s.base)
    row = s.matrix.withColumn("__w", weight).groupBy(*by).agg(
        *(F.sum(F.col("__w") * F.coalesce(F.col(c).cast(_EXACT), F.lit(0))).alias(f"__s{i}") for i, c in enumerate(columns)),
        *(F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"__s{i}").cast("decimal(38,6)").alias("checksum"),
                                        F.col(f"__n{i}").alias("n_null")) for i, c in enumerate(columns))))
    return row.select(*by, each.alias("e")).select(*by, "e.*")


def _differing(s: Sides, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, feature) whose checksums differ."""
    cell = [*s.base, *_LEVEL]
    source = (s.sums.where(F.col("feature").isin(list(columns))).join(s.cells, cell)
              .groupBy(*by, "feature").agg(F.sum(F.col("__w") * F.col("__v")).cast("decimal(38,6)").alias("source")))
    both = _matrix_checksums(s, columns, by).join(source, [*by, "feature"], "full")
    zero = F.lit(0).cast("decimal(38,6)")
    return both.where((F.coalesce("checksum", zero) != F.coalesce("source", zero)) | (F.coalesce("n_null", F.lit(0)) > 0)).select(*by, "feature")


def differing_columns(s: Sides) -> list[str]:
    """Step 1: the feature columns that differ; at most twelve per target."""
    return sorted(r.feature for r in _differing(s, s.columns, []).collect())


def differing_days(s: Sides, columns: Sequence[str]) -> DataFrame:
    """Step 2: (day, feature) that differ among ``columns``."""
    return _differing(s, columns, s.base)


def differing_cells(s: Sides, columns: Sequence[str], days: DataFrame, res_type: str, tolerance: float) -> DataFrame:
    """Step 3: the cells that differ on the given days and columns."""
    base, key = s.base, s.key
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns)))
    values = (s.matrix.join(days.select(*base).distinct(), base, "left_semi").select(key, *base, each.alias("e"))
              .select(key, *base, "e.*").join(days, [*base, "feature"], "left_semi"))
    names = s.sums.where(F.col("feature").isin(list(columns))).select("feature", "__ll", "__sl").distinct()  # one row a column
    read = s.places.join(days.join(names, "feature"), [*base, "__ll", "__sl"])
    read = read.join(s.sums, [*base, *_LEVEL, "feature"], "left")
    wanted = read.groupBy(key, *base, "feature", F.col("__sk").alias("skill")).agg(
        F.array_join(F.array_sort(F.collect_set("__lk")), ",").alias("places"),
        F.coalesce(F.sum("__v"), F.lit(0)).cast(res_type).cast("double").alias("expected"))
    both = values.join(wanted, [key, *base, "feature"], "left").fillna(0.0, subset=["expected"])
    wrong = F.col("value").isNull() | (F.abs(F.col("value") - F.col("expected")) > tolerance)
    return both.where(wrong).groupBy(*base, "feature", "places", "skill").agg(
        F.count(F.lit(1)).alias("n_positions"), F.min("value").alias("low"), F.max("value").alias("high"), F.max("expected").alias("expected"))


def reconcile_rollup(matrix: DataFrame, pos: DataFrame, feat: DataFrame, target_col: str, value_col: str, prefix: str,
                     targets: Sequence[str], res_type: str = "int", tolerance: float = 1e-6, **names) -> DataFrame:
    """The cells of a ``rollup_features`` matrix that differ from its source, empty when it holds.

    Per (day[, scope], feature, places, skill): how many positions have a wrong or null value,
    the smallest and largest of those, and the value expected. ``places`` are the position's
    distinct cities or countries, comma-joined (empty on company level; null: a position without any).
    """
    s = sides(matrix, pos, feat, target_col, value_col, prefix, targets, **names)
    columns = differing_columns(s)
    if not columns:
        kinds = ", ".join(f"`{c}` {matrix.schema[c].dataType.simpleString()}" for c in s.base)
        return matrix.sparkSession.createDataFrame([], f"{kinds}, feature string, places string, skill string, n_positions bigint, low double, high double, expected double")
    return differing_cells(s, columns, differing_days(s, columns), res_type, tolerance)


def row_differences(matrix: DataFrame, pos: DataFrame, key: str = "position_id", day_col: str = "day") -> DataFrame:
    """(day, n_positions) with (position, day) keys missing from the matrix, in it without a position, or in it twice."""
    have = matrix.select(key, day_col, F.lit(1).alias("__n"))
    want = pos.select(key, day_col).distinct().withColumn("__n", F.lit(-1))
    return (have.unionByName(want).groupBy(key, day_col).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)
            .groupBy(day_col).agg(F.count(F.lit(1)).alias("n_positions")))
