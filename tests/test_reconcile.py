"""A damaged roll-up is opened only where it differs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffsight.operators import reconcile as rec
from staffsight.operators import rollups as ru

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
TARGETS = ("Open", "On hold")
ARGS = ("target", "value", "p", TARGETS)


@pytest.fixture(scope="module")
def inputs(spark):
    pos = [(i, d, f"c{(i + j) % 5}", f"k{(i + j) % 2}", i % 4, i % 2, "P") for i in range(40) for d in DAYS for j in range(1 + i % 2)]
    feat = [(d, f"c{i % 5}", f"k{i % 2}", i % 4, i % 2, "P", TARGETS[i % 2], i) for i in range(60) for d in DAYS]
    pos = spark.createDataFrame(pos, "position_id long, day date, city_id string, country_id string, primary_skill_id int, "
                                     "primary_skill_category_id int, skill_prefix string")
    feat = spark.createDataFrame(feat, "day date, city_id string, country_id string, primary_skill_id int, "
                                       "primary_skill_category_id int, skill_prefix string, target string, value int")
    return ru.rollup_features(pos, feat, *ARGS).checkpoint(), pos, feat


def damage(matrix, column, where, by):
    return matrix.withColumn(column, F.when(where, by).otherwise(F.col(column)).cast("int"))


def test_a_true_matrix_reads_the_top_level_only(inputs, monkeypatch):
    matrix, pos, feat = inputs
    monkeypatch.setattr(rec, "differing_days", None)
    monkeypatch.setattr(rec, "differing_cells", None)
    assert rec.reconcile_rollup(matrix, pos, feat, *ARGS).count() == 0
    assert rec.row_differences(matrix, pos).count() == 0


def test_each_column_and_each_kind_of_damage_is_named(inputs):
    matrix, pos, feat = inputs
    at = (F.col("position_id") == 7) & (F.col("day") == DAYS[1])
    for column in ru.feature_names("p", TARGETS)[::5]:
        bad = rec.reconcile_rollup(damage(matrix, column, at, F.col(column) + 3), pos, feat, *ARGS).collect()
        assert [(r.day, r.feature, r.n_positions, r.low - r.expected) for r in bad] == [(DAYS[1], column, 1, 3.0)]
    column = "p_open_staffing_locations_city_id_primary_skill_id"
    bad = rec.reconcile_rollup(damage(matrix, column, at, F.lit(None)), pos, feat, *ARGS).collect()
    assert [(r.places, r.skill, r.n_positions, r.low) for r in bad] == [("c2,c3", "3", 1, None)]


def test_errors_that_cancel_are_found(inputs):
    matrix, pos, feat = inputs
    column = "p_on_hold_company"
    swap = F.when(F.col("position_id") == 3, F.col(column) + 1).when(F.col("position_id") == 4, F.col(column) - 1)
    s = rec.sides(matrix.withColumn(column, F.coalesce(swap, F.col(column))), pos, feat, *ARGS)
    assert rec.differing_columns(s) == [column]
    assert rec.differing_days(s, [column]).count() == 2
    bad = rec.differing_cells(s, [column], rec.differing_days(s, [column]), "int", 1e-6).collect()
    assert sorted((r.day, r.n_positions, r.high - r.low) for r in bad) == [(d, 2, 2.0) for d in DAYS]


def test_missing_repeated_and_unknown_rows(inputs):
    matrix, pos, _ = inputs
    first = F.col("day") == DAYS[0]
    changed = matrix.where(~(first & (F.col("position_id") == 1))).unionByName(matrix.where(first & (F.col("position_id") == 2)))
    changed = changed.unionByName(matrix.where(first & (F.col("position_id") == 3)).withColumn("position_id", F.lit(999).cast("long")))
    assert [tuple(r) for r in rec.row_differences(changed, pos).collect()] == [(DAYS[0], 3)]
