"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from staffsight.plans.registry import ORACLES, QUERIES
from tools.check_oracle import rows_of

from .conftest import SMOKE


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "month_class", "n_positions"]
    assert df.count() > 0


def test_registry_is_exposed():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_query_has_an_oracle_or_is_listed():
    without = sorted(set(QUERIES) - set(ORACLES))
    # operators SQL cannot state (iterative matching, model fits, writes) are rows-only
    allowed = {"j21_greedy_match", "m14_revenue_from_utilization", "m14_both_periods", "m4_train_per_scope", "m5_score_per_scope", "m9_stratified_baseline",
               "e8_assemble_features",
               "m15_horizon_feature_job", "a38_placement_summary"}
    assert set(without) <= allowed, set(without) - allowed


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMOKE)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, o_rows)
