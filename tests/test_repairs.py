"""Cases that once gave wrong answers: each holds the input that showed it."""

import datetime as dt
import random

import pytest

from staffsight.operators import encode, history, metrics, movement, rollups, runs, splits


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_aucs_and_percentiles_with_many_scores(spark, partitions):
    rnd = random.Random(7)
    rows = [(int(s > rnd.random()), round(s, 4)) for s in (rnd.random() for _ in range(20_000))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "y int, p double")
        got = metrics.classification_metrics(df).first()
        reg = metrics.regression_metrics(df).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    by = {}
    for y, p in rows:
        by.setdefault(p, [0, 0])[1 - y] += 1
    below, area = 0, 0.0
    for p in sorted(by):
        area += by[p][0] * (below + by[p][1] / 2)
        below += by[p][1]
    n_pos = sum(y for y, _ in rows)
    assert got.roc_auc == pytest.approx(area / (n_pos * (len(rows) - n_pos)), abs=1e-12)
    tp = fp = 0
    last, pr = 1.0, 0.0
    for p in sorted(by, reverse=True):
        tp, fp = tp + by[p][0], fp + by[p][1]
        pr, last = pr + by[p][0] * (tp / (tp + fp) + last) / 2, tp / (tp + fp)
    assert got.pr_auc == pytest.approx(pr / n_pos, abs=1e-12)
    errors = sorted(abs(y - p) for y, p in rows)

    def percentile(q):
        k = (len(errors) - 1) * q
        a = errors[int(k)]
        return a + (errors[min(int(k) + 1, len(errors) - 1)] - a) * (k - int(k))
    assert reg.median_ae == pytest.approx(percentile(0.5), abs=1e-12) and reg.p90_ae == pytest.approx(percentile(0.9), abs=1e-12)


def test_percentiles_of_no_rows(spark):
    got = metrics.regression_metrics(spark.createDataFrame([], "y double, p double")).first()
    assert got.median_ae is None and got.mae is None


def test_no_missing_predictions_after_until(spark):
    reg = spark.createDataFrame([("a", dt.date(2024, 2, 5))], "scope string, date date")
    done = spark.createDataFrame([], "scope string, date date")
    assert runs.missing_predictions(reg, done, "2024-02-01").count() == 0
    assert runs.missing_predictions(reg, done, "2024-02-06").count() == 2


def test_null_hours_are_not_absence(spark):
    rows = [(1, 1, True, None), (2, 1, True, 5.0), (1, 2, True, 3.0), (2, 3, True, 4.0)]
    got = movement.hour_movement(spark.createDataFrame(rows, "snap int, id int, billable boolean, hours double")).collect()
    assert [(r.kept_hours or 0.0, r.cancelled_hours, r.new_hours) for r in got] == [(0.0, 3.0, 4.0)]


def test_asof_same_day_rows_do_not_depend_on_order(spark):
    left = spark.createDataFrame([(1, dt.date(2024, 1, 3))], "k int, day date")
    rows = [(1, dt.date(2024, 1, 2), 4), (1, dt.date(2024, 1, 2), 0)]
    for right in (rows, rows[::-1]):
        got = history.asof(left, spark.createDataFrame(right, "k int, day date, v int"), "k", "day", ["v"]).first()
        assert got.v == 4


def test_fold_bounds():
    d = dt.datetime
    us = dt.timedelta(microseconds=1)
    assert splits.rolling_folds("2024-01-01", "2024-03-01", n=3, alf=0.25) == [
        (d(2024, 1, 1), d(2024, 1, 31) - us, d(2024, 1, 31), d(2024, 2, 10) - us),
        (d(2024, 1, 11), d(2024, 2, 10) - us, d(2024, 2, 10), d(2024, 2, 20) - us),
        (d(2024, 1, 21), d(2024, 2, 20) - us, d(2024, 2, 20), d(2024, 3, 2) - us)]
    assert splits.monthly_folds("2024-01-01", "2024-06-30", n=2, train_len=2, test_len=1)[1] == (
        d(2024, 2, 29) + dt.timedelta(days=1), d(2024, 4, 30), d(2024, 5, 1), d(2024, 5, 30))
    with pytest.raises(ValueError):
        splits.monthly_folds("2024-01-01", "2024-06-30", n=5, train_len=2, test_len=1)


def test_targets_that_share_a_column_name_are_refused():
    assert rollups._checked_targets(["On Hold", "Open"]) == ["On Hold", "Open"]
    with pytest.raises(ValueError):
        rollups._checked_targets(["On Hold", "on hold"])


def test_assembled_vectors_keep_every_value_of_min_df(spark):
    rows = spark.range(300_000).selectExpr("id", "cast(id as string) as name", "1.0 as weight")
    _, _, names = encode.assemble(rows, ["name"], [], ["weight"], min_df=1)
    assert len(names) == 300_001


def test_parameterised_query_binds_a_timestamp(spark, tmp_path):
    from staffsight.plans.registry import QUERIES
    rows = [("A", dt.datetime(1996, 1, 1), "F", 1.5), ("A", dt.datetime(1997, 5, 1), "F", 2.0), ("A", dt.datetime(1995, 12, 31), "F", 8.0),
            ("B", dt.datetime(1998, 1, 1), "O", 4.0), (None, dt.datetime(1998, 1, 1), "F", 3.0), ("B", None, "F", 4.0)]
    schema = "o_orderpriority string, o_orderdate timestamp_ntz, o_orderstatus string, o_totalprice double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orders.parquet"))
    got = {tuple(r) for r in QUERIES["s1_parameterised_sql"](spark, str(tmp_path)).collect()}
    assert got == {("A", 2, 3.5), (None, 1, 3.0)}
