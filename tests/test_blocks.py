"""Block graphs: order, resuming, checks; business days and roles on edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffsight.operators import business_days as bd
from staffsight.operators import lookup as lk
from staffsight.operators import position_features as pf
from staffsight.operators.blocks import Block, assembled, run_blocks
from staffsight.plans import q_jobs as jobs

from .conftest import SMOKE


def test_a_failed_job_goes_on_where_it_stopped(spark, tmp_path):
    built, broken = [], [True]

    def rows():
        built.append("rows")
        return spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))

    def second(r):
        built.append("b")
        return r.select("k", (F.col("a") + 1).alias("b"), F.lit(0).alias("left_out"))

    def third(b, r):
        built.append("c")
        if broken[0]:
            raise RuntimeError("dies")
        return r.join(b, "k").select("k", (F.col("a") + F.col("b")).alias("c"))

    blocks = [Block("c", third, ("b", "rows")), Block("b", second, columns=("b",)), Block("rows", rows, ())]
    with pytest.raises(RuntimeError):
        run_blocks(spark, str(tmp_path), ["k"], blocks)
    broken[0] = False
    out = assembled(run_blocks(spark, str(tmp_path), ["k"], blocks), ["k"])
    assert built == ["rows", "b", "c", "c"]
    assert sorted(map(tuple, out.select("k", "a", "b", "c").collect())) == [(i, 2 * i, 2 * i + 1, 4 * i + 1) for i in range(4)]
    assert "left_out" not in out.columns


def test_blocks_must_have_the_rows_of_the_snapshot(spark, tmp_path):
    rows = Block("rows", lambda: spark.range(4).withColumnRenamed("id", "k"), ())
    for name, build in (("twice", lambda r: r.unionByName(r)), ("fewer", lambda r: r.where("k > 0"))):
        with pytest.raises(ValueError, match=name):
            run_blocks(spark, str(tmp_path / name), ["k"], [rows, Block(name, build)])
    with pytest.raises(ValueError, match="without their inputs"):
        run_blocks(spark, str(tmp_path), ["k"], [rows, Block("x", lambda y: y, ("nothing",))])


def test_business_days_on_edges(spark):
    day = dt.date
    bdays = spark.createDataFrame([(c, day(2024, 1, d)) for c in (1, 2) for d in range(1, 32) if day(2024, 1, d).weekday() < 5 and d != c], "country_id int, day date")
    data = [(1, day(2024, 1, 1), day(2024, 1, 7), [1, 2]), (2, None, day(2024, 1, 7), [1]), (3, day(2024, 1, 9), day(2024, 1, 8), [1]), (4, day(2024, 1, 30), None, [2]),
            (5, day(2024, 1, 1), day(2024, 1, 7), []), (6, day(2024, 1, 1), day(2024, 1, 7), None), (7, day(2023, 5, 1), day(2025, 1, 7), [2, 9]), (8, day(2024, 1, 6), day(2024, 1, 7), [1])]
    df = spark.createDataFrame(data, "k int, a date, b date, countries array<int>")
    out = bd.business_day_features(df, ["k"], [("n", "a", "b"), ("skipped", "a", "absent")], "countries", bdays, "2024-01-01", "2024-01-31")
    assert {r.k: r.n for r in out.collect()} == {1: 4, 2: 0, 3: 0, 4: 2, 5: None, 6: None, 7: 0, 8: 0}
    most = bd.business_day_features(df, ["k"], [("n", "a", "b")], "countries", bdays, "2024-01-01", "2024-01-31", "max")
    assert {r.k: r.n for r in most.where("k in (1, 7)").collect()} == {1: 4, 7: 22}


def test_roles_with_nulls(spark):
    df = spark.createDataFrame([(1, 1, 7, 8), (2, 1, None, 7), (3, 2, 7, None), (4, 1, None, None)], "k int, day int, boss int, peer int")
    units = spark.createDataFrame([(7, 1, "u1"), (7, 1, "u0"), (7, 2, "v"), (9, 1, "w"), (8, 1, None)], "person int, day int, unit string")
    out = lk.role_units(df, ["k"], units, {"boss": "boss_unit", "peer": "peer_unit"}, "person", "unit", "day", "none")
    assert {r.k: (r.boss_unit, r.peer_unit) for r in out.collect()} == {1: ("u0", "none"), 2: ("none", "u0"), 3: ("v", "none"), 4: ("none", "none")}


def test_project_sum_check(spark):
    rows = spark.createDataFrame([(0, None), (5, 0)], "proj_duration int, other int")
    pf.assert_some(rows, "proj_duration")
    with pytest.raises(ValueError, match="other"):
        pf.assert_some(rows, "other")


def test_a_written_block_is_let_go_before_the_next_is_planned(spark, tmp_path):
    held, alive = [], []

    def rows():
        df = spark.range(4).select(F.col("id").alias("k"), F.lit(1).alias("a"))
        held.append(spark._jvm.java.lang.ref.WeakReference(df._jdf))
        return df

    def second(r):
        alive.append(held[0].get() is not None)
        return r.select("k", F.lit(2).alias("b"))

    run_blocks(spark, str(tmp_path), ["k"], [Block("rows", rows, ()), Block("b", second)])
    assert alive == [False]


def test_a_block_with_other_keys_is_an_error(spark, tmp_path):
    rows = Block("rows", lambda: spark.range(4).withColumnRenamed("id", "k"), ())
    with pytest.raises(ValueError, match="other has other keys"):
        run_blocks(spark, str(tmp_path), ["k"], [rows, Block("other", lambda r: r.select((F.col("k") + 1).alias("k")))])


def test_only_the_columns_asked_for_are_joined(spark, tmp_path):
    rows = Block("rows", lambda: spark.range(4).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit(2).alias("x")), ())
    b = Block("b", lambda r: r.select("k", F.lit(9).alias("a"), F.lit(3).alias("b"), F.lit(4).alias("y")))
    c = Block("c", lambda r: r.select("k", F.lit(8).alias("b"), F.lit(5).alias("z")))
    tables = run_blocks(spark, str(tmp_path), ["k"], [rows, b, c])
    whole = assembled(tables, ["k"])
    assert whole.columns == ["k", "a", "x", "b", "y", "z"]
    out = assembled(tables, ["k"], columns=["b", "k", "a"])
    assert out.columns == ["b", "k", "a"] and sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.select("b", "k", "a").collect()))
    assert not {"x", "y", "z"} & {a.name() for a in _leaves(out)}


@pytest.mark.parametrize("job", ["q_horizon_job", "q_outcome_job"])
def test_the_jobs_share_the_places_and_join_what_they_show(spark, monkeypatch, job):
    got = []
    monkeypatch.setattr(jobs, "run_blocks", lambda spark, store, keys, blocks: got.append(blocks) or {b.name: b for b in blocks})
    monkeypatch.setattr(jobs, "assembled", lambda tables, keys, columns: (sorted(tables), columns))
    tables, columns = getattr(jobs, job)(spark, SMOKE)
    assert columns == jobs._SHOWN and "places" not in tables and len(tables) == 19
    assert {b.name for b in got[0] if "places" in b.inputs} == {"bench_buckets", "positions", "time_reporting", "total_proposals", "per_project", "on_bench"}


def _leaves(df):
    plan = df._jdf.queryExecution().analyzed()
    joined = [n for n in _nodes(plan) if n.nodeName() == "Join"]
    return [n.output().apply(i) for n in joined for i in range(n.output().size())]


def _nodes(plan):
    children = plan.children()
    return [plan, *(x for i in range(children.size()) for x in _nodes(children.apply(i)))]
