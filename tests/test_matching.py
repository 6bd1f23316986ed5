"""Greedy matching against a sequential pass; importance closed forms against loops."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from staffsight.operators import importance as imp
from staffsight.operators import matching as mt


def sequential_greedy(edges):
    """The reference's pass: take the best remaining edge, drop both ends, repeat."""
    rest = sorted(edges, key=lambda e: (e[2], e[3], e[0], e[1]), reverse=True)
    used_l, used_r, out = set(), set(), []
    for p, e, imp_, sc in rest:
        if p in used_l or e in used_r:
            continue
        used_l.add(p)
        used_r.add(e)
        out.append((p, e))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_greedy_equals_sequential(spark, seed):
    rnd = random.Random(seed)
    edges = set()
    for _ in range(rnd.randint(1, 80)):
        p, e = rnd.randint(1, 15), rnd.randint(1, 12)
        edges.add((p, e))
    # importance per position (ties likely), score per edge
    w = {p: float(rnd.randint(1, 4)) for p, _ in edges}
    rows = [(p, e, w[p], float(rnd.randint(1, 5))) for p, e in sorted(edges)]
    df = spark.createDataFrame(rows, "position_id long, employee_id long, position_importance double, score double")
    got = sorted((r.position_id, r.employee_id) for r in mt.greedy_match(df).collect())
    assert got == sequential_greedy(rows)


@pytest.mark.parametrize("batch", [1, 7, 40])
def test_greedy_in_small_batches(spark, batch):
    rnd = random.Random(batch)
    rows = sorted({(rnd.randint(1, 25), rnd.randint(1, 20), float(rnd.randint(1, 3)), float(rnd.randint(1, 4))) for _ in range(120)})
    rows = list({(p, e): (p, e, i, s) for p, e, i, s in rows}.values())
    df = spark.createDataFrame(rows, "position_id long, employee_id long, position_importance double, score double")
    got = sorted((r.position_id, r.employee_id) for r in mt.greedy_match(df, batch=batch).collect())
    assert got == sequential_greedy(rows)


def test_greedy_takes_few_jobs_on_a_chain(spark):
    """10 000 edges, each next to a better one: only the first is the best of both its ends."""
    rows = [((i + 1) // 2, i // 2, float(-i), 0.0) for i in range(10_000)]
    df = spark.createDataFrame(rows, "position_id long, employee_id long, position_importance double, score double")
    sc = spark.sparkContext
    sc.setJobGroup("chain", "greedy matching of a chain")
    try:
        out = mt.greedy_match(df)
        jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.position_id, r.employee_id) for r in out.collect()) == sequential_greedy(rows)
    assert jobs < 10


def test_greedy_empty_and_null(spark):
    df = spark.createDataFrame([(1, 1, None, 1.0)], "position_id long, employee_id long, "
                                                    "position_importance double, score double")
    assert mt.greedy_match(df).count() == 0


def test_each_side_used_once(spark):
    rows = [(p, e, float(p % 3), float((p * e) % 7)) for p in range(1, 30) for e in range(1, 9) if (p + e) % 3]
    df = spark.createDataFrame(rows, "position_id long, employee_id long, position_importance double, score double")
    out = mt.greedy_match(df).toPandas()
    assert out.position_id.is_unique and out.employee_id.is_unique
    # maximality: no edge with both ends free remains
    used_p, used_e = set(out.position_id), set(out.employee_id)
    assert not [r for r in rows if r[0] not in used_p and r[1] not in used_e]


def _loop_discount(duration, t, a=0.12, ao=0.24):
    s = 0.0
    if t >= 0:
        for i in range(t, t + duration):
            s += 1 / ((1 + a / 365) ** i)
    else:
        for i in range(t, 0):
            s += 1 / ((1 + ao / 365) ** i)
        for i in range(0, t + duration):
            s += 1 / ((1 + a / 365) ** i)
    return s


def test_discount_closed_form(spark):
    cases = [(d, t) for d in (0, 1, 30, 400) for t in (-500, -30, -1, 0, 1, 45, 365)]
    df = spark.createDataFrame(cases, "d int, t int")
    got = df.select(imp.discounted_days(F.col("d"), F.col("t")).alias("v")).collect()
    for (d, t), r in zip(cases, got):
        assert r.v == pytest.approx(_loop_discount(d, t), rel=1e-12, abs=1e-12)


def test_step_missing_is_top(spark):
    df = spark.createDataFrame([(None,), (20,), (21,), (201,)], "n int")
    got = [r.c for r in df.select(imp.step(F.col("n"), imp.CONTAINER_STEPS, imp.CONTAINER_TOP).alias("c")).collect()]
    assert got == [2.0, 0.8, 1.0, 2.0]


def test_employee_groups_nan_in_both(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 0.0), (3, None, 5.0), (4, 9, None)],
                               "employee_id long, position_id long, ext_wl double")
    g1, g2, g3 = mt.employee_groups(df)
    ids = lambda d: sorted(r.employee_id for r in d.collect())
    assert ids(g1) == [4] and ids(g2) == [1, 3] and ids(g3) == [1, 2]
