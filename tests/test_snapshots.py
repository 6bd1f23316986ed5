"""Validity join and its sweep count against a brute-force day-by-day check."""

import datetime as dt
import random

import pytest

from staffsight.operators import snapshots as snap


def brute_counts(rows, days):
    """For every day, the rows with ``valid_from <= day < valid_to`` (open end: no bound)."""
    out = {}
    for d in days:
        t = dt.datetime.combine(d, dt.time())
        for key, frm, to in rows:
            if frm <= t and (to is None or t < to):
                out[(d, key)] = out.get((d, key), 0) + 1
    return out


def _random_rows(rnd, n):
    base = dt.datetime(2020, 1, 1)
    rows = []
    for _ in range(n):
        frm = base + dt.timedelta(days=rnd.randint(0, 40), hours=rnd.choice([0, 0, 7, 23]))
        r = rnd.random()
        if r < 0.25:
            to = None
        elif r < 0.35:
            to = frm  # empty range
        elif r < 0.4:
            to = frm - dt.timedelta(days=rnd.randint(1, 3))  # inverted range: never valid
        else:
            to = frm + dt.timedelta(days=rnd.randint(0, 20), hours=rnd.choice([0, 0, 5]))
        rows.append((rnd.choice("abc"), frm, to))
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("many_days", [False, True])
def test_validity_counts_equal_brute_force(spark, seed, many_days):
    rnd = random.Random(seed)
    rows = _random_rows(rnd, rnd.randint(1, 60))
    if many_days:
        days = [dt.date(2019, 12, 25) + dt.timedelta(days=i) for i in range(80)]
    else:
        days = sorted({dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(-3, 70)) for _ in range(8)})
    # a row without a start is never valid, whatever its end
    unbounded = [("a", None, None), ("b", None, dt.datetime(2020, 1, 20))]
    hist = spark.createDataFrame(rows + unbounded, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    dd = spark.createDataFrame([(d,) for d in days], "day date")
    want = brute_counts(rows, days)
    got = {(r["day"], r["k"]): r["n"] for r in snap.validity_counts(dd, hist, ["k"]).collect()}
    assert got == want
    # the join counted per key agrees
    j = snap.validity_join(dd, hist, how="inner").groupBy("day", "k").count()
    assert {(r["day"], r["k"]): r["count"] for r in j.collect()} == want
    # left mode adds each day no row covers once, with null history columns
    left = snap.validity_join(dd, hist, how="left")
    empty = sorted(r["day"] for r in left.where("k is null").collect())
    assert empty == sorted(set(days) - {d for d, _ in want})


@pytest.mark.parametrize("seed", range(3))
def test_proposal_state_equals_brute_force(spark, seed):
    from staffsight.operators import rollups as ru
    rnd = random.Random(seed)
    base = dt.datetime(2021, 3, 1)
    ev = []
    for i in range(rnd.randint(1, 50)):
        t = base + dt.timedelta(days=rnd.randint(0, 12), hours=rnd.choice([0, 0, 9, 17]))
        ev.append((rnd.choice([1, 2, 3]), t, rnd.choice(["Booked", "Proposed", "Rejected"])))
    days = sorted({dt.date(2021, 3, 1) + dt.timedelta(days=rnd.randint(-1, 14)) for _ in range(6)})
    want = set()
    for d in days:
        midnight = dt.datetime.combine(d, dt.time())
        for k in {e[0] for e in ev}:
            seen = sorted((t, s) for kk, t, s in ev if kk == k and t <= midnight)
            if seen:
                want.add((d, k, seen[-1][1]))
    df = spark.createDataFrame(ev, "position_id long, time timestamp_ntz, staffing_status string")
    dd = spark.createDataFrame([(d,) for d in days], "day date")
    got = {(r["day"], r["position_id"], r["staffing_status"])
           for r in ru.proposal_state(dd, df, key="position_id").collect()}
    assert got == want
