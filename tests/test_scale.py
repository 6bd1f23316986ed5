"""Steps that once carried or repeated more than they need: results on built rows, and the plan that keeps them small."""

import datetime as dt

from pyspark.sql import functions as F

from staffsight.operators import business_days as bd
from staffsight.operators import movement as mv
from staffsight.operators import rollups as ru


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_business_days_leave_the_calendar_behind(spark):
    day = dt.date
    rows = [(1, "x", [1, 2], day(2024, 1, 1), day(2024, 1, 7)), (2, None, [2], day(2024, 1, 5), None), (3, "y", [], day(2024, 1, 1), day(2024, 1, 2)),
            (4, "z", None, day(2024, 1, 1), day(2024, 1, 2)), (5, "v", [1, None], None, day(2024, 1, 2)), (None, "w", [9, 1], day(2024, 1, 1), day(2024, 1, 3))]
    df = spark.createDataFrame(rows, "k int, text string, countries array<int>, a date, b date")
    bdays = spark.createDataFrame([(1, day(2024, 1, d)) for d in (1, 2, 3)] + [(2, day(2024, 1, d)) for d in (2, 5, 6, 7)], "country_id int, day date")
    expected = {"min": {1: 3, 2: 3, 3: None, 4: None, 5: 0, None: 0}, "max": {1: 4, 2: 3, 3: None, 4: None, 5: 0, None: 3},
                "mean": {1: 3.5, 2: 3.0, 3: None, 4: None, 5: 0.0, None: 1.5}}
    for agg, by_key in expected.items():
        out = bd.business_day_features(df, ["k"], [("n", "a", "b")], "countries", bdays, "2024-01-01", "2024-01-31", agg)
        assert out.columns == [*df.columns, "n"]
        got = {r.k: (r.text, r.n) for r in out.collect()}
        assert got == {r[0]: (r[1], by_key[r[0]]) for r in rows}
    # the whole calendar of a country is not sorted or shuffled with each of its rows
    plan = plan_of(out.select("k", "n"))
    assert "SortAggregate" not in plan and "BroadcastHashJoin" in plan


def test_movement_edges_read_the_snapshots_once(spark, tmp_path):
    rows = [(1, 10, True, 2.0), (2, 10, True, 3.0), (2, 11, False, 4.0), (1, 12, None, 5.0), (1, None, True, 1.0)]
    spark.createDataFrame(rows, "snap int, id int, billable boolean, hours double").write.parquet(str(tmp_path / "s"))
    moved = mv.hour_movement(spark.read.parquet(str(tmp_path / "s")))
    edges = mv.movement_edges(moved)
    got = sorted(tuple(r) for r in edges.collect())
    assert got == sorted([("1 billable", "2 billable", 2.0), ("1 billable", "cancelled", 1.0), ("new", "2 billable", 0.0),
                          ("1 non billable", "2 non billable", 0.0), ("1 non billable", "cancelled", 0.0), ("new", "2 non billable", 4.0),
                          ("1 non billable", "2 non billable", 0.0), ("1 non billable", "cancelled", 5.0), ("new", "2 non billable", 0.0)])
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for df in (edges, moved)]
    assert scans[0] == scans[1] > 0


def test_rollup_looks_each_set_of_places_up_once(spark):
    """Positions of one set of skills and places share its row; null keys, repeated rows and several skills count as ever."""
    day = dt.date(2024, 1, 1)
    pos = [(p, day, 1, 1, "P1", 7, 3) for p in range(40)] + [(40, day, 1, 1, "P1", 7, 3), (40, day, 1, 1, "P1", 8, 3), (40, day, 2, 1, "P1", 7, 3),
           (None, day, 1, 1, "P1", 7, 3), (41, None, 1, 1, "P1", 7, 3), (42, day, None, None, None, None, None)]
    pos = spark.createDataFrame(pos + pos[:5], "position_id int, day date, primary_skill_id int, primary_skill_category_id int, skill_prefix string, city_id int, country_id int")
    feat = spark.createDataFrame([(day, 1, 1, "P1", 7, 3, "Open", 5), (day, 2, 1, "P1", 8, 3, "OPEN", 2), (day, None, None, None, None, None, "Open", 1),
                                  (day, 1, 1, "P1", 7, 3, None, 9)],
                                 "day date, primary_skill_id int, primary_skill_category_id int, skill_prefix string, city_id int, country_id int, t string, v int")
    out = ru.rollup_features(pos, feat, "t", "v", "n", ("Open", "Gone"))
    city, country = f"n_open_{ru.CITY_LEVEL}", f"n_open_{ru.COUNTRY_LEVEL}"
    got = {(r.position_id, r.day): (r[f"{city}_primary_skill_id"], r[city], r[country], r.n_open_primary_skill_id, r.n_open_company, r.n_gone_company)
           for r in out.collect()}
    assert len(got) == out.count() == 44
    assert all(got[(p, day)] == (5, 5, 7, 5, 8, 0) for p in [*range(40), None])
    assert got[(40, day)] == (5, 12, 14, 7, 16, 0)  # two skills: each reads its own cells
    assert got[(41, None)] == (0, 0, 0, 0, 0, 0) and got[(42, day)] == (0, 0, 0, 1, 8, 0)
    # forty positions of one set: the join by cell sees the set's twelve cells, not twelve a position
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__places" in text and "__name" not in text


def test_models_and_scores_read_written_rows(spark):
    from staffsight.plans.registry import QUERIES

    from .conftest import SMOKE
    plan = QUERIES["m5_score_per_scope"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Relation [" not in plan
