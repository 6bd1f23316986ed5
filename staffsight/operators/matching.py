"""Revenue from utilisation: employee groups, positions per period and greedy one-to-one
matching (SURVEY J16, J17, J21, M14, A38, P13).
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir


def forecast_slice(forecast: DataFrame, model: str | None = None, run_date=None, period=None,
                   countries: Sequence[str] | None = None) -> DataFrame:
    """The forecast rows of one model, run date and period (optionally countries)."""
    cond = F.lit(True)
    if model is not None:
        cond &= F.col("model") == model
    if run_date is not None:
        cond &= F.col("run_date").cast("date") == F.lit(run_date).cast("date")
    if period is not None:
        cond &= F.col("period").cast("date") == F.lit(period).cast("date")
    if countries:
        cond &= F.col("country").isin(*countries)
    return forecast.where(cond)


def forecast_with_positions(forecast: DataFrame, positions: DataFrame, workload: DataFrame, period,
                            billing_type: str = "1") -> DataFrame:
    """Forecast ⟕ (billable positions ⟕ their workload starting in ``period``),
    keeping only positions with positive workload; ``predicted_hours`` = reported +
    predicted. The inner filter makes the positions side an inner join."""
    w = workload.where((F.col("workload_start_date").cast("date") == F.lit(period).cast("date"))
                       & (F.col("monthly_workload") > 0)).select("position_id", "monthly_workload")
    pos = (positions.where(F.col("billing_type_id") == billing_type).select("position_id", "assignee_id")
           .join(w, "position_id", "inner"))
    f = forecast.select("employee_id", (F.col("reported") + F.col("predicted")).alias("predicted_hours"), "ext_wl")
    return f.join(pos.withColumnRenamed("assignee_id", "employee_id"), "employee_id", "left")


def employee_groups(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split J16 rows: (1) with a billable position, (2) without one and with external
    workload, (3) without one and without external workload. ``ext_wl`` null counts as
    external workload in (2) *and* as none in (3), as the reference's NaN test does (Q5)."""
    no_pos = F.col("position_id").isNull()
    g1 = df.where(~no_pos)
    g2 = df.where(no_pos & (F.col("ext_wl").isNull() | (F.col("ext_wl") != 0)))
    g3 = df.where(no_pos & (F.coalesce(F.col("ext_wl"), F.lit(0.0)) == 0))
    return g1, g2, g3


def positions_in_period(positions: DataFrame, workload: DataFrame, period,
                        employees: DataFrame | None = None) -> DataFrame:
    """Positions (of the given assignees) whose workload interval contains
    ``period`` with positive workload: (position_id, assignee_id, monthly_workload)."""
    p = positions.select("position_id", "assignee_id")
    if employees is not None:
        p = p.join(employees.select(F.col("employee_id").alias("assignee_id")).distinct(), "assignee_id", "left_semi")
    d = F.lit(period).cast("date")
    w = workload.where((F.col("workload_start_date").cast("date") <= d) & (F.col("workload_end_date").cast("date") >= d)
                       & (F.col("monthly_workload") > 0)).select("position_id", "monthly_workload")
    return p.join(w, "position_id", "inner")


#: Edges that one task matches in order; it holds them and their ends.
MATCH_BATCH = 1_000_000


def _in_order(batches):
    """The edges of a stream, best first, whose ends no earlier edge has taken."""
    lefts, rights = set(), set()
    for batch in batches:
        keep = []
        for i, (a, b) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            if a not in lefts and b not in rights:
                lefts.add(a)
                rights.add(b)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def greedy_match(edges: DataFrame, left: str = "position_id", right: str = "employee_id",
                 order: Sequence[str] = ("position_importance", "score"), batch: int = MATCH_BATCH) -> DataFrame:
    """One-to-one matching equal to the sequential greedy pass (take the best
    remaining edge, drop its two ends, repeat).

    Edges are ordered by ``order`` descending, ties by larger (left, right) — a total
    order. While more than ``batch`` edges remain, a distributed round accepts every edge that is
    the best remaining edge of both its ends (the sequential pass takes exactly those) and removes
    all edges touching them; if that leaves more than half, the best ``batch`` edges, which the
    sequential pass decides before all others, are matched in order by one task. The last
    ``batch`` edges are matched so too. Hence the number of rounds follows the number of edges
    (a round halves them or decides ``batch`` of them), not the longest chain, and no task
    holds more than ``batch`` edges. Per-end maxima are partial aggregates (no sort of a hot
    key). What remains is checkpointed to the cluster's checkpoint folder, which cuts the
    lineage and survives executor loss. Edges with a null order value are dropped first;
    an empty edge set gives an empty result.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    cond = F.lit(True)
    for c in order:
        cond &= F.col(c).isNotNull()
    rank = F.struct(*[F.col(c) for c in order], F.col(left), F.col(right))
    remaining = edges.where(cond).select(rank.alias("__k")).distinct().checkpoint(eager=True)
    accepted, n = [], remaining.count()

    def best_of_both_ends():
        best_l = remaining.groupBy(F.col("__k")[left].alias("__l")).agg(F.max("__k").alias("__k"))
        best_r = remaining.groupBy(F.col("__k")[right].alias("__r")).agg(F.max("__k").alias("__k"))
        return best_l.select("__k").join(best_r.select("__k"), "__k")

    def first_in_order():
        best = remaining.orderBy(F.desc("__k")).limit(batch) if n > batch else remaining
        best = best.select("__k", F.col("__k")[left].alias("__l"), F.col("__k")[right].alias("__r"))
        best = best.repartition(1).sortWithinPartitions(F.desc("__k"))
        return best.mapInArrow(_in_order, best.schema).select("__k")

    def without(taken):
        gone_l = taken.select(F.col("__k")[left].alias("__l"))
        gone_r = taken.select(F.col("__k")[right].alias("__r"))
        rest = (remaining.withColumn("__l", F.col("__k")[left]).withColumn("__r", F.col("__k")[right])
                .join(gone_l, "__l", "left_anti").join(gone_r, "__r", "left_anti").select("__k"))
        return rest.checkpoint(eager=True)

    in_order = False
    while n > batch:
        accepted.append((first_in_order() if in_order else best_of_both_ends()).checkpoint(eager=True))
        remaining, before = without(accepted[-1]), n
        n = remaining.count()
        in_order = not in_order and 2 * n > before
    if n:
        accepted.append(first_in_order().checkpoint(eager=True))
    cols = [F.col("__k")[c].alias(c) for c in (left, right, *order)]
    if not accepted:
        return edges.where(F.lit(False)).select(left, right, *order)
    out = accepted[0]
    for a in accepted[1:]:
        out = out.unionByName(a)
    return out.select(*cols)


def revenue_from_utilization(forecast: DataFrame, positions: DataFrame, workload: DataFrame,
                             importance: DataFrame, edges: DataFrame, period, run_date) -> DataFrame:
    """Employees with a billable position keep it (group 1); employees with external
    workload take their non-billable positions of the period (group 2); the rest
    (group 3) are matched one-to-one to open positions by (importance, edge score). The
    union keeps placed rows only, with ``date`` and ``period``."""
    j = forecast_with_positions(forecast, positions, workload, period)
    g1, g2, g3 = employee_groups(j)
    nb = positions_in_period(positions.where(F.col("billing_type_id") != "1"), workload, period, g2)
    g2 = (g2.select("employee_id", "predicted_hours", "ext_wl")
          .join(nb.withColumnRenamed("assignee_id", "employee_id"), "employee_id", "inner"))
    cand = (edges.join(g3.select("employee_id").distinct(), "employee_id", "left_semi")
            .join(importance.select("position_id", "position_importance"), "position_id", "inner"))
    matched = greedy_match(cand)
    g3 = (g3.select("employee_id", "predicted_hours", "ext_wl", "monthly_workload")
          .join(matched.select("employee_id", "position_id"), "employee_id", "left"))
    cols = ["employee_id", "predicted_hours", "ext_wl", "position_id", "monthly_workload"]
    out = g1.select(*cols).unionByName(g2.select(*cols)).unionByName(g3.select(*cols))
    return (out.withColumn("date", F.lit(run_date).cast("date")).withColumn("period", F.lit(period).cast("date")))


def placed_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("position_id").isNotNull())


def placement_summary(df: DataFrame, hours: str = "predicted_hours") -> DataFrame:
    """Hours and employee counts with and without a matched position, and distinct
    employees and positions."""
    placed = F.col("position_id").isNotNull()
    return df.agg(
        F.sum(F.when(placed, F.col(hours))).alias("placed_hours"),
        F.sum(F.when(~placed, F.col(hours))).alias("unplaced_hours"),
        F.count_if(placed).alias("placed_rows"),
        F.count_if(~placed).alias("unplaced_rows"),
        F.countDistinct("employee_id").alias("employees"),
        F.countDistinct("position_id").alias("positions"))
