"""Model quality metrics as aggregates.

Classification AUCs and exact percentiles need the value order: rows are first reduced to
one per distinct value (partial aggregation map-side), then cumulative counts come from
prefix sums over value ranges with fixed bounds — local running sums inside each range plus
the totals of the ranges before it — so no single task sorts the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ratios import safe_ratio


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M6: mean of y, MAE, median and 90th-percentile absolute error (exact, linear
    interpolation), MSE, RMSE, MAPE (%), R² and explained variance — one row. MAPE
    skips rows with y = 0 (the reference would return infinity)."""
    e = F.col(y) - F.col(p)
    ae = F.abs(e)
    out = df.agg(
        F.avg(y).alias("mean"), F.avg(ae).alias("mae"),
        F.avg(e * e).alias("mse"),
        (F.avg(F.abs(F.try_divide(e, F.col(y)))) * 100.0).alias("mape"),
        F.var_pop(y).alias("__var_y"), F.var_pop(e).alias("__var_e"))
    ranks = exact_percentiles(df, ae, {"median_ae": 0.5, "p90_ae": 0.9})
    names = [*out.columns, *ranks.columns]  # two one-row frames side by side
    out = out.unionByName(ranks, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in names])
    return out.select("mean", "mae", "median_ae", "p90_ae", "mse", F.sqrt("mse").alias("rmse"), "mape",
                      (1.0 - F.col("mse") / F.col("__var_y")).alias("r2"),
                      (1.0 - F.col("__var_e") / F.col("__var_y")).alias("explained_variance"))


def improvement(model: DataFrame, baseline: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M6: ``1 − model / baseline`` per metric (one row each side)."""
    m = model.select(*[F.col(c).alias(f"m_{c}") for c in cols])
    b = baseline.select(*[F.col(c).alias(f"b_{c}") for c in cols])
    j = m.unionByName(b, allowMissingColumns=True).agg(  # two one-row frames side by side
        *[F.max(f"m_{c}").alias(f"m_{c}") for c in cols], *[F.max(f"b_{c}").alias(f"b_{c}") for c in cols])
    return j.select(*[(1.0 - F.col(f"m_{c}") / F.col(f"b_{c}")).alias(f"improvement_{c}") for c in cols])


def half_life_error(df: DataFrame, y: str = "y", p: str = "p", half_life: float = 30.0) -> DataFrame:
    """M7: mean of 2^(−y/h)·(over + 2·under): under-estimates weigh double."""
    over = F.greatest(F.col(p) - F.col(y), F.lit(0.0))
    under = F.greatest(F.col(y) - F.col(p), F.lit(0.0))
    return df.agg(F.avg(F.pow(F.lit(2.0), -F.col(y) / half_life) * (over + 2.0 * under)).alias("half_life_error"))


def range_bounds(df: DataFrame, order_col: str, n: int = 64) -> list:
    """Up to ``n − 1`` rising bounds that cut the column into ranges of similar size: one
    job, and only these scalars reach the driver."""
    found = df.agg(F.percentile_approx(order_col, [i / n for i in range(1, n)], 1000)).first()[0]
    return sorted(set(found or []))


def prefix_sums(df: DataFrame, order_col: str, cols: Sequence[str], descending: bool = False) -> DataFrame:
    """Running sums of ``cols`` in ``order_col`` order (inclusive), without a global sort
    in one task: number each row's range from fixed bounds, sum inside each range, add the
    totals of the ranges before it (a tiny table). The range is a function of the value
    alone, so the sums do not depend on partition counts or on which branch reads them.
    Nulls come lowest."""
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    bounds = range_bounds(df, order_col)
    above = F.coalesce(sum(((F.col(order_col) > F.lit(b)).cast("int") for b in bounds), F.lit(0)), F.lit(0))
    d = df.withColumn("__pid", -above if descending else above)
    w = Window.partitionBy("__pid").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.sum(c).over(w).alias(f"__loc_{c}") for c in cols])
    tot = d.groupBy("__pid").agg(*[F.sum(c).alias(f"__tot_{c}") for c in cols])
    wt = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offs = tot.select("__pid", *[F.coalesce(F.sum(f"__tot_{c}").over(wt), F.lit(0)).alias(f"__off_{c}")
                                 for c in cols])
    out = local.join(F.broadcast(offs), "__pid")
    return out.select(*df.columns, *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"cum_{c}") for c in cols])


def exact_percentiles(df: DataFrame, value: Column, shares: dict[str, float]) -> DataFrame:
    """One row with a column per share: the exact percentile with linear interpolation, from
    counts per distinct value and their running sums."""
    values = df.select(value.alias("v")).where("v is not null")
    total = values.count()
    c = prefix_sums(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", ["n"])

    def at(rank: int) -> Column:
        return F.max(F.when((F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank), F.col("v")))

    ranks = {name: max(total - 1, 0) * share for name, share in shares.items()}
    return c.agg(*[(at(math.floor(k)) + (at(math.ceil(k)) - at(math.floor(k))) * F.lit(k - math.floor(k))).alias(name)
                   for name, k in ranks.items()])


def score_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score with its positives and negatives."""
    return df.groupBy(F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M8: ROC AUC as the rank-sum statistic with tied scores sharing ranks:
    Σ pos(s)·(neg below s + neg(s)/2) / (P·N)."""
    c = prefix_sums(score_counts(df, y, p), "score", ["neg"])
    return c.agg((F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0))
                  / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def pr_auc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M8: area under the precision-recall curve by trapezoids, thresholds at distinct
    scores from the highest down, starting at (recall 0, precision 1) and stopping at the
    first threshold reaching full recall (as the common library curve does)."""
    c = prefix_sums(score_counts(df, y, p), "score", ["pos", "neg"], descending=True)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0))
    # recall step of a threshold is pos/P; thresholds past full recall add no positives
    return c.agg((F.sum(F.col("pos") * (prec + prec0) / 2.0) / F.sum("pos")).alias("pr_auc"))


def threshold_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M8: accuracy, precision, recall and F1 with the score cut by round-half-even
    (0.5 → 0), undefined → 0."""
    pred = F.bround(F.col(p), 0)
    yy = F.col(y).cast("double")
    t = df.agg(F.count(F.lit(1)).alias("n"), F.count_if((pred == 1) & (yy == 1)).alias("tp"),
               F.count_if((pred == 1) & (yy != 1)).alias("fp"), F.count_if((pred != 1) & (yy == 1)).alias("fn"),
               F.count_if(pred == yy).alias("correct"))
    prec = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return t.select((F.col("correct") / F.col("n")).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    safe_ratio(2 * prec * rec, prec + rec).alias("f1"))


def classification_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M8: ROC AUC, PR AUC, accuracy, precision, recall, F1 in one row."""
    a, b, c = roc_auc(df, y, p), pr_auc(df, y, p), threshold_metrics(df, y, p)
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True).agg(
        *[F.max(x).alias(x) for x in ("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1")])


def majority_baseline(df: DataFrame, y: str = "y", train: DataFrame | None = None) -> DataFrame:
    """M9: the most frequent training class as a constant score (1.0 or 0.0) per row."""
    src = train if train is not None else df
    maj = src.agg((F.count_if(F.col(y) == 1) > F.count_if(F.col(y) != 1)).alias("__maj"))
    m = maj.first()["__maj"]
    return df.withColumn("p", F.lit(1.0 if m else 0.0))


def stratified_baseline(df: DataFrame, y: str = "y", seed: int = 42, train: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """M9: a random class drawn with the training prior, per row (seeded).

    With ``key`` the draw is a hash of the row's key and the seed, so it depends neither on
    partitions nor on the order of rows; without it rows draw from ``rand``.
    """
    src = train if train is not None else df
    prior = src.agg(F.avg((F.col(y) == 1).cast("double")).alias("__p")).first()["__p"]
    if key is None:
        draw = F.rand(seed)
    else:
        digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 12)
        draw = F.conv(digits, 16, 10).cast("double") / float(16**12)
    return df.withColumn("p", (draw < F.lit(prior)).cast("double"))


# Prediction ranges (days) of the range report, (label, lower, upper].
RANGE_CASES = (("60+ days", 60, None), ("30-60 days", 30, 60), ("0-30 days", 0, 30))


def mae_by_range(df: DataFrame, target: str = "target", predictions: str = "predictions",
                 baseline: str = "baseline") -> DataFrame:
    """Baseline and model MAE (2 decimals) per prediction range and the improvement
    ``round(1 − model/baseline, 2)``."""
    case = None
    for label, lo, hi in RANGE_CASES:
        cond = F.col(predictions) > lo
        if hi is not None:
            cond &= F.col(predictions) <= hi
        case = F.when(cond, F.lit(f"{predictions} {label}")) if case is None else case.when(cond, F.lit(f"{predictions} {label}"))
    g = (df.withColumn("case", case).where(F.col("case").isNotNull()).groupBy("case")
         .agg(F.round(F.avg(F.abs(F.col(target) - F.col(baseline))), 2).alias("baseline_mae"),
              F.round(F.avg(F.abs(F.col(target) - F.col(predictions))), 2).alias("model_mae")))
    return g.withColumn("improvement", F.round(1.0 - F.col("model_mae") / F.col("baseline_mae"), 2))


def horizon_hours(pred: DataFrame, hours: DataFrame, threshold: float = 0.5, key: str = "position_id",
                  date_col: str = "date", horizon: str = "horizon", prob: str = "probability",
                  month_col: str = "month", hours_col: str = "hours") -> DataFrame:
    """A34 (inferred): per snapshot date and horizon h, the reported hours of month
    (date + h) of the positions predicted positive (probability ≥ threshold), against
    the hours of all scored positions; plus their absolute error."""
    p = pred.withColumn("__m", F.add_months(F.trunc(F.col(date_col).cast("date"), "MM"), F.col(horizon).cast("int")))
    h = hours.select(key, F.trunc(F.col(month_col).cast("date"), "MM").alias("__m"), F.col(hours_col).alias("__h"))
    j = p.join(h, [key, "__m"], "left")
    out = j.groupBy(date_col, horizon).agg(
        F.coalesce(F.sum(F.when(F.col(prob) >= threshold, F.col("__h"))), F.lit(0.0)).alias("predicted_hours"),
        F.coalesce(F.sum("__h"), F.lit(0.0)).alias("reported_hours"))
    return out.withColumn("abs_error", F.abs(F.col("predicted_hours") - F.col("reported_hours")))


def horizon_mae(horizon_rows: DataFrame, horizon: str = "horizon") -> DataFrame:
    """MAE of aggregated vs reported hours per horizon."""
    return horizon_rows.groupBy(horizon).agg(F.avg("abs_error").alias("mae"))
