"""Position importance for matching.

The reference sums a discount factor day by day in a Python loop per row; the sum is a
geometric series with a closed form, so it is one column expression here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import days_between

# Yearly discount rates (normal, and while the start is overdue).
ALPHA = 0.12
ALPHA_OVERDUE = 0.24
# Step coefficients as (inclusive upper bound, coefficient); the last
# coefficient applies above every bound (and to a missing count, quirk Q6).
CONTAINER_STEPS = ((20, 0.8), (50, 1.0), (100, 1.2), (200, 1.5))
CONTAINER_TOP = 2.0
CUSTOMER_STEPS = ((50, 0.8), (100, 1.0), (250, 1.2), (500, 1.5), (1000, 2.0))
CUSTOMER_TOP = 3.0
AGE_STEPS = ((50, 2.0), (100, 1.5), (150, 1.0), (365, 0.5))
AGE_TOP = 0.2


def geometric_discount(start: Column, n: Column, alpha: float) -> Column:
    """S(a, n, α) = Σ_{i=a}^{a+n−1} q^i = q^a (1 − q^n) / (1 − q), q = 1 / (1 + α/365);
    n below 0 counts as 0."""
    q = 1.0 / (1.0 + alpha / 365.0)
    nn = F.greatest(n, F.lit(0)).cast("double")
    return F.pow(F.lit(q), start.cast("double")) * (1.0 - F.pow(F.lit(q), nn)) / (1.0 - q)


def discounted_days(duration: Column, time_to_start: Column, alpha: float = ALPHA,
                    alpha_overdue: float = ALPHA_OVERDUE) -> Column:
    """Discounted value of a position's days. Start ahead (t ≥ 0): the duration
    discounted from t. Start overdue (t < 0): the overdue days t…−1 at the higher rate
    plus the remaining t + D days from 0 at the normal rate."""
    t, d = time_to_start, duration
    ahead = geometric_discount(t, d, alpha)
    overdue = geometric_discount(t, -t, alpha_overdue) + geometric_discount(F.lit(0), t + d, alpha)
    return F.when(t >= 0, ahead).otherwise(overdue)


def step(value: Column, steps, top: float) -> Column:
    """Coefficient of the first step whose bound is ≥ value; ``top`` above all
    bounds and for a missing value."""
    out = F.lit(top)
    for bound, coef in reversed(steps):
        out = F.when(value <= bound, F.lit(coef)).otherwise(out)
    return F.when(value.isNull(), F.lit(top)).otherwise(out)


def position_score(df: DataFrame, day_col: str = "date", created: str = "created",
                   start: str = "planned_start_date", end: str = "planned_end_date",
                   per_container: str = "number_of_positions_per_container",
                   per_customer: str = "number_of_positions_per_customer") -> DataFrame:
    """D17 (score part): duration, age and time to start in whole days (D1), the
    discounted value and the three step coefficients multiplied together."""
    out = (df.withColumn("duration", days_between(start, end))
           .withColumn("distance_from_created", days_between(created, day_col))
           .withColumn("time_to_planned_start_date", days_between(day_col, start)))
    return out.withColumn(
        "score",
        discounted_days(F.col("duration"), F.col("time_to_planned_start_date"))
        * step(F.col(per_container), CONTAINER_STEPS, CONTAINER_TOP)
        * step(F.col(per_customer), CUSTOMER_STEPS, CUSTOMER_TOP)
        * step(F.col("distance_from_created"), AGE_STEPS, AGE_TOP))


def position_importance(scored: DataFrame, urgency: DataFrame, key: str = "position_id",
                        weight: str = "weight_adjusted") -> DataFrame:
    """importance = score × urgency weight; a position without weight counts 1."""
    u = urgency.select(key, weight)
    return (scored.join(u, key, "left")
            .withColumn(weight, F.coalesce(F.col(weight), F.lit(1.0)))
            .withColumn("position_importance", F.col("score") * F.col(weight)))
