"""Time-based train / validation splits.

Folds are a tiny table (one row per fold); rows are labelled by a broadcast range join
with it, so a row inside several folds appears once per fold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame, SparkSession, functions as F

# Helper columns that are not features.
HELPER_COLUMNS = ("created", "actual_start_date", "target", "max_date", "last_assigned_date",
                  "last_staffing_status_update_date")


def _d(x) -> dt.datetime:
    return x if isinstance(x, dt.datetime) else dt.datetime.fromisoformat(str(x)[:10])


def time_split(df: DataFrame, cut, sort_col: str = "max_date", date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """M1: train = rows with ``sort_col`` before the cut; test = rows whose date is on or
    after the cut and whose ``sort_col`` is after it."""
    c = F.lit(_d(cut)).cast("timestamp_ntz")
    s, d = F.col(sort_col).cast("timestamp_ntz"), F.col(date_col).cast("timestamp_ntz")
    return df.where(s < c), df.where((d >= c) & (s > c))


def x_y(df: DataFrame, target: str = "target", helpers: Sequence[str] = HELPER_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Features without the helper columns, and the target apart."""
    return df.drop(*[h for h in helpers if h in df.columns]), df.select(target)


#: The smallest step of time: windows close one tick before the next one opens.
TICK = dt.timedelta(microseconds=1)


def rolling_folds(start, end, n: int = 3, alf: float = 0.25) -> list[tuple[dt.datetime, ...]]:
    """M2: n folds of (train start, train end, validation start, validation end). Time is
    measured in validation lengths: fold k opens at k, its validation at k + 1/alf − 1 and
    ends at k + 1/alf, where the period holds n + 1/alf − 1 lengths of whole days (rounded
    half up). The last validation takes in the end day."""
    origin, close = _d(start), _d(end) + dt.timedelta(days=1)
    lengths = n + 1 / alf - 1
    length = dt.timedelta(days=int(Decimal((_d(end) - origin).days / lengths).quantize(Decimal(1), ROUND_HALF_UP)))
    marks = [[origin + length * (k + shift) for shift in (0, 1 / alf - 1, 1 / alf)] for k in range(n)]
    marks[-1][2] = close
    return [(opens, splits - TICK, splits, ends - TICK) for opens, splits, ends in marks]


def monthly_folds(start, end, n: int = 3, train_len: int = 3, test_len: int = 1) -> list[tuple[dt.datetime, ...]]:
    """M3: fold k validates the ``test_len`` months that end k months before the end, and
    trains on the ``train_len`` months before those. Raises when n exceeds the folds the
    period holds."""
    last = _d(end)
    span = relativedelta(last + dt.timedelta(days=1), _d(start))
    room = (12 * span.years + span.months - train_len) // test_len
    if n > room:
        raise ValueError(f"the period holds {room} folds, {n} asked for")

    def window(far: int, near: int) -> tuple[dt.datetime, dt.datetime]:
        """The months between two distances from the end."""
        return last - relativedelta(months=far) + dt.timedelta(days=1), last - relativedelta(months=near)

    return [(*window(k + test_len + train_len, k + test_len), *window(k + test_len, k)) for k in range(n)]


def fold_table(spark: SparkSession, folds) -> DataFrame:
    rows = [(i, *f) for i, f in enumerate(folds)]
    return spark.createDataFrame(rows, "fold int, train_start timestamp_ntz, train_end timestamp_ntz, "
                                       "val_start timestamp_ntz, val_end timestamp_ntz")


def label_folds(df: DataFrame, folds: DataFrame, date_col: str = "date") -> DataFrame:
    """M2/M3: each row once per fold it falls in, with ``role`` train or validation."""
    d = F.col(date_col).cast("timestamp_ntz")
    f = F.broadcast(folds)  # one row per fold
    tr = df.join(f, (d >= F.col("train_start")) & (d <= F.col("train_end"))).withColumn("role", F.lit("train"))
    va = df.join(f, (d >= F.col("val_start")) & (d <= F.col("val_end"))).withColumn("role", F.lit("validation"))
    return tr.unionByName(va).drop("train_start", "train_end", "val_start", "val_end")
