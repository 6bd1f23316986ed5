"""Sources and sinks.

S1 parameterised SQL, S2 pruned/pushed reads, S3 run-versioned appends, S4 run log,
S5 snapshot dumps, S6 result-table evolution, S7 run-id timestamps, S8/S9 day lists.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DAY = "day"


def _as_date(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


# --- S1 -----------------------------------------------------------------------------
def sql_query(spark: SparkSession, text: str, **params) -> DataFrame:
    """Run SQL text with named parameter markers (``:name``); values are bound by
    Spark, never pasted into the text. Temp views referenced by the text must exist."""
    return spark.sql(text, args=params or None)


# --- S2 -----------------------------------------------------------------------------
def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               predicate: Column | str | None = None, fmt: str = "parquet") -> DataFrame:
    """Read only ``columns`` and push ``predicate`` into the scan.

    The reference fetched a server-side cursor in 40 000-row chunks; here the scan is
    split by ``spark.sql.files.maxPartitionBytes`` and read in parallel.
    """
    df = spark.read.format(fmt).load(path)
    if predicate is not None:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """S2 for a database source: a partitioned JDBC read (one range query per partition)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties or {})


# --- S3 / S4 ------------------------------------------------------------------------
def with_run(df: DataFrame, run_id: int | None = None, processed_at: dt.datetime | None = None,
             date_col: str | None = None) -> DataFrame:
    """S3 (columns part): add ``run_id`` (epoch seconds) and ``date_of_processing``; the
    business date becomes text ``YYYY-mm-dd`` as in the reference's result tables."""
    run_id = int(time.time()) if run_id is None else int(run_id)
    processed_at = processed_at or dt.datetime.fromtimestamp(run_id, dt.timezone.utc).replace(tzinfo=None)
    out = df.withColumn("run_id", F.lit(run_id).cast("long")) \
            .withColumn("date_of_processing", F.lit(processed_at).cast("timestamp"))
    if date_col:
        out = out.withColumn(date_col, F.date_format(F.col(date_col), "yyyy-MM-dd"))
    return out


def append_run(df: DataFrame, path: str, run_id: int | None = None,
               processed_at: dt.datetime | None = None, date_col: str = "date",
               fmt: str = "parquet") -> None:
    """S3: append a result with run columns, partitioned by the business date."""
    out = with_run(df, run_id, processed_at, date_col)
    out.write.mode("append").partitionBy(date_col).format(fmt).save(path)


RUN_LOG_SCHEMA = ("run_id long, start_time timestamp, end_time timestamp, code_version string, "
                  "comment string, success boolean, task_type string")


def log_run(spark: SparkSession, path: str, run_id: int, start: dt.datetime, end: dt.datetime,
            code_version: str, comment: str, success: bool, task_type: str) -> DataFrame:
    """Append one row to the run log (failures are logged too)."""
    row = spark.createDataFrame([(int(run_id), start, end, code_version, comment, bool(success),
                                  task_type)], RUN_LOG_SCHEMA)
    row.write.mode("append").parquet(path)
    return row


# --- S5 -----------------------------------------------------------------------------
def save_snapshot(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Dump a frame (the reference pickled / exported to Excel)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def load_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


# --- S6 / S7 ------------------------------------------------------------------------
def evolve(df: DataFrame, add: dict[str, Column] | None = None, drop: Iterable[str] = (),
           delete_where: Column | None = None) -> DataFrame:
    """Add columns, drop columns, delete rows matching a condition (null keeps)."""
    out = df
    for name, expr in (add or {}).items():
        out = out.withColumn(name, expr)
    out = out.drop(*drop)
    if delete_where is not None:
        out = out.where(~F.coalesce(delete_where, F.lit(False)))
    return out


def run_id_to_timestamp(df: DataFrame, run_col: str = "run_id",
                        out_col: str = "date_of_processing") -> DataFrame:
    """Epoch seconds → timestamp (session zone UTC)."""
    return df.withColumn(out_col, F.timestamp_seconds(F.col(run_col)))


# --- S8 / S9 ------------------------------------------------------------------------
def days(spark: SparkSession, values: Iterable, col: str = DAY) -> DataFrame:
    """A fixed list of days as a one-column DataFrame (its size is the list's)."""
    vals = sorted({_as_date(v) for v in values})
    return spark.createDataFrame([(v,) for v in vals], f"{col} date")


def date_series(spark: SparkSession, start, stop, step_days: int, col: str = DAY) -> DataFrame:
    """Days from ``start`` towards ``stop`` by ``step_days`` (may be negative), both
    ends inclusive when reached; ``explode(sequence(...))`` on one row."""
    if step_days == 0:
        raise ValueError("step_days must not be 0")
    s, e = _as_date(start), _as_date(stop)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(s), F.lit(e), F.make_interval(days=F.lit(step_days)))).alias(col))


def date_series_between(bounds: DataFrame, start: Column, stop: Column, step_days: int,
                        col: str = DAY) -> DataFrame:
    """S9 with data-derived ends: ``bounds`` is typically a one-row aggregate (e.g. the
    newest day of a table); each of its rows yields the days from ``start`` towards
    ``stop`` by ``step_days`` (negative steps walk back in time)."""
    if step_days == 0:
        raise ValueError("step_days must not be 0")
    return bounds.select(F.explode(F.sequence(start, stop, F.make_interval(days=F.lit(step_days)))).alias(col))


def same_day_of_month(days_df: DataFrame, anchor, col: str = DAY) -> DataFrame:
    """Keep days whose day-of-month equals the anchor's."""
    return days_df.where(F.dayofmonth(F.col(col)) == F.dayofmonth(F.lit(_as_date(anchor))))
