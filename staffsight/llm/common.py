"""Helpers the training-data operators share: scratch tables and word patterns."""

from __future__ import annotations

import re
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: One white-space character, and one run of word characters (Java and RE2 syntax).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and lets several consumers share the work.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(df: DataFrame | None) -> None:
    """Delete the folder of a table that ``save`` wrote and nothing reads any more."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def _hashable(field: T.StructField) -> Column:
    """A form of the column that hashes can take: equal maps give equal entries in order."""
    kind, value = field.dataType, named(field.name)
    if isinstance(kind, T.MapType) and not re.search("map<|variant", kind.valueType.simpleString()):
        return F.array_sort(F.map_entries(value))
    return F.to_json(F.struct(value)) if re.search("map<|variant", kind.simpleString()) else value


def row_key(df: DataFrame) -> Column:
    """128 hash bits of all columns of ``df``: the same for equal rows, whatever their ids."""
    # hashes skip nulls, so which columns are null is hashed too
    parts = [*(named(c).isNull() for c in df.columns), *map(_hashable, df.schema.fields)]
    return F.concat_ws("-", F.xxhash64(F.lit(1), *parts).cast("string"), F.xxhash64(F.lit(2), *parts).cast("string"))


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def n_words(text: Column) -> Column:
    """Number of words, without keeping them."""
    return F.size(words(text)).cast("long")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, also where ``use`` reads it in lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ship(module_name: str) -> None:
    """Send a module's functions to executors with the plan, which need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
