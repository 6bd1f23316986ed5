"""Category dictionaries and sparse rows that never pass through the driver.

A dictionary is a table: (column, value, df, index). Values are numbered column by column in
the order of their MD5 digest, which spreads them evenly whatever they look like: the values of
each (column, leading digits) cell are counted, the counts are summed over the cells (a table
of bounded size), and each value's place inside its cell is added. Numbers depend neither on
the number of partitions nor on the order of the rows. Numeric columns follow the values.

A row becomes (size, indices, values) by one equi-join with the dictionary and one aggregate by
row key; ``as_vectors`` writes such rows and reads them as Spark ML vectors, in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import ensure_checkpoint_dir
from .encode import UNDEFINED

#: Hexadecimal digits of a value's digest that name its cell: 4096 cells a column.
CELL_DIGITS = 3

DICTIONARY_SCHEMA = "column string, value string, df bigint, index bigint"


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def feature_rows(df: DataFrame, key: Sequence[str] | str, categorical: Sequence[str] = (),
                 multicategorical: Sequence[str] = ()) -> DataFrame:
    """(key, column number ``no``, value), once per row key, column and value.

    A null category counts as UNDEFINED; null and empty lists and null elements give nothing.
    """
    text = "array<string>"
    lists = [*(F.array(F.coalesce(F.col(c).cast("string"), F.lit(UNDEFINED))) for c in categorical),
             *(F.array_compact(F.array_distinct(F.coalesce(F.col(c).cast(text), F.array().cast(text)))) for c in multicategorical)]
    if not lists:
        return df.select(*_keys(key), F.lit(0).alias("no"), F.lit("").alias("value")).limit(0)
    numbered = lambda no: lambda v: F.struct(F.lit(no).alias("no"), v.alias("value"))
    pairs = F.flatten(F.array(*(F.transform(x, numbered(no)) for no, x in enumerate(lists))))
    return df.select(*_keys(key), F.explode(pairs).alias("p")).select(*_keys(key), "p.no", "p.value")


def build_dictionary(df: DataFrame, categorical: Sequence[str] = (), multicategorical: Sequence[str] = (),
                     min_df: int = 5) -> DataFrame:
    """The dictionary of the values in at least ``min_df`` rows of ``df``.

    The counted values feed three branches and are written once to the shared checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    names = [*categorical, *multicategorical]
    counted = (feature_rows(df, [], categorical, multicategorical).groupBy("no", "value").agg(F.count(F.lit(1)).alias("df"))
               .where(F.col("df") >= min_df).withColumn("digest", F.md5("value"))
               .withColumn("cell", F.substring("digest", 1, CELL_DIGITS)).checkpoint())
    cells = counted.groupBy("no", "cell").agg(F.count(F.lit(1)).alias("n"))
    # at most 16 ** CELL_DIGITS rows a column, whatever the number of values
    before = cells.select("no", "cell", F.coalesce(F.sum("n").over(
        Window.orderBy("no", "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("no", "cell").orderBy("digest", "value")) - 1
    column = F.element_at(F.array(*map(F.lit, names or [""])), F.col("no") + 1)
    return (counted.withColumn("inside", inside).join(before, ["no", "cell"])
            .select(column.alias("column"), "value", "df", (F.col("before") + F.col("inside")).alias("index")))


def one_hot_indexed(df: DataFrame, key: Sequence[str] | str, dictionary: DataFrame, categorical: Sequence[str] = (),
                    multicategorical: Sequence[str] = ()) -> DataFrame:
    """(key, index) for every value of the row that the dictionary has."""
    names = [*categorical, *multicategorical]
    column = F.element_at(F.array(*map(F.lit, names or [""])), F.col("no") + 1)
    rows = feature_rows(df, key, categorical, multicategorical).withColumn("column", column).drop("no")
    return rows.join(dictionary.select("column", "value", "index"), ["column", "value"]).select(*_keys(key), "index")


def encode_rows(df: DataFrame, key: Sequence[str] | str, dictionary: DataFrame, categorical: Sequence[str] = (),
                multicategorical: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """(key, size, indices, values), a sparse vector per row: 1 for each value of the
    dictionary, then the numeric columns (null: 0; zeros are left out).

    ``key`` must identify a row. Values that the dictionary lacks (new ones, when scoring) are
    left out, and so the size is the model's at any time. The size is read from the
    dictionary (one row, attached by an ungrouped aggregate).
    """
    keys = _keys(key)
    ones = (one_hot_indexed(df, keys, dictionary, categorical, multicategorical)
            .groupBy(*keys).agg(F.array_sort(F.collect_list("index")).alias("ones")))
    n = dictionary.agg(F.count(F.lit(1)).alias("n_values"))
    numbers = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric)).cast("array<double>")
    rows = df.select(*keys, numbers.alias("numbers")).join(ones, keys, "left").join(F.broadcast(n))  # one row
    ones_ = F.coalesce("ones", F.array().cast("array<bigint>"))
    filled = F.filter(F.transform("numbers", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda s: s["v"] != 0)
    return rows.select(
        *keys, (F.col("n_values") + len(numeric)).cast("int").alias("size"),
        F.concat(ones_, F.transform(filled, lambda s: F.col("n_values") + s["i"])).cast("array<int>").alias("indices"),
        F.concat(F.transform(ones_, lambda _: F.lit(1.0)), F.transform(filled, lambda s: s["v"])).alias("values"))


def as_vectors(rows: DataFrame, path: str, output: str = "features") -> DataFrame:
    """The rows of ``encode_rows`` with ``output`` as a Spark ML vector in place of the three columns.

    They are written below ``path`` (a folder that driver and executors share) in the layout of
    a vector and read with its type: no Python per row, and fits read them many times anyway.
    """
    from pyspark.ml.linalg import VectorUDT
    keys = [c for c in rows.columns if c not in ("size", "indices", "values")]
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), "size", "indices", "values").alias(output)
    rows.select(*keys, sparse).write.mode("overwrite").parquet(path)
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField(output, VectorUDT())])
    return rows.sparkSession.read.schema(schema).parquet(path)


def feature_names(dictionary: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """(index, feature): ``<column>=<value>`` for the values, then the numeric columns."""
    values = dictionary.select("index", F.concat("column", F.lit("="), "value").alias("feature"))
    if not numeric:
        return values
    last = F.posexplode(F.array(*map(F.lit, numeric))).alias("i", "feature")
    tail = dictionary.agg(F.count(F.lit(1)).alias("n")).select("n", last).select((F.col("n") + F.col("i")).alias("index"), "feature")
    return values.unionByName(tail)
