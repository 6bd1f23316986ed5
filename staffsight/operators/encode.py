"""Category encoding and feature-matrix preparation.

Encodings are long-form first — (row key, feature name, value) — which SQL can check;
``assemble`` turns them into Spark ML vectors with feature names in the metadata.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

UNDEFINED = "__UNDEFINED__"


def fill_by_type(df: DataFrame, text: str = UNDEFINED, number=0) -> DataFrame:
    """Null text → ``text``, null numbers → ``number``; dates, timestamps, booleans
    and arrays keep their nulls (types never change)."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    out = df
    if strings:
        out = out.fillna(text, subset=strings)
    if numbers:
        out = out.fillna(number, subset=numbers)
    return out


def to_timestamps(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Lenient timestamp cast — text that does not parse becomes null."""
    out = df
    for c in cols:
        parsed = F.try_to_timestamp(F.col(c).cast("string"), F.lit(fmt)) if fmt else \
            F.try_to_timestamp(F.col(c).cast("string"))
        out = out.withColumn(c, parsed)
    return out


@dataclass
class Roles:
    text: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    multicategorical: list = field(default_factory=list)
    dropped: list = field(default_factory=list)
    numeric: list = field(default_factory=list)


def column_roles(schema: T.StructType, text: Sequence[str] = (), categorical: Sequence[str] = (),
                 multicategorical: Sequence[str] = (), dropped: Sequence[str] = (),
                 keys: Sequence[str] = ("position_id", "employee_id", "target")) -> Roles:
    """P10: split columns into roles. Explicit lists win; the rest follows a type rule:
    arrays are multi-categorical, strings and booleans categorical, dates and timestamps
    and the key columns dropped, numbers numeric. (The reference names its columns in
    long fixed lists; the rule reproduces their role for the column types it uses.)"""
    r = Roles()
    explicit = {**{c: "text" for c in text}, **{c: "categorical" for c in categorical},
                **{c: "multicategorical" for c in multicategorical}, **{c: "dropped" for c in dropped}}
    for f in schema:
        role = explicit.get(f.name)
        if role is None:
            dt = f.dataType
            if f.name in keys or isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                role = "dropped"
            elif isinstance(dt, T.ArrayType):
                role = "multicategorical"
            elif isinstance(dt, (T.StringType, T.BooleanType)):
                role = "categorical"
            elif isinstance(dt, T.NumericType):
                role = "numeric"
            else:
                role = "dropped"
        getattr(r, role).append(f.name)
    return r


def select_features(df: DataFrame, roles: Roles, keep: Sequence[str] = ()) -> DataFrame:
    """P10: keep the key columns plus every non-dropped feature column."""
    cols = list(keep) + roles.text + roles.categorical + roles.multicategorical + roles.numeric
    return df.select(*dict.fromkeys(cols))


def collapse_rare(df: DataFrame, categorical: Sequence[str] = (), multicategorical: Sequence[str] = (),
                  n: int = 400, key: Sequence[str] | str | None = None) -> DataFrame:
    """A category value seen in fewer than ``n`` rows becomes ''; a list element seen
    fewer than ``n`` times (over all lists) is removed from the lists, order kept.

    Value counts are aggregates joined back (Catalyst broadcasts them when small). List
    columns are exploded with their positions, semi-joined with the kept elements and
    collected back per row ``key`` (which must identify a row)."""
    out = df
    for c in categorical:
        keep = (df.groupBy(c).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= n)
                .select(F.col(c).alias("__v")).withColumn("__keep", F.lit(True)))
        out = (out.join(keep, out[c].eqNullSafe(keep["__v"]), "left")
               .withColumn(c, F.when(F.col("__keep"), F.col(c)).otherwise(F.lit("")))
               .drop("__v", "__keep"))
    if multicategorical and key is None:
        raise ValueError("key is required for list columns")
    keys = [key] if isinstance(key, str) else list(key or [])
    for c in multicategorical:
        el = df.select(*keys, F.posexplode(c).alias("__pos", "__v"))
        kept = el.groupBy("__v").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= n).select("__v")
        back = (el.join(kept, "__v", "left_semi").groupBy(*keys)
                .agg(F.array_sort(F.collect_list(F.struct("__pos", "__v"))).alias("__l"))
                .select(*keys, F.transform("__l", lambda x: x["__v"]).alias("__new")))
        etype = df.schema[c].dataType
        out = (out.join(back, keys, "left")
               .withColumn(c, F.when(F.col(c).isNull(), F.col(c))
                           .otherwise(F.coalesce(F.col("__new"), F.array().cast(etype))))
               .drop("__new"))
    return out


def align_schema(df: DataFrame, expected: Sequence[str], fill=0) -> DataFrame:
    """The model's feature columns in its order; those the data lack become ``fill``."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in expected])


def one_hot_long(df: DataFrame, key: Sequence[str] | str, col: str, min_df: int = 5) -> DataFrame:
    """Binary one-hot of a category in long form — (key, feature, 1) for values seen
    in at least ``min_df`` rows; feature name ``<col>=<value>``."""
    keys = [key] if isinstance(key, str) else list(key)
    d = df.select(*keys, F.col(col).cast("string").alias("__v")).where(F.col("__v").isNotNull())
    vocab = d.groupBy("__v").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_df).select("__v")
    return (d.join(vocab, "__v", "left_semi")
            .select(*keys, F.concat(F.lit(col + "="), F.col("__v")).alias("feature"), F.lit(1).alias("value")))


def multi_hot_long(df: DataFrame, key: Sequence[str] | str, col: str, min_df: int = 5) -> DataFrame:
    """Binary multi-hot of a list column — (key, feature, 1) per distinct element seen
    in at least ``min_df`` rows."""
    keys = [key] if isinstance(key, str) else list(key)
    d = df.select(*keys, F.explode(F.array_distinct(F.col(col))).alias("__v")).where(F.col("__v").isNotNull())
    vocab = d.groupBy("__v").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_df).select("__v")
    return (d.join(vocab, "__v", "left_semi")
            .select(*keys, F.concat(F.lit(col + "="), F.col("__v").cast("string")).alias("feature"),
                    F.lit(1).alias("value")))


#: CountVectorizer keeps the commonest ``vocabSize`` values; at its largest, ``min_df`` alone decides.
ALL_VALUES = 2**31 - 1


def value_arrays(df: DataFrame, categorical: Sequence[str], multicategorical: Sequence[str],
                 numeric: Sequence[str]) -> DataFrame:
    """``df`` with the inputs of ``value_vectors``; null: UNDEFINED, an empty list, 0."""
    text = "array<string>"
    return df.withColumns({
        **{f"__arr_{c}": F.array(F.coalesce(F.col(c).cast("string"), F.lit(UNDEFINED))) for c in categorical},
        **{f"__arr_{c}": F.coalesce(F.col(c).cast(text), F.array().cast(text)) for c in multicategorical},
    }).fillna(0, subset=list(numeric))


def value_vectors(categorical: Sequence[str], multicategorical: Sequence[str], numeric: Sequence[str],
                  min_df: int, output: str = "features") -> list:
    """Spark ML stages over ``value_arrays``: a binary vector per (multi-)categorical column
    over the values in at least ``min_df`` rows, then one vector with the numeric columns."""
    from pyspark.ml.feature import CountVectorizer, VectorAssembler
    cols = [*categorical, *multicategorical]
    return [*(CountVectorizer(inputCol=f"__arr_{c}", outputCol=f"__vec_{c}", binary=True, minDF=float(min_df),
                              vocabSize=ALL_VALUES) for c in cols),
            VectorAssembler(inputCols=[*(f"__vec_{c}" for c in cols), *numeric], outputCol=output, handleInvalid="keep")]


def assemble(df: DataFrame, categorical: Sequence[str] = (), multicategorical: Sequence[str] = (),
             numeric: Sequence[str] = (), min_df: int = 5, output: str = "features"):
    """Spark ML stages — binary CountVectorizer (minDF) per categorical and
    multi-categorical column, numeric pass-through, one VectorAssembler. Returns the
    fitted PipelineModel, the transformed frame and the feature names."""
    from pyspark.ml import Pipeline

    prep = value_arrays(df, categorical, multicategorical, numeric)
    stages = value_vectors(categorical, multicategorical, numeric, min_df, output)
    model = Pipeline(stages=stages).fit(prep)
    names = []
    for c, st in zip(list(categorical) + list(multicategorical), model.stages[:-1]):
        names += [f"{c}={v}" for v in st.vocabulary]
    names += list(numeric)
    return model, model.transform(prep), names
