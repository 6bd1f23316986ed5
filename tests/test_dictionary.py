"""Dictionaries as tables, against Spark ML's own encoder and against plain counting."""

import hashlib
from collections import Counter

from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from staffsight.operators import dictionary as dic
from staffsight.operators import encode as enc

SCHEMA = "id long, kind string, tags array<string>, size double"
ROWS = [(i, None if i % 11 == 0 else f"k{i % 7}", None if i % 5 == 0 else [f"t{i % 3}", f"t{i % 13}", None, f"t{i % 3}"],
         None if i % 4 == 0 else float(i % 3)) for i in range(200)]


def frame(spark, partitions=3):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(partitions)


def test_dictionary_is_counted_and_numbered_whatever_the_partitions(spark):
    counts = Counter()
    for _, kind, tags, _ in ROWS:
        counts[0, "kind", kind or "__UNDEFINED__"] += 1
        for t in {t for t in tags or [] if t is not None}:
            counts[1, "tags", t] += 1
    kept = sorted((no, hashlib.md5(v.encode()).hexdigest(), v, c, n) for (no, c, v), n in counts.items() if n >= 15)
    want = {(c, v, n, i) for i, (_, _, v, c, n) in enumerate(kept)}
    for partitions in (1, 7):
        got = dic.build_dictionary(frame(spark, partitions), ["kind"], ["tags"], 15).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_vectors_equal_the_ml_encoder(spark, tmp_path):
    df = frame(spark).withColumn("tags", F.array_compact("tags"))  # the other one counts a null element as a value
    table = dic.build_dictionary(df, ["kind"], ["tags"], 5)
    names = {r["index"]: r.feature for r in dic.feature_names(table, ["size"]).collect()}
    rows = dic.encode_rows(df, "id", table, ["kind"], ["tags"], ["size"])
    got = {r.id: r.features for r in dic.as_vectors(rows, str(tmp_path / "v")).collect()}
    _, out, ml_names = enc.assemble(df, ["kind"], ["tags"], ["size"], 5)
    assert sorted(names.values()) == sorted(ml_names) and sorted(names) == list(range(len(names)))
    for r in out.select("id", "features").collect():
        v = got[r.id]
        assert isinstance(v, SparseVector) and v.size == len(names)
        mine = {names[int(i)]: x for i, x in zip(v.indices, v.values)}
        assert mine == {ml_names[i]: x for i, x in enumerate(r.features.toArray()) if x}


def test_vectors_train_a_model(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    df = frame(spark)
    table = dic.build_dictionary(df, ["kind"], ["tags"], 5)
    x = dic.as_vectors(dic.encode_rows(df, "id", table, ["kind"], ["tags"], ["size"]), str(tmp_path / "v"))
    model = LogisticRegression(labelCol="y", maxIter=3).fit(x.withColumn("y", (F.col("id") % 2).cast("double")))
    assert model.numFeatures == table.count() + 1


def test_new_values_and_empty_inputs(spark):
    df = frame(spark)
    table = dic.build_dictionary(df, ["kind"], [], 5)
    new = spark.createDataFrame([(1, "never seen", ["x"], None), (2, "k1", None, 0.0)], SCHEMA)
    got = {r.id: r for r in dic.encode_rows(new, "id", table, ["kind"], [], ["size"]).collect()}
    assert got[1].indices == [] and len(got[2].indices) == 1 and got[1].size == got[2].size == table.count() + 1
    empty = df.limit(0)
    assert dic.build_dictionary(empty, ["kind"], ["tags"], 1).count() == 0
    assert dic.encode_rows(empty, "id", table, ["kind"], [], ["size"]).count() == 0
    only = dic.encode_rows(df, "id", dic.build_dictionary(df, [], [], 1), numeric=["size"]).collect()
    assert len(only) == len(ROWS) and all(r.size == 1 and len(r.indices) == (1 if r["values"] else 0) for r in only)


def test_many_values_stay_off_the_driver(spark):
    """A dictionary of 300 000 values: numbers are dense and unique, and no window task sees more than a cell."""
    df = spark.range(600_000, numPartitions=8).select(F.col("id"), (F.col("id") % 300_000).cast("string").alias("v"))
    table = dic.build_dictionary(df, ["v"], [], 2)
    r = table.agg(F.count("*").alias("n"), F.countDistinct("index").alias("d"), F.min("index").alias("lo"), F.max("index").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (300_000, 300_000, 0, 299_999)
