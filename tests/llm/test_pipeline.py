"""The corpus pipeline, stage by stage, against brute force."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from staffsight.llm import pii
from staffsight.llm.common import save

from .test_operators import DOCS, SMALL, brute_components, reference_encoding


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        seen.append({})
        for r in docs.collect():
            seen[-1].setdefault(r.doc_id, []).append(r)
    kept, unique, clean, mixed = seen
    assert 0 < len(unique) < len(kept)
    want = brute_components({i: r[0].text for i, r in kept.items()}, 5, 80)
    assert set(unique) == {i for i, (_, c) in want.items() if i == c}
    anchors = pii.automaton()
    for i, r in clean.items():
        text = unique[i][0].text
        assert r[0].text == pii.redacted(text, pii.find(text, anchors)) and r[0].n_chars == len(r[0].text)
    for i, copies in mixed.items():
        text = clean[i][0].text
        assert len(copies) <= 2 and all(text.startswith(c.text) for c in copies) and sum(c.text != text for c in copies) <= 1
    enc = reference_encoding()
    want = sorted((i, np.array(enc.encode_ordinary(c.text), "<u4").tobytes()) for i, r in mixed.items() for c in r)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == want
    assert all(4 * r.n_tokens == len(r.ids) for r in got)


def test_pipeline_keeps_clean_documents(spark):
    words = [f"word{i}" for i in range(80)]
    text = " ".join(words)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(50).withColumn("text", F.concat(F.lit(text + " end"), "doc_id"))
    labels = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert labels.count() == 50


def test_pipeline_tells_rows_with_one_id_apart(spark):
    text = lambda name, n=80: " ".join(f"{name}{i}" for i in range(n))
    data = [(None, text("a")), (None, text("b")), (None, text("b")), (None, "bad"), (None, None), (1, text("c")), (2, text("d")),
            (2, text("c") + " end"), (2, text("e")), (2, "bad"), (3, text("f")), (3, text("f") + " end"), (4, text("a") + " end")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in data], DOCS)
    clean = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert clean.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    assert got == sorted((d for d in data if d[1] not in ("bad", None)), key=str)
    unique = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert unique.columns == docs.columns
    got = [(r.doc_id, r.text) for r in unique.collect()]
    one = [d for d in got if d[0] == 3]
    assert len(one) == 1 and one[0] in data
    # "bad" under two ids is a group of exact copies; the text without words is in none
    want = [(None, text("b")), (None, None), (1, text("c")), (2, text("d")), (2, text("e")), (2, "bad"), (4, text("a") + " end")]
    assert sorted((d for d in got if d[0] != 3), key=str) == sorted(want, key=str)
    again = corpus_pipeline.near_duplicates(spark, docs.repartition(5, "text"), SMALL)
    assert sorted(((r.doc_id, r.text) for r in again.collect()), key=str) == sorted(got, key=str)


def test_pipeline_with_odd_columns(spark):
    first = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    docs = (first.withColumn("a.b", F.lit(1)).withColumn("a`c", F.lit("x"))
            .withColumn("m", F.create_map(F.lit("k"), F.lit(2), F.lit("a"), F.lit(3)))
            .withColumn("deep", F.array(F.create_map(F.lit("k"), F.array(F.lit(1))))))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        assert docs.where("m['a'] = 3 and `a.b` = 1").count() == docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
