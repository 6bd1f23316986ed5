"""Corpus pipeline (part of ``staffsight.llm``): filter, deduplicate, redact, mix, tokenise.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes each stage's
result as Parquet in the shared checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffsight.llm import bpe, mixing, neardup, pii, quality
from staffsight.llm.common import row_key, save, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of operator 8 keep; every row is judged by itself, whatever its id."""
    verdict = quality.judge(docs, table(spark, sf_dir, "labels"), row=row_key(docs))
    return _taken(docs, verdict.where("kept").select("row")).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8), the one with the smallest id.

    Of several rows with that id (or with none) in a group one is taken by a hash of its columns;
    texts without words are in no group. Equal rows become one; other rows with one id all stay.
    """
    stays = neardup.first_rows(docs, row_key(docs), k=5, percent=80)
    return _taken(docs, stays).dropDuplicates(["key"]).select("doc.*")


def _taken(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """key, doc (all columns) of the documents whose row key is in ``rows``."""
    keyed = docs.select(row_key(docs).alias("key"), F.struct("*").alias("doc"))
    return keyed.join(rows, F.col("key") == F.col("row"), "left_semi")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by the name of its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per epoch."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (little-endian unsigned 32-bit integers) of each document."""
    codec = bpe.load_codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.select(F.struct("doc_id", "source").alias("doc"), "text")
    return bpe.encode(rows, codec, id_col="doc").select("doc.doc_id", "doc.source", "n_tokens", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_neardup", near_duplicates),
    ("pii", personal_data),
    ("source_mix", source_mix),
    ("bpe", tokens),
]

#: No SQL states the PII and BPE stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
