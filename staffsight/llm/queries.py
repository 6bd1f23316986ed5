"""Registers one query per training-data operator, over its whole table."""

from __future__ import annotations

import public_tokenizers

from . import ann, bpe, chat, licenses, mixing, neardup, pii, quality, simhash, spelling, urls, warc, whitening
from .common import table


def op1_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_chat_format(spark, sf_dir):
    extra = spark.sql(r"""
        SELECT conv_id, turn, role, text FROM VALUES
          (-7L, 0L, 'user', r'\### Assistant: </turn> ok'), (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok')
          AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(chat.format_chat(rows.unionByName(extra)))


def op3_minhash_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_ann_search(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_warc_fixity(spark, sf_dir):
    return warc.fixity_report(table(spark, sf_dir, "pages"))


def op6_bpe_roundtrip(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_pii_spans(spark, sf_dir):
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_source_mix(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_simhash_neardup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


CHAT_ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
e AS (SELECT *, contains(text, '\') OR contains(text, '### ') OR contains(text, '</turn>')
    OR contains(role, '\') OR contains(role, '### ') OR contains(role, '</turn>') OR contains(role, chr(10)) AS esc FROM t),
r AS (SELECT *, CASE WHEN esc THEN length(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '<\/turn>'), '### ', '#\## '), chr(10), '\n'))
    + length(replace(replace(replace(text, '\', '\b'), '</turn>', '<\/turn>'), '### ', '#\## ')) ELSE length(role) + length(text) END + 14 AS n FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::bigint AS formatted_chars
FROM r GROUP BY conv_id
"""

QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_chat_format, op3_minhash_neardup, op4_ann_search, op5_warc_fixity,
    op6_bpe_roundtrip, op7_pii_spans, op8_quality_rules, op9_url_filter, op10_source_mix,
    op11_spelling_variants, op12_simhash_neardup, op13_embedding_whitening)}
ORACLES = {
    "op1_license_scan": licenses.ORACLE, "op2_chat_format": CHAT_ORACLE, "op3_minhash_neardup": neardup.oracle(),
    "op5_warc_fixity": warc.ORACLE, "op8_quality_rules": quality.oracle(), "op9_url_filter": urls.ORACLE, "op10_source_mix": mixing.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
}
