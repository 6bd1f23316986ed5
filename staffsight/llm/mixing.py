"""Operator 10, mixing sources to target weights, by hash-random keys and prefix sums.

Each document gets a random key: the MD5 of its source, id and text digest. Within its source
the documents are ranged by this key; prefix sums of their sizes say where a source's budget
ends. The sums are made in two steps: per (source, key range) totals, which are combined
before any shuffle and prefix-summed over ranges, and, only inside the one range of a source
where its budget ends, per document. So no source is ever sorted in one task.

A budget above the source's size takes whole epochs of the source, and the rest from a last
epoch in key order; the document at the end of the budget is taken in part, so that a source
gives exactly its budget (rounded down to a word).

Targets: sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...; they share
``share`` (1.5) of all words by weight; a target stops at ``max_epochs`` (2) times its
source's size and the excess goes to the others by weight, until none is above.

Defined results: null texts have size 0 and none is taken of them; a null source is a
source; equal rows (same source, id and text) follow each other in the order and the cut may
fall between them; an empty table gives no rows; with no words at all nothing is taken.
Reruns agree, as the keys depend on the rows only. Columns other than doc_id, source and
text are not read, so they cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, named, save, SPACE

WEIGHTS = (5, 2, 1)
SHARE, MAX_EPOCHS = 1.5, 2
#: Hex digits of the key that name its range: 4 096 ranges a source.
RANGE_DIGITS = 3
#: Plans of up to this many (source, range) rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_RANGES = 200_000


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from one row (source, source_size) per source.

    The windows run over one row per source. A source is capped if, with all sources of a
    smaller size per weight capped, an equal share per weight would still exceed its cap.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * float(max_epochs)
    df = sizes.withColumn("w", w.cast("double")).withColumn("cap", cap)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    df = (df.withColumn("all", F.sum("source_size").over(every) * share)
          .withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                      / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # the first source that is not capped sets the level for itself and all after it
    open_level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "source", "level"))).over(every)
    return df.withColumn("flat", open_level["level"]).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("flat") * F.col("w"), F.col("cap"))).alias("target"))


def _with_keys(documents: DataFrame, *keep: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("source").cast("string"), F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)))
    rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), n_words(text).alias("size"), key.alias("key"), *keep)
    return rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))


def _plan(rows: DataFrame, weights, share: float, max_epochs: int) -> DataFrame:
    """Per (source, range): where the range starts in the source's order, and what is taken."""
    ranges = save(rows.groupBy("source", "range").agg(F.sum("size").alias("in_range")), "mix-ranges")
    budget = targets(ranges.groupBy("source").agg(F.sum("in_range").alias("source_size")), weights, share, max_epochs)
    upto = Window.partitionBy("r.source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ranges.alias("r").join(budget.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")))
              .withColumn("start", F.coalesce(F.sum("in_range").over(upto), F.lit(0)))
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
              .withColumn("rest", F.floor(F.col("target")) - F.col("epochs") * F.col("source_size")))
    cut = (F.col("start") < F.col("rest")) & (F.col("rest") < F.col("start") + F.col("in_range"))
    return save(ranges.select(F.col("r.source").alias("of"), F.col("range").alias("at"), "source_size", "target", "epochs",
                              "start", "rest", cut.alias("cut")), "mix-plan")


def _take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and taken."""
    if plan.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES:
        plan = F.broadcast(plan)
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["of"]) & (rows["range"] == plan["at"]))
    whole = joined.where(~F.col("cut")).withColumn("extra", F.when(F.col("start") < F.col("rest"), F.col("size")).otherwise(0))
    upto = Window.partitionBy("source", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("start") - F.coalesce(F.sum("size").over(upto), F.lit(0))
    parts = joined.where("cut").withColumn("extra", F.greatest(F.lit(0), F.least("size", left)))
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).cast("long")
    return whole.unionByName(parts).select(*rows.columns, "source_size", "target", taken.alias("taken"))


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken for every document."""
    rows = save(_with_keys(documents), "mix-keys")
    return _take(rows, _plan(rows, weights, share, max_epochs)).drop("range")


def mix_report(documents: DataFrame) -> DataFrame:
    """The columns of the query."""
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.regexp_substr(text, F.concat(F.lit(f"^(?:{SPACE}*+[^\\x20\\x09-\\x0D]++){{"), n.cast("string"), F.lit("}+")))


def mixed_documents(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: a document's row once per epoch it is taken in, the last one cut to its words.

    Columns as ``documents`` has them; ``n_chars`` follows the text where there is one.
    """
    rows = _with_keys(documents, F.struct(*map(named, documents.columns)).alias("doc"))
    dealt = _take(rows, _plan(_with_keys(documents), weights, share, max_epochs)).where("taken > 0")
    part = F.col("taken") % F.col("size")
    copies = F.concat(F.array_repeat("size", F.floor(F.col("taken") / F.col("size")).cast("int")),
                      F.filter(F.array(part), lambda x: x > 0))
    dealt = dealt.withColumn("words", F.explode(copies))
    text = F.when(F.col("words") < F.col("size"), first_words(F.col("doc.text"), F.col("words"))).otherwise(F.col("doc.text"))
    own = {"text": text}
    if "n_chars" in documents.columns:
        own["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return dealt.select(*(own.get(c, F.col("doc")[c]).alias(c) for c in documents.columns))


ORACLE = f"""
WITH keyed AS (SELECT row_number() OVER () AS rid, doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> ''))::bigint AS size,
  md5(coalesce(source, '') || '|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
src AS (SELECT source, sum(size)::bigint AS source_size FROM keyed GROUP BY source),
weighed AS (SELECT *, {MAX_EPOCHS}.0::double * source_size AS cap, ([{', '.join(f'{w}.0::double' for w in WEIGHTS)}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::int] AS w FROM src),
levels AS (SELECT *, (sum(source_size) OVER () * {SHARE}::double - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flat AS (SELECT arg_min(level, cap / w) AS flat FROM levels WHERE level * w <= cap),
goal AS (SELECT source, source_size, least(cap, coalesce(flat * w, cap)) AS target FROM levels, flat),
epoch AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::bigint ELSE 0 END AS epochs FROM goal),
run AS (SELECT k.*, e.source_size, e.target, e.epochs, floor(e.target)::bigint - e.epochs * e.source_size AS rest,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start
  FROM keyed k JOIN epoch e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - start)))::bigint AS taken FROM run
"""
