"""Operator 8, quality rules with risk-controlled thresholds.

Per document the rules measure shares (symbols, repeated lines, repeated words, word
length, length). A cutoff for each (stratum, measure) is chosen from a fixed grid on the
labelled documents: for a cutoff that rejects k of the n good documents of the stratum, the
exact binomial tail P(Bin(n, r) <= k) is the p-value of "more than a share r of good
documents is rejected". A cutoff is certified if this is at most confidence error / number
of tests (Bonferroni over strata, measures and grid), with r = risk / number of measures, so
that all rules together reject at most the share ``risk`` of a stratum's good documents, in
all strata at once, with the stated confidence. Of the certified cutoffs the one that
rejects the largest share of bad documents net of good ones is used, the loosest on ties;
none if no cutoff is certified or none rejects bad documents.

Defined results: null and empty texts have no words and fail the base rule; documents
without a language are a stratum of their own; labels without a document, and documents
without a label or with a null label, take no part in choosing cutoffs; a document labelled
repeatedly is good if all its labels are 1; repeated document rows are judged each; an empty
table gives no rows; only doc_id, text and the stratum column are read, so that other columns
cannot clash. Only SQL functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, save, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: Measure (larger is worse) and the cutoffs tried, loosest last.
GRID = {
    "symbol_share": (0.01, 0.02, 0.03, 0.05, 0.08, 0.10, 0.15, 0.25),
    "dup_line_share": (0.02, 0.05, 0.10, 0.15, 0.20, 0.30, 0.40, 0.50),
    "repeat_word_share": (0.02, 0.04, 0.06, 0.08, 0.10, 0.12, 0.15, 0.18),
    "long_words": (6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0),
    "short_words": (-4.0, -3.75, -3.5, -3.25, -3.0, -2.75, -2.5, -2.0),
    "few_words": (-40.0, -35.0, -30.0, -25.0, -20.0, -17.0, -15.0, -12.0),
}

#: Strata up to this many have their cutoffs broadcast; more are joined by a shuffle.
BROADCAST_STRATA = 10_000


def _windows(w: Column) -> Column:
    """Hashes of the WINDOW-word windows of the list ``w``, in order."""
    return F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(1))),
                    lambda i: F.xxhash64(F.slice(w, i, WINDOW))))


def _covered(windows: Column) -> Column:
    """Positions covered by the windows whose hash occurs again."""
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = let(by_hash, lambda s: F.sort_array(F.array_compact(F.transform(s, lambda x, j: F.when(
        (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"])))))
    # a window covers WINDOW words, or as many as there are to the next one's start
    gaps = let(starts, lambda s: F.transform(s, lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - p, F.lit(WINDOW)))))
    return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)


def measure(documents: DataFrame, stratum: str = "lang", row: Column | None = None) -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; and ``row`` if given."""
    key = [] if row is None else ["row"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # two steps, so that the words, lines and windows of a text are made once each
    first = documents.select(
        "doc_id", F.col(stratum).cast("string").alias("stratum"), words(text).alias("w"),
        *(row.alias(c) for c in key),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    second = first.select(
        "doc_id", "stratum", *key, "n_symbols", F.size("w").alias("n_words"),
        F.length(F.array_join("w", "")).alias("word_chars"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _windows(F.col("w")).alias("windows"))
    return second.select(
        "doc_id", "stratum", *key,
        *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(
            _covered(F.col("windows"))).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def shares() -> dict[str, Column]:
    """The measures of GRID over the columns of ``measure``."""
    length = _share("word_chars", "n_words")
    return {
        "symbol_share": _share("n_symbols", "word_chars"), "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_word_share": _share("n_repeat_words", "n_words"), "long_words": length, "short_words": -length,
        "few_words": -F.col("n_words").cast("double"),
    }


def binomial_tail(k: Column, n: Column, r: float) -> Column:
    """P(Bin(n, r) <= k), summed exactly in logarithms; 1 where k is not below n * r."""
    odds = math.log(r / (1 - r))
    start = F.struct((n * math.log1p(-r)).alias("log"), F.exp(n * math.log1p(-r)).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        log = s["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long")))).otherwise(
        F.array().cast("array<bigint>"))
    return F.when(k >= n * r, F.lit(1.0)).otherwise(F.aggregate(steps, start, step, lambda s: s["sum"]))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """stratum, cutoffs (map measure -> cutoff): the certified cutoffs of each stratum.

    ``measured`` needs doc_id, stratum and the counts of ``measure``; documents that fail
    the base rule are left out, as no cutoff decides on them.
    """
    good = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good"))
    marked = measured.where(~base_failed()).join(good, "doc_id")
    levels = F.array(*(F.struct(
        F.lit(name).alias("measure"),
        reduce(lambda a, b: a + b, ((value > c).cast("int") for c in GRID[name])).alias("level"))
        for name, value in shares().items()))
    # how many cutoffs a document exceeds; counted before anything is shuffled
    counts = (marked.select("stratum", "good", F.explode(levels).alias("m"))
              .groupBy("stratum", "good", "m.measure", "m.level").count())
    sums = (counts.select("stratum", "good", "measure", "count", F.explode(F.sequence(F.lit(0), F.col("level"))).alias("j"))
            .groupBy("stratum", "measure", "j")
            .agg(F.sum(F.when(F.col("good") == 1, F.col("count")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("good") == 1, 0).otherwise(F.col("count"))).alias("bad")))
    sums = save(sums, "quality-sums")
    tests = max(1, sums.select("stratum").distinct().count()) * sum(map(len, GRID.values()))
    totals = sums.where("j = 0").select("stratum", "measure", F.col("good").alias("n_good"), F.col("bad").alias("n_bad"))
    at = F.create_map(*(x for name, cuts in GRID.items() for x in (F.lit(name), F.array(*map(F.lit, cuts)))))
    grid = totals.select("stratum", "measure", "n_good", "n_bad", F.posexplode(F.element_at(at, F.col("measure"))).alias("p", "cutoff"))
    same = lambda a, b: a["stratum"].eqNullSafe(b["stratum"]) & (a["measure"] == b["measure"])
    hit = sums.where("j > 0")
    tried = grid.join(hit, same(grid, hit) & (grid["p"] + 1 == hit["j"]), "left").select(
        grid["stratum"], grid["measure"], "cutoff", "n_good", "n_bad",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
    net = F.col("bad") / F.greatest("n_bad", F.lit(1)) - F.col("good") / F.greatest("n_good", F.lit(1))
    certified = tried.where((F.col("bad") > 0) & (net > 0) & (
        binomial_tail(F.col("good"), F.col("n_good"), risk / len(GRID)) <= error / tests))
    best = certified.groupBy("stratum", "measure").agg(F.max(F.struct(net.alias("net"), "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("measure", "cutoff")))).alias("cutoffs"))


def judge(documents: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05,
          stratum: str = "lang", row: Column | None = None) -> DataFrame:
    """The columns of ``measure`` with base_failed and kept for every document."""
    measured = save(measure(documents, stratum, row), "quality-measures")
    cutoffs = save(choose_cutoffs(measured, labels, risk, error), "quality-cutoffs").withColumnRenamed("stratum", "of")
    if cutoffs.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    joined = measured.join(cutoffs, measured["stratum"].eqNullSafe(cutoffs["of"]), "left")
    over = reduce(lambda a, b: a | b, (
        F.coalesce(value > F.element_at("cutoffs", F.lit(name)), F.lit(False)) for name, value in shares().items()))
    return joined.select(*measured.columns, base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"))


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the query."""
    return judge(documents, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_shares() -> dict[str, str]:
    length = "word_chars / greatest(n_words, 1)"
    return {"symbol_share": "n_symbols / greatest(word_chars, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
            "repeat_word_share": "n_repeat_words / greatest(n_words, 1)", "long_words": length,
            "short_words": f"-({length})", "few_words": "-n_words::double"}


def oracle(risk: float = 0.02, error: float = 0.05) -> str:
    r = risk / len(GRID)
    n_cuts = sum(map(len, GRID.values()))
    grid = ", ".join(f"('{m}', {c}::double)" for m, cuts in GRID.items() for c in cuts)
    long = " UNION ALL ".join(f"SELECT doc_id, rid, stratum, '{m}' AS measure, {v} AS v FROM counted WHERE NOT base_failed"
                              for m, v in _sql_shares().items())
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents),
split AS (SELECT rid, doc_id, stratum, text, list_filter(regexp_split_to_array(text, '{space}+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
pos AS (SELECT rid, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS i FROM split),
win AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS t FROM pos),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM dup) GROUP BY rid),
counted AS (SELECT doc_id, s.rid, stratum, len(w)::bigint AS n_words, length(array_to_string(w, ''))::bigint AS word_chars,
  (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::bigint AS n_symbols, len(lines)::bigint AS n_lines,
  (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines, coalesce(cov.n, 0)::bigint AS n_repeat_words,
  len(w) < {MIN_WORDS} OR 100 * coalesce(cov.n, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
  FROM split s LEFT JOIN cov ON cov.rid = s.rid),
long AS ({long}),
good AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
grid(measure, cutoff) AS (VALUES {grid}),
tried AS (SELECT stratum, measure, cutoff, count(*) FILTER (good = 1) AS n_good, count(*) FILTER (good <> 1) AS n_bad,
  count(*) FILTER (good = 1 AND v > cutoff) AS good, count(*) FILTER (good <> 1 AND v > cutoff) AS bad
  FROM long JOIN good USING (doc_id) JOIN grid USING (measure) GROUP BY stratum, measure, cutoff),
tests AS (SELECT greatest(1, count(*)) * {n_cuts} AS n FROM (SELECT DISTINCT stratum FROM tried)),
tail AS (SELECT *, bad / greatest(n_bad, 1) - good / greatest(n_good, 1) AS net,
  CASE WHEN good >= n_good * {r!r} THEN 1 ELSE (SELECT sum(exp(lgamma(n_good + 1) - lgamma(g.i + 1) - lgamma(n_good - g.i + 1)
    + g.i * ln({r!r}) + (n_good - g.i) * ln(1 - {r!r}))) FROM (SELECT unnest(range(good + 1)) AS i) g) END AS p FROM tried),
best AS (SELECT stratum, measure, cutoff FROM (SELECT *, row_number() OVER (PARTITION BY stratum, measure ORDER BY net DESC, cutoff DESC) AS k
  FROM tail, tests WHERE bad > 0 AND net > 0 AND p <= {error!r} / tests.n) WHERE k = 1),
over AS (SELECT DISTINCT l.rid FROM long l JOIN best b ON l.stratum IS NOT DISTINCT FROM b.stratum AND l.measure = b.measure AND l.v > b.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND over.rid IS NULL AS kept
FROM counted LEFT JOIN over ON over.rid = counted.rid
"""
