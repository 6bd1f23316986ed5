"""Operator 9, URL filter, by a cascade of Bloom filters.

A cascade decides membership in a list exactly for every key of a known universe (all keys
the corpus can ask for): level 0 holds the listed keys, level 1 the universe's keys that
level 0 accepts wrongly, level 2 the listed keys that level 1 accepts wrongly, and so on,
until a level accepts none wrongly. Looking a key up is a few bit tests against literals, so
judging pages needs no join and no shuffle. Only building a level looks at the universe.

Sizes: level 0 has the false-positive rate that leaves about as many wrong keys as the list
has, later levels one half; so the filters take about |list| * log2(|universe| / |list|)
bits, growing with the list, not with the pages. Only these bits reach the driver.

Host rules and the block list are keys: a page asks for the suffixes of its host (of the
label counts that occur in the list) joined with the prefixes of its path (of the lengths
that occur in the list).

Defined results: a null url, or one without ``://``, has empty host and path, fits nothing
and is allowed; of fitting rules the longest wins, of equally long ones the one with the
longer host; repeated pages are judged each; an empty table gives no rows; only the id and
url columns are read. Only SQL functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, forget, save

#: Verdict, host, path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Hosts blocked with their subdomains where no rule decides.
BLOCKED_HOSTS = ("spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org", "link-farm.example.net",
                 "casino.example.com", "doorway.example.net")

LN2 = math.log(2)


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    salt: int
    words: tuple[int, ...]

    def accepts(self, key: Column) -> Column:
        filled = F.expr(f"cast(split('{','.join(map(str, self.words))}', ',') as array<bigint>)")
        return reduce(lambda a, b: a & b, (
            F.getbit(F.get(filled, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1
            for p in _positions(key, self.bits, self.hashes, self.salt)))


def _positions(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(salt), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def _fill(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """A filter of the ``n`` keys of ``keys`` with about this false-positive rate."""
    bits = max(64, 64 * math.ceil(n * math.log(1 / rate) / LN2**2 / 64))
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    pos = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, hashes, salt))).alias("p"))
    rows = pos.groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row["w"]] = row["b"]
    return Level(bits, hashes, salt, tuple(words))


class Cascade:
    """Exact membership in a list, for the keys of a universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """``listed`` and ``universe`` have a column ``key``; null keys are left out."""
        on = listed.where("key is not null").select("key").distinct().withColumn("on", F.lit(True))
        marked = save(universe.where("key is not null").select("key").distinct().join(on, "key", "left")
                      .withColumn("on", F.coalesce("on", F.lit(False))), "url-universe")
        counts = dict(marked.groupBy("on").count().collect())
        n, rest = counts.get(True, 0), counts.get(False, 0)
        levels: list[Level] = []
        sides = {True: marked.where("on").select("key"), False: marked.where("not on").select("key")}
        side, rate = True, min(0.5, max(1e-9, n * math.sqrt(0.5) / max(rest, 1)))
        while n:
            level = _fill(sides[side], n, rate, salt=len(levels))
            levels.append(level)
            side, rate = not side, 0.5
            # of the other side's keys still in play, those that this level accepts wrongly
            sides[side] = sides[side].where(level.accepts(F.col("key")))
            n = sides[side].count()
        forget(marked)
        return cls(levels)

    def member(self, key: Column) -> Column:
        """True for listed keys, false for the universe's others and for null."""
        if not self.levels:
            return F.lit(False)
        out = None
        for i in reversed(range(len(self.levels))):
            hit = self.levels[i].accepts(key)
            if i % 2 == 0:
                out = hit if out is None else hit & out
            else:
                out = ~hit if out is None else ~hit | out
        return F.coalesce(out, F.lit(False))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an url; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)
    return ascii_lower(host), path


def suffix(host: Column, labels: int) -> Column:
    """The last labels of a host; null for an empty host."""
    return F.when(host != "", F.substring_index(host, ".", -labels))


def rule_keys(rules, host: Column, path: Column) -> list[tuple[Column, Column]]:
    """(host suffix, key) for each label count and path length that occurs in ``rules``."""
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    return [(suffix(host, n), F.when(F.length(path) >= m, F.concat(suffix(host, n), F.substring(path, 1, m))))
            for n, m in shapes]


def judge_urls(pages: DataFrame, rules=RULES, blocked_hosts=BLOCKED_HOSTS, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict for every page."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    h, p = F.col("host"), F.col("path")
    asked = rule_keys(rules, h, p)
    universe = split.select(F.explode(F.array_distinct(F.array(*(k for _, k in asked)))).alias("key"))
    deep = sorted({b.count(".") + 1 for b in blocked_hosts})
    names = split.select("host").distinct().select(F.explode(F.array_distinct(F.array(*(suffix(h, n) for n in deep)))).alias("key"))
    listed = lambda keys: spark.range(1).select(F.explode(F.array(*map(F.lit, keys))).alias("key"))
    universe = save(universe.distinct(), "url-keys")
    cascades = {v: Cascade.build(listed(a + b for w, a, b in rules if w == v), universe) for v in sorted({r[0] for r in rules})}
    hosts = Cascade.build(listed(blocked_hosts), names)
    forget(universe)
    fits = [F.when(c.member(key), F.struct(F.length(key).alias("n"), F.length(s).alias("m"), key.alias("rule"), F.lit(v).alias("verdict")))
            for s, key in asked for v, c in cascades.items()]
    best = F.greatest(*fits, F.lit(None).cast("struct<n:int,m:int,rule:string,verdict:string>"))
    on_list = reduce(lambda a, b: a | b, (hosts.member(suffix(h, n)) for n in deep))
    return split.withColumn("best", best).select(
        id_col, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.when(on_list, "block").otherwise("allow")).alias("verdict"))


ORACLE = f"""
WITH rules(verdict, host, path) AS (VALUES {', '.join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT row_number() OVER () AS rid, page_id,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN
  {' OR '.join(f"host = '{b}' OR ends_with(host, '.{b}')" for b in BLOCKED_HOSTS)} THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN fit USING (rid)
"""
