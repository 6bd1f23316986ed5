"""Operator 3, MinHash near-dedup with tensored banding.

A text's MinHash values are split into ``m`` collections of two. A table key joins two
collections, so the ``m (m - 1) / 2`` tables need ``2 m`` hash functions instead of
``2 m (m - 1)``: about the square root of the work. Two texts of similarity s meet in a
table if at least two collections agree; ``m`` is the smallest number that misses a pair at
the threshold with a chance below ``MISS``.

Steps, each a Spark job over distributed tables:

1. Every text is hashed once; texts with equal shingle sets become one node.
2. In each table bucket three nodes (the first in three fixed orders) are compared with the
   others. Links are confirmed on full sets, and components are built from them.
3. Buckets whose nodes all lie in one component are settled. In the others nodes of different
   components are compared in blocks of BLOCK nodes by a bound that loses nothing: a set's
   shingles are counted in BINS bins, and the sum over bins of the smaller count is at least
   the size of the intersection. Only pairs that can reach the threshold leave a block; they are
   confirmed on full sets too, and components are built again.

So no bucket is capped, and a group of many near copies costs a few comparisons per copy. The
agreement test before confirming in step 2 drops a true link with a chance below ``MISS``, and
only for that step.

Defined results: null or empty texts (and texts without words) have an empty set, are linked
with nothing and kept; rows with one doc_id and different texts are separate nodes; repeated
rows are equal and both get the same component; a null doc_id counts for no component and is
kept only if its component has no other id; only doc_id and text are read; an empty table
gives no rows. Fingerprints have 64 bits.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, ship
from .components import components
from .shingles import constants, mix64, shingle_lists, shingle_sets

ship(__name__)

MISS = 1e-5
#: Nodes in a block of an open bucket, and bins of a set's counts.
BLOCK, BINS = 512, 128


def _below(n: int, p: float, k: int) -> float:
    """P(Bin(n, p) < k)."""
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k))


def collections_for(threshold: float) -> int:
    """Number of two-hash collections that misses a pair at ``threshold`` with chance <= MISS."""
    m = 2
    while _below(m, threshold**2, 2) > MISS:
        m += 1
    return m


def agreement_for(threshold: float, hashes: int) -> int:
    """Agreeing values that a pair at ``threshold`` reaches but with chance <= MISS."""
    return max(k for k in range(hashes + 1) if _below(hashes, threshold, k) <= MISS)


def _hasher(k: int, hashes: int):
    mult, seed = constants(hashes, 3), constants(hashes, 4)

    def run(batches):
        for batch in batches:
            n_set, node, mins, bins = [], [], [], []
            for _, fp, begin in shingle_lists(batch.column(1), k):
                filled = np.flatnonzero(np.diff(begin))
                low = np.zeros((len(begin) - 1, hashes), np.uint64)
                if len(filled):
                    for h in range(hashes):
                        low[filled, h] = np.minimum.reduceat((fp ^ seed[h]) * mult[h], begin[filled])
                mins.append(low)
                for a, b in zip(begin[:-1], begin[1:]):
                    own = np.unique(fp[a:b])
                    n_set.append(len(own))
                    count = np.bincount((own >> np.uint64(57)).astype(np.intp), minlength=BINS)
                    bins.append(np.minimum(count, 255).astype(np.uint8).tobytes())
                    node.append(mix64(np.array([mix64(own).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64))[0])
            values = np.concatenate(mins).view(np.int64).ravel() if mins else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_set, pa.int64()), pa.array(np.array(node, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(n_set) + 1, dtype=np.int32) * hashes), pa.array(values)),
                pa.array(bins, pa.binary()), *batch.columns[2:],
            ], names=["doc_id", "n_shingles", "node", "mins", "bins", "row"][:3 + batch.num_columns])
    return run


def signatures(documents: DataFrame, k: int, hashes: int, row: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, node (set fingerprint), mins, bins (counts of shingles) for every document; and ``row`` if given."""
    key = [] if row is None else [row.alias("row")]
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), *key)
    schema = "doc_id long, n_shingles long, node long, mins array<long>, bins binary"
    return rows.mapInArrow(_hasher(k, hashes), schema + ", row string" * len(key))


def _bucket_rows(nodes: DataFrame, m: int, *keep: str) -> DataFrame:
    """(key, node, ...): a node's place in every table, a table for each pair of collections."""
    part = [F.xxhash64(F.get("mins", F.lit(2 * i)), F.get("mins", F.lit(2 * i + 1)), F.lit(i)).alias(f"c{i}") for i in range(m)]
    keys = F.array(*(F.xxhash64(f"c{i}", f"c{j}") for i, j in combinations(range(m), 2)))
    return nodes.select("node", *keep, *part).select("node", *keep, F.posexplode(keys).alias("place", "key"))


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose MinHash values agree in ``least`` places."""
    left = nodes.select(F.col("node").alias("a"), F.col("mins").alias("ma"))
    right = nodes.select(F.col("node").alias("b"), F.col("mins").alias("mb"))
    same = F.aggregate(F.zip_with("ma", "mb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(right, "b").join(left, "a").where(same >= least).select("a", "b")


def _verifier(k: int, percent: int):
    def run(batches):
        last, last_set = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1)
            # a pivot's text comes with each of its pairs; its set is made once per run of rows
            fresh = [i for i, x in enumerate(a) if x != (a[i - 1] if i else last)]
            made = dict(zip(fresh, shingle_sets(batch.column(2).take(pa.array(fresh, pa.int64())), k)))
            linked = []
            for i, own in enumerate(shingle_sets(batch.column(3), k)):
                last, last_set = a[i], made.get(i, last_set)
                both = np.intersect1d(last_set, own, assume_unique=True).size
                linked.append(100 * both >= percent * (len(last_set) + len(own) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), b, pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return run


def _verify(pairs: DataFrame, owners: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, linked): the pairs judged on the full sets of their texts.

    ``owners`` (node, owner) names the ``id`` in ``texts`` of a document of each node; only their texts are moved.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(owners, "node")
    found = texts.join(needed, texts["id"].eqNullSafe(needed["owner"])).select("node", "owner", "text")
    # rows with the same id but another text are not the node's: keep the text that hashes to it
    found = found.mapInArrow(_own_text(k), "node long, text string").dropDuplicates(["node"])
    found = save(found, "neardup-texts")
    right = found.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    left = found.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return joined.mapInArrow(_verifier(k, percent), "a long, b long, linked boolean")


def _own_text(k: int):
    def run(batches):
        for batch in batches:
            node = []
            for own in shingle_sets(batch.column(2), k):
                node.append(mix64(np.array([mix64(own).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64))[0])
            keep = pa.array(np.array(node, np.uint64).view(np.int64) == batch.column(0).to_numpy(zero_copy_only=False), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["node", "text"]).filter(keep)
    return run


def _reachable(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows of x and y can have the similarity, by their bin counts."""
    out = np.zeros((len(x), len(y)), bool)
    for i in range(len(x)):
        shared = np.minimum(x[i], y).sum(1, dtype=np.int64)
        # a bin of 255 may hold more: such a set can reach anything that its size allows
        shared = np.where((x[i] == 255).any() | (y == 255).any(1), np.minimum(nx[i], ny), np.minimum(shared, np.minimum(nx[i], ny)))
        out[i] = 100 * shared >= percent * (nx[i] + ny - shared)
    return out


def _first_place(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first table in which the rows of x and y (MinHash values) meet."""
    m = x.shape[1] // 2
    agree = (x == y).reshape(-1, m, 2).all(2)
    one = agree.argmax(1)
    agree[np.arange(len(agree)), one] = False
    place = np.zeros((m, m), np.int64)
    for t, (i, j) in enumerate(combinations(range(m), 2)):
        place[i, j] = t
    return place[one, agree.argmax(1)]


def _block_pairs(percent: int):
    """Candidates among rows (key, i, j, side, place, node, component, n_shingles, bins, mins) sorted by key, i, j.

    Two nodes meet in many tables; only the first of these emits the pair.
    """
    def pairs(side, place, node, component, n, bins, mins):
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        ok = _reachable(bins[left], n[left], bins[right], n[right], percent) & (component[left][:, None] != component[right][None, :])
        i, j = np.nonzero(ok)
        i, j = left[i], right[j]
        here = _first_place(mins[i], mins[j]) == place[i]
        i, j = i[here], j[here]
        return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches):
        held = None
        for batch in _then_none(batches):
            found = []
            if batch is not None:
                own = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)]
                own.append(np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8).reshape(-1, BINS))
                own.append(batch.column(9).flatten().to_numpy().reshape(batch.num_rows, -1))
                held = own if held is None else [np.concatenate(x) for x in zip(held, own)]
            if held is None:
                continue
            change = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0)) + 1
            cuts = [0, *change.tolist(), *([len(held[0])] if batch is None else [])]
            for a, b in zip(cuts[:-1], cuts[1:]):
                found.append(pairs(*(x[a:b] for x in held[3:])))
            held = [x[cuts[-1]:] for x in held]
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                both = np.unique(np.stack((a, b)), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])
    return run


def _then_none(batches):
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _open_pairs(nodes: DataFrame, m: int, labelled: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of buckets that hold nodes of more than one component."""
    place = nodes.select("node", "mins").join(labelled, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = _bucket_rows(place, m, "component")
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    members = rows.join(mixed.select(F.col("key").alias("k"), "n"), F.col("key") == F.col("k")).select("key", "place", "node", "component", "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a node goes to each block pair that holds its block
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "place", "node", "component")
    members = members.join(nodes.select("node", "n_shingles", "bins", "mins"), "node").select(
        "key", "i", "j", "side", "place", "node", "component", "n_shingles", "bins", "mins")
    dealt = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_block_pairs(percent), "a long, b long").where("a <> b").distinct()


def _grouped(documents: DataFrame, k: int, percent: int, row: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, group (of near copies, null for empty sets) for every document; and ``row`` if given.

    ``row`` also names the texts, which doc_id does slowly if it is null or repeated in many rows.
    """
    key = "doc_id" if row is None else "row"
    texts = documents.select((F.col("doc_id").cast("long") if row is None else row).alias("id"), F.col("text").cast("string").alias("text"))
    m = collections_for(percent / 100)
    least = agreement_for(percent / 100, 2 * m)
    base = save(signatures(documents, k, 2 * m, row), "neardup-base")
    nodes = save(base.where("n_shingles > 0").groupBy("node").agg(
        F.first("mins").alias("mins"), F.first("bins").alias("bins"), F.first("n_shingles").alias("n_shingles"),
        F.min(key).alias("owner")), "neardup-nodes")
    owners = nodes.select("node", "owner")

    rows = _bucket_rows(nodes, m)
    shuffled = F.struct(F.xxhash64("node", F.lit(1)), "node")
    pivots = rows.groupBy("key").agg(F.min("node").alias("p0"), F.max("node").alias("p1"), F.min(shuffled)["node"].alias("p2"), F.count("*").alias("n"))
    pivots = pivots.where("n > 1").select(F.col("key").alias("k"), F.array_distinct(F.array("p0", "p1", "p2")).alias("p"))
    star = rows.join(pivots, rows["key"] == pivots["k"]).select(F.explode("p").alias("p"), "node").where("p <> node")
    star = star.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()
    star = save(_agreeing(star, nodes, least), "neardup-star")
    judged = save(_verify(star, owners, texts, k, percent), "neardup-judged")
    links = judged.where("linked").select("a", "b")
    labelled = save(components(links), "neardup-components")

    rest = save(_open_pairs(nodes, m, labelled, percent).join(judged.select("a", "b"), ["a", "b"], "left_anti"), "neardup-rest")
    if not rest.isEmpty():
        more = save(_verify(rest, owners, texts, k, percent).where("linked").select("a", "b"), "neardup-more")
        if not more.isEmpty():
            known = labelled.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labelled = save(components(known.unionByName(more)), "neardup-components")

    placed = base.drop("mins", "bins").join(labelled, "node", "left")
    return placed.withColumn("group", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))).drop("node", "component")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document.

    Texts are linked if 100 * |intersection| >= percent * |union| of their sets of ``k``-word
    shingles; component_id is the smallest doc_id reachable over links.
    """
    placed = _grouped(documents, k, percent)
    lowest = placed.where("group IS NOT NULL").groupBy(F.col("group").alias("g")).agg(F.min("doc_id").alias("component_id"))
    out = placed.join(lowest, F.col("group") == F.col("g"), "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def first_rows(documents: DataFrame, row: Column, k: int = 5, percent: int = 80) -> DataFrame:
    """row: of each group of near copies the one with the smallest (doc_id, row), null ids last; all with empty sets."""
    placed = _grouped(documents, k, percent, row)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))["row"]
    first = placed.where("group IS NOT NULL").groupBy("group").agg(least.alias("row")).select("row")
    return first.unionByName(placed.where("n_shingles = 0").select("row"))


def oracle(k: int = 3, percent: int = 85) -> str:
    """The query as DuckDB SQL: counts of shared shingles over all pairs that share one."""
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{space}+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, md5_number(CASE WHEN len(w) < {k} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {k - 1}], ' ') END) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM split WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
hit AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM hit JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id,
  s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
FROM split s LEFT JOIN n ON n.doc_id = s.doc_id LEFT JOIN least l ON l.doc_id = s.doc_id
"""
