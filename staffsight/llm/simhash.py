"""Operator 12, SimHash near-dedup with vantage-point trees.

Fingerprints. A text's shingles (repeats included) are hashed to 64 bits; a fingerprint bit is 1 if
more than half of the hashes have it. Equal fingerprints are one node.

Trees. Fingerprints that differ in at most RADIUS bits differ in at most one bit of one of the
three parts that the 64 bits are cut into. So each part has a vantage-point tree over the
Hamming distance within the part: a tree node has a vantage point and a cut, fingerprints up to
the cut from the vantage point are inside, the others outside. By the triangle inequality two
fingerprints within ``r`` of each other are on one side unless they are within ``r`` of the cut.
(On all 64 bits a tree hardly prunes: unrelated fingerprints are 32 +- 4 bits from any vantage point,
so most of them lie within RADIUS of the cut. Where a part does not tell a node's fingerprints
apart, the node does use all bits.)

Shards. The upper levels are built by the driver from a bounded sample (SAMPLE fingerprints a
shard, MAX_SHARDS shards) and deal out all fingerprints: each has one home shard, and visits
every shard beyond a cut that it is close to (of a pair across a cut the inner one goes). A shard is
one task's work: it splits its home fingerprints further by vantage points of its own, sends the
home and visiting fingerprints down all branches that the triangle inequality leaves open, and
compares whole fingerprints in the leaves. Linked fingerprints leave a shard as a star around one of
them, so a group of many close fingerprints gives as many rows, not all its pairs.

Components of these stars are built by joins; the result is exact.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are linked
like any other; rows with one doc_id and different texts are judged by themselves; repeated rows
get equal results; a null doc_id counts for no component, and is null where its component has no
other id; an empty table gives no rows; texts are hashed whole, in pieces of about
PIECE_BYTES; only doc_id and text are read.
"""

from __future__ import annotations

import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, save, ship
from .components import components

ship(__name__)

WORDS, SEED, RADIUS = 4, 42, 4
#: The bits of the three parts, and how far apart a linked pair is in one of them at most.
PARTS = (0x3FFFFF, 0x1FFFFF << 22, 0x1FFFFF << 43)
PART_RADIUS = RADIUS // len(PARTS)
ALL_BITS = (1 << 64) - 1
#: Home fingerprints a shard is meant to have, most shards of a tree, sampled fingerprints a shard.
SHARD, MAX_SHARDS, SAMPLE = 8192, 4096, 32
#: Fingerprints compared at once in a leaf of a shard's tree, and visitors sent down it together.
LEAF, VISITORS = 512, 1 << 18
PIECE_BYTES = 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, lowest first."""
    digits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    bits = np.zeros((-(-len(hashes) // 255), 255, 64), np.uint8)
    bits.reshape(-1, 64)[:len(hashes)] = np.unpackbits(digits, axis=1, bitorder="little")
    return bits.sum(1, dtype=np.uint8).sum(0, dtype=np.int64)


def fingerprint(text: str | None, k: int = WORDS, seed: int = SEED) -> int:
    data = (text or "").encode().lower()  # bytes: A-Z only
    ones, n, at, kept = np.zeros(64, np.int64), 0, 0, []
    digest = xxhash.xxh64_intdigest
    while at < len(data):
        gap = _GAP.search(data, at + PIECE_BYTES)
        end = gap.start() if gap else len(data)
        words = kept + data[at:end].split()
        at = end
        if len(words) >= k:
            line = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            hashes = [digest(line[a:b - 1], seed) for a, b in zip([0, *ends], ends[k - 1:])]
            ones += _bit_counts(hashes)
            n += len(hashes)
        kept = words[-(k - 1):] if len(words) >= k else words
    if not n and kept:  # fewer words than a shingle has
        ones, n = _bit_counts([digest(b" ".join(kept), seed)]), 1
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def _fingerprints(k: int, seed: int):
    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(t, k, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "node"])
    return run


def fingerprints(documents: DataFrame, k: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, node (the fingerprint as a signed long) of every document."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(k, seed), "doc_id long, node long")


def _distance(points: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((points ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int64)


def _split(points: np.ndarray, mask: int) -> tuple[int, int, int, int] | None:
    """vantage, mask, radius, cut that divides the points best, by the part or else by all bits."""
    for bits, radius in ((mask, PART_RADIUS), (ALL_BITS, RADIUS)):
        for vantage in (points[0], points[len(points) // 2]):
            ordered = np.sort(_distance(points, int(vantage), bits))
            inside = np.searchsorted(ordered, np.arange(64), side="right")
            cut = int(np.abs(2 * inside - len(points)).argmin())
            if 8 * min(inside[cut], len(points) - inside[cut]) >= len(points):
                return int(vantage), bits, radius, cut
    return None


def plant(sample: np.ndarray, mask: int, smallest: int) -> tuple:
    """A tree from sampled fingerprints: (vantage, mask, radius, cut, inner, outer), or () for a shard."""
    found = _split(sample, mask) if len(sample) >= 2 * smallest else None
    if found is None:
        return ()
    inside = _distance(sample, found[0], found[1]) <= found[3]
    return (*found, plant(sample[inside], mask, smallest), plant(sample[~inside], mask, smallest))


def deal(tree: tuple, points: np.ndarray, homes: np.ndarray, visits: np.ndarray, first: int = 0):
    """(shard, rows at home, rows that visit) for every shard below the tree that any row reaches."""
    if not tree:
        yield first, homes, visits
        return
    vantage, mask, radius, cut, inner, outer = tree
    far, near = _distance(points[homes], vantage, mask), _distance(points[visits], vantage, mask)
    crossing = homes[(far <= cut) & (far + radius > cut)]
    yield from deal(inner, points, homes[far <= cut], visits[near - radius <= cut], first)
    yield from deal(outer, points, homes[far > cut], np.concatenate((visits[near + radius > cut], crossing)), first + shards_of(inner))


def shards_of(tree: tuple) -> int:
    return shards_of(tree[4]) + shards_of(tree[5]) if tree else 1


def _dealer(trees: list[tuple]):
    def run(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            for part, tree in enumerate(trees):
                shard, rows, home = [], [], []
                for number, at, visiting in deal(tree, points, np.arange(len(points)), np.zeros(0, np.int64)):
                    rows += [at, visiting]
                    shard.append(np.full(len(at) + len(visiting), number))
                    home.append(np.repeat([True, False], [len(at), len(visiting)]))
                taken = points[np.concatenate(rows)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(taken), part, np.int32)), pa.array(np.concatenate(shard).astype(np.int32)), pa.array(np.concatenate(home)), pa.array(taken)],
                    names=["part", "shard", "home", "node"])
    return run


def close(points: np.ndarray, homes: np.ndarray, others: np.ndarray, queries: np.ndarray, mask: int):
    """Index arrays (of others, of points) of the pairs within RADIUS, by a tree over the home points."""
    if not len(homes) or not len(queries):
        return
    found = _split(points[homes], mask) if len(homes) > LEAF else None
    if found:
        vantage, bits, radius, cut = found
        far, near = _distance(points[homes], vantage, bits), _distance(others[queries], vantage, bits)
        yield from close(points, homes[far <= cut], others, queries[near - radius <= cut], mask)
        yield from close(points, homes[far > cut], others, queries[near + radius > cut], mask)
        return
    for i in range(0, len(queries), LEAF):
        for j in range(0, len(homes), LEAF):
            q, h = queries[i:i + LEAF], homes[j:j + LEAF]
            a, b = np.nonzero(np.bitwise_count(others[q][:, None] ^ points[h][None, :]) <= RADIUS)
            yield q[a], h[b]


class Groups:
    """Which home points of a shard are linked, as pointers to a smaller one."""

    def __init__(self, size: int):
        self.to = np.arange(size)

    def root(self, x: np.ndarray) -> np.ndarray:
        x = self.to[x]
        while True:
            up = self.to[x]
            if (up == x).all():
                return x
            x = up

    def link(self, query: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joins the homes of each query; returns the queries and their root."""
        asked, place = np.unique(query, return_inverse=True)
        while True:
            root = self.root(home)
            least = np.full(len(asked), len(self.to))
            np.minimum.at(least, place, root)
            if (root == least[place]).all():
                return asked, least
            np.minimum.at(self.to, root, least[place])


def _stars(batches):
    """a, b: linked fingerprints of each shard, from rows (part, shard, home, node) sorted by part, shard, homes first."""
    def grouped(mask, homes):
        """The groups of the home points by their own links."""
        groups, every = Groups(len(homes)), np.arange(len(homes))
        for q, h in close(homes, every, homes, every, mask):
            groups.link(np.concatenate((q, q)), np.concatenate((h, q)))
        return groups

    def stars(mask, homes, others, groups):
        """Links of visitors to home points; homes that a visitor links are joined in ``groups``."""
        links = [(np.zeros(0, np.int64),) * 2]
        for q, h in close(homes, np.arange(len(homes)), others, np.arange(len(others)), mask):
            links.append(groups.link(q, h))
        q, r = (np.concatenate(x) for x in zip(*links))
        return q, groups.root(r)

    def batch_of(a, b):
        differ = a != b
        return pa.RecordBatch.from_arrays([pa.array(a[differ].view(np.int64)), pa.array(b[differ].view(np.int64))], names=["a", "b"])

    def shard_links(rows):
        """rows: an iterator over (part, home, node) arrays of one shard, homes first."""
        parts, groups, homes, waiting = [], None, None, []
        for part, home, node in rows:
            mask = PARTS[part]
            if home.any():
                parts.append(node[home])
            if not home.all():
                if groups is None:
                    homes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
                    groups = grouped(mask, homes)
                waiting.append(node[~home])
                if sum(map(len, waiting)) >= VISITORS:
                    others, waiting = np.concatenate(waiting), []
                    q, r = stars(mask, homes, others, groups)
                    yield batch_of(others[q], homes[r])
        if groups is None:
            homes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            groups = grouped(mask, homes)
        if waiting:
            others = np.concatenate(waiting)
            q, r = stars(mask, homes, others, groups)
            yield batch_of(others[q], homes[r])
        yield batch_of(homes, homes[groups.root(np.arange(len(homes)))])

    pending = _Shards(batches)
    while pending.more():
        yield from shard_links(pending.one())


class _Shards:
    """Cuts a stream of batches sorted by part and shard into shards, batch by batch."""

    def __init__(self, batches):
        self.batches, self.now = iter(batches), None

    def more(self) -> bool:
        while self.now is None or not len(self.now[0]):
            batch = next(self.batches, None)
            if batch is None:
                return False
            part, shard, home, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            self.now = part, shard, home, node.view(np.uint64)
        return True

    def one(self):
        key = self.now[0][0], self.now[1][0]
        while self.more():
            part, shard, home, node = self.now
            other = np.flatnonzero((part != key[0]) | (shard != key[1]))
            end = int(other[0]) if len(other) else len(part)
            if not end:
                return
            self.now = tuple(x[end:] for x in self.now)
            yield key[0], home[:end], node[:end]


def links(nodes: DataFrame) -> DataFrame:
    """a, b: pairs of fingerprints whose components are those of all pairs within RADIUS."""
    total = nodes.count()
    shards = max(1, min(total // SHARD, MAX_SHARDS))
    trees = [()] * len(PARTS)
    if shards > 1:
        share = int((1 << 30) * min(1.0, SAMPLE * shards / total))
        sample = nodes.where(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) < share).select("node").toPandas()["node"]
        points = np.sort(sample.to_numpy(np.int64).view(np.uint64))
        points = np.random.default_rng(len(points)).permutation(points)
        trees = [plant(points, mask, SAMPLE // 2) for mask in PARTS]
    dealt = nodes.select("node").mapInArrow(_dealer(trees), "part int, shard int, home boolean, node long")
    dealt = dealt.repartition("part", "shard").sortWithinPartitions("part", "shard", F.desc("home"))
    return dealt.mapInArrow(_stars, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, k: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every document."""
    base = save(fingerprints(documents, k, seed), "simhash-base")
    nodes = save(base.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    found = save(links(nodes), "simhash-links")
    placed = save(components(found), "simhash-components")
    inner = nodes.join(placed, "node").select("node", "doc_id", "component")
    lowest = inner.groupBy("component").agg(F.min("doc_id").alias("lowest"))
    # a table of one row a fingerprint, written so that a fingerprint of very many documents is split as a skewed key
    ids = save(inner.join(save(lowest, "simhash-lowest"), "component").select("node", "lowest"), "simhash-ids")
    alone = nodes.join(ids, "node", "left").select(F.col("node").alias("n"), F.coalesce("lowest", "doc_id").alias("component_id"))
    alone = save(alone, "simhash-all")
    for table in (found, placed, ids):
        forget(table)
    out = base.join(alone, F.col("node") == F.col("n"), "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")
