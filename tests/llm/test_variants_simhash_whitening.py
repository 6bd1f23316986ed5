"""Spelling variants, SimHash near-duplicates and whitening, against brute force and on edge cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from staffsight.llm import simhash, spelling, whitening
from staffsight.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 11, spelling variants

def brute_variants(texts):
    count = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}

    def gaps(w):
        return {(i, w[:i] + w[i + 1:]) for i in range(len(w))}

    def is_near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        shorter = {g for _, g in gaps(a)} if len(a) > len(b) else {g for _, g in gaps(b)}
        return bool(gaps(a) & gaps(b)) if len(a) == len(b) else min(a, b, key=len) in shorter and abs(len(a) - len(b)) == 1

    near = {w: [x for x in n if x != w and is_near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    stems = ["".join(rng.choice(list("aeinrstéß"), rng.integers(4, 9))) for _ in range(60)]
    texts = []
    for i in range(80):
        said = []
        for w in rng.choice(stems, 60):
            if rng.random() < 0.3:
                at = rng.integers(len(w))
                w = w[:at] + rng.choice(["", "x", w[at] * 2]) + w[at + 1:]
            said.append(w.upper() if rng.random() < 0.2 else w)
        texts.append((int(i), " ".join(said)))
    long = "abcdefghij" * 40
    texts += [(None, "Straße strasse"), (1000, None), (1001, ""), (5, texts[5][1]), (None, None),
              (1002, f"{long} {long} {long} {long}x {long}x {long}x"), (1003, " ".join(["a" * 70] * 4 + ["a" * 71] * 9)), (1004, "日本 don't naïve-ly ×÷××÷÷ " * 3)]
    df = docs(spark, texts).withColumn("word", F.lit("clash")).withColumn("sig", F.lit(1))
    assert rows(spelling.variants(df)) == brute_variants(texts)
    assert spelling.variants(df.limit(0)).count() == 0


def test_buckets_in_blocks(spark, monkeypatch):
    words = ["aaaaa" + a + b for a in "bcdefg" for b in "bcdefg"]
    vocabulary = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    whole = rows(spelling.near_pairs(vocabulary))
    monkeypatch.setattr(spelling, "BLOCK", 4)
    monkeypatch.setattr(spelling, "GATHER", 7)
    monkeypatch.setattr(spelling, "FEW", 3)
    monkeypatch.setattr(spelling, "PAIRS", 10)
    assert rows(spelling.near_pairs(vocabulary)) == whole
    want = {(a, b) for a in words for b in words if a != b and spelling.near(a.encode(), b.encode())}
    assert {(a, b) for a, b, _ in whole} == want and len(want) == 36 * 10


def test_partenum_signatures_meet():
    rng = np.random.default_rng(1)
    for _ in range(300):
        w = "".join(rng.choice(list("abcde"), rng.integers(5, 12)))
        at = rng.integers(len(w))
        other = w[:at] + rng.choice(list("abcdez")) + w[at + rng.integers(0, 2):]
        if not spelling.near(w.encode(), other.encode()):
            continue
        sig, owner = spelling.signatures_of(*spelling.letters(pa.array([w, other])))
        assert set(sig[owner == 0]) & set(sig[owner == 1]), (w, other)


# 12, SimHash

def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(points):
    """point -> a representative, for all pairs within four bits."""
    part = {p: p for p in points}

    def root(p):
        while part[p] != p:
            p = part[p]
        return p
    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                part[y] = x
    return {p: root(p) for p in points}


def test_simhash_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}É" for i in range(300)]
    texts = []
    for family in range(8):
        base = rng.choice(vocabulary, 400)
        for _ in range(12):
            w = base.copy()
            for p in rng.integers(0, 400, rng.integers(0, 6)):
                w[p] = rng.choice(vocabulary)
            texts.append((len(texts), " ".join(w)))
    texts += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One two"), (1004, "one\ttwo"), (1005, texts[3][1].upper().replace("É", "É")),
              (3, texts[3][1]), (3, "another text with this id"), (None, texts[0][1]), (None, "alone without id here"), (1006, "a b c d"), (1007, "x " * 300_000)]
    got = simhash.near_duplicates(docs(spark, texts).withColumn("node", F.lit("clash")).withColumn("component", F.lit(1)))
    prints = [(i, brute_fingerprint(t)) for i, t in texts]
    group = brute_components(sorted({p for _, p in prints}))
    least = {}
    for i, p in prints:
        if i is not None:
            least[group[p]] = min(i, least.get(group[p], i))
    assert rows(got) == sorted(((i, f"{p:016x}", least.get(group[p])) for i, p in prints), key=repr)
    assert len(set(group.values())) < len(group)
    empty = simhash.near_duplicates(docs(spark, texts).limit(0))
    assert (empty.columns, empty.count()) == (["doc_id", "fingerprint", "component_id"], 0)


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_fingerprint_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE_BYTES", piece)
    text = "The quick  brown fox\tjumps OVER the lazy dog and runs on é " * 9
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_trees_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 40)
    monkeypatch.setattr(simhash, "LEAF", 8)
    monkeypatch.setattr(simhash, "VISITORS", 16)
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 250, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 250, dtype=np.uint64)
    points = set(seeds.tolist())
    for s in seeds[:120].tolist():  # chains of close fingerprints
        for _ in range(3):
            for b in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                s ^= 1 << b
            points.add(s)
    hot = int(seeds[7]) & simhash.PARTS[0]  # a third of all share one part
    points |= {hot | int(rng.integers(0, 1 << 41)) << 22 for _ in range(250)}
    points = sorted(points)
    signed = np.array(points, np.uint64).view(np.int64)
    nodes = spark.createDataFrame([(int(x),) for x in signed], "node long").repartition(3)
    stars = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(nodes).collect()]
    want = brute_components(points)
    part = {p: p for p in points}

    def root(p):
        while part[p] != p:
            p = part[p]
        return p
    for a, b in stars:
        x, y = sorted((root(a), root(b)))
        part[y] = x
    assert {p: root(p) for p in points} == want


# 13, whitening

def brute_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    off = x - s / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    return n, ((n * x - s) ** 2).sum(1), off, values[::-1], axes[:, ::-1]


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(13)
    mixed = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12))
    data = [(i, v.tolist()) for i, v in enumerate(mixed)]
    bad = [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, [1.0] * 5), (905, []), (906, [1e300] * 12)]
    data += [(3, data[3][1]), (None, data[4][1])]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("n", F.lit("x")).repartition(5)
    got = whitening.whitening_report(df).collect()
    n, deviation, off, values, axes = brute_whitening([v for _, v in data])
    want = off @ axes[:, :8] / np.sqrt(values[:8])
    assert len(got) == len(data) * 8 and {r.n for r in got} == {n}
    place = {i: k for k, (i, _) in enumerate(data)}
    for c in range(1, 9):
        mine = [r for r in got if r.component == c]
        one = np.array([r.whitened for r in mine])
        other = np.array([want[place[r.vec_id], c - 1] for r in mine])
        assert min(np.abs(one - other).max(), np.abs(one + other).max()) < 1e-9
        assert abs(mine[0].explained - values[c - 1] / values.sum()) < 1e-12
    assert all(r.deviation == deviation[place[r.vec_id]] for r in got)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_flat_tables(spark):
    schema = "vec_id long, embedding array<float>"
    report = lambda data: whitening.whitening_report(spark.createDataFrame(data, schema))
    assert report([]).count() == 0 and report([(1, [0.5, 0.25])]).count() == 0
    assert report([(i, [0.5, 0.25]) for i in range(5)]).count() == 0
    line = report([(i, [0.5 * i, 1.0]) for i in range(4)]).collect()
    assert sorted({r.component for r in line}) == [1] and line[0].identity_error < 1e-9 and abs(line[0].explained - 1) < 1e-12
    huge = report([(0, [float(2**38), 0.0]), (1, [-float(2**38), 1.0]), (2, [0.0, -1.0])]).collect()
    assert {r.component for r in huge} == {1} and huge[0].deviation is None and huge[0].identity_error < 1e-6


def test_slices_of_hard_spectra():
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for spectrum in ([3.0, 3, 3, 2, 1, 1, 0.5], [1.0, 1 - 1e-9, 0.5, 0.5 + 1e-13, 1e-6], [1.0], [5.0] * 40, np.arange(40, 0, -1.0)):
        d = np.zeros(40)
        d[:len(spectrum)] = spectrum
        matrix = (axes * d) @ axes.T
        matrix = (matrix + matrix.T) / 2
        values, vectors = whitening.leading(matrix, 8)
        want = np.sort(d)[::-1]
        assert len(values) == min(8, (want > 1e-9).sum())
        assert np.abs(values - want[:len(values)]).max() < 1e-12 * want[0]
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
        assert np.abs(vectors @ matrix @ vectors.T - np.diag(values)).max() < 1e-12 * want[0]


def test_positives_is_the_inertia():
    rng = np.random.default_rng(6)
    for size in range(1, 12):
        for zero in (False, True):
            a = rng.standard_normal((size, size))
            a = a + a.T
            if zero:
                np.fill_diagonal(a, 0)
            assert whitening.positives(a) == (np.linalg.eigvalsh(a) > 0).sum()


def test_queries_are_registered():
    assert {"op11_spelling_variants", "op12_simhash_neardup", "op13_embedding_whitening"} <= set(QUERIES)
