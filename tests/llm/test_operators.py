"""The training-data operators on small fixtures, against brute force and on edge cases."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from staffsight.llm import ann, bpe, chat, components, licenses, mixing, neardup, pii, quality, shingles, urls, warc
from staffsight.llm.common import save
from staffsight.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def docs(spark, *texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("key", sorted(set(ORACLES) - {"op3_minhash_neardup"}))
def test_query_equals_sql(spark, duck, key):
    got = QUERIES[key](spark, SMALL)
    cur = duck.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, rows(got.select(*names)))) == want


# 1, licence scan

def test_license_scan(spark):
    mit = next(t for k, t in licenses.KNOWN if len(t) > 500 and k == "MIT")
    changed = "Copyright (c) 2020 Someone\n" + mit.upper().replace(",", " ;").replace("SUBLICENSE", "sub-licence")
    df = docs(spark, changed, "text\nRELEASED under the  MIT Licence!\nmore", None, "", "Released under the MIT License and more",
              "Released under the MIT License.").withColumn("digest", F.lit(1)).withColumn("unit", F.lit("x"))
    got = {(r.doc_id, r.unit, r.line_no, r.license) for r in licenses.scan_licenses(df).collect()}
    assert got == {(0, "text", 0, "MIT"), (1, "line", 2, "MIT"), (5, "text", 0, "MIT"), (5, "line", 1, "MIT")}
    assert licenses.scan_licenses(df.limit(0)).count() == 0


# 2, chat formatting

HARD = ["plain", "", None, "a </turn>\n### user:\nb", "\\", "\\b \\/ \\# \\n", "### ### x", "</turn></turn>", "</tur", "é\n\n日本 🙂", "<\\/turn>"]


def test_chat_round_trip(spark):
    data = [(1, i, r, t) for i, (t, r) in enumerate(zip(HARD * 2, ["user"] * len(HARD) + ["assistant"] * len(HARD)))]
    data += [(2, 0, "a\nb:### \\", "x"), (2, None, None, "first"), (None, 0, "user", "n"), (None, 0, "user", "n"), (3, 0, "assistant", "y" * 300_000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    made = chat.format_chat(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.p] for r in made.select("conv_id", chat.parse(F.col("formatted")).alias("p")).collect()}
    assert back[1] == [(r, t or "") for _, _, r, t in data[:2 * len(HARD)]]
    assert back[2] == [("", "first"), ("a\nb:### \\", "x")]
    assert back[None] == [("user", "n")] * 2
    got = {r.conv_id: r for r in chat.chat_digests(made).collect()}
    said = "".join(t or "" for t in HARD)
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(said), sha(said)) and got[2].loss_chars == 0
    assert got[3].loss_sha256 == sha("y" * 300_000)
    text = made.where("conv_id = 1").first().formatted
    assert text.count("### ") == text.count("</turn>") == 2 * len(HARD)
    assert chat.format_chat(df.limit(0)).count() == 0


# 3, near duplicates

def brute_components(texts, k, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    part = {i: i for i in texts}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i
    for i in texts:
        for j in texts:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    rng = np.random.default_rng(k)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for family in range(6):  # families with light and heavy edits, so that buckets hold several components
        base = rng.choice(vocabulary, 120)
        for _ in range(40):
            w = base.copy()
            for p in rng.integers(0, 120, rng.integers(0, 9)):
                w[p] = rng.choice(vocabulary)
            texts[len(texts)] = " ".join(w)
    texts |= {1000: None, 1001: "", 1002: " \t ", 1003: "One two", 1004: "one\ttwo", 1005: "two one", 1006: texts[3].upper(), 1007: "x " * 60_000}
    df = docs(spark, *texts.values(), ids=list(texts)).withColumn("node", F.lit("clash")).withColumn("key", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k, percent).collect()}
    assert got == brute_components(texts, k, percent)


def test_near_duplicates_edges(spark):
    empty = neardup.near_duplicates(docs(spark, "a").limit(0))
    assert empty.count() == 0
    df = docs(spark, "same text here", "same text here", "same text here", "other words", ids=[None, 7, 7, 7])
    assert sorted(rows(neardup.near_duplicates(df, 3, 85)), key=repr) == [
        (7, 1, 7, True), (7, 1, 7, True), (7, 1, 7, True), (None, 1, 7, False)]


def test_block_bound_loses_nothing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))]
    sets += [np.unique(np.concatenate((sets[0][:n], rng.integers(0, 2**63, 200 - n, dtype=np.uint64)))) for n in range(150, 200, 2)]
    bins = np.array([np.minimum(np.bincount((s >> np.uint64(57)).astype(int), minlength=neardup.BINS), 255) for s in sets], np.uint8)
    n = np.array([len(s) for s in sets])
    ok = neardup._reachable(bins, n, bins, n, 85)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert ok[i, j] or 100 * both < 85 * (len(a) + len(b) - both)


def test_shingles_and_components(spark):
    one, two = shingles.shingle_sets(pa.array(["A b\tc d", "a  B c\nd"]), 3)
    assert (one == two).all() and len(one) == 2
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 5), (7, 7), (3, 1)], "a long, b long")
    assert dict(rows(components.components(links))) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 4}
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert set(dict(rows(components.components(chain))).values()) == {0}


# 4, nearest neighbours

def test_ann_recall_and_edges(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((1500, 32))
    v[40:60] = v[0]  # equal vectors
    data = [(i, x.tolist()) for i, x in enumerate(v)] + [(1501, None), (1502, [0.0] * 32), (1503, [float("nan")] * 32), (1504, [1.0]), (None, v[1].tolist()), (5, v[5].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    u = v / np.linalg.norm(v, axis=1)[:, None]
    hit = 0
    for q in range(0, 1500, 50):
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s.round(12)))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5] and all(abs(s[i] - x) < 1e-12 for i, x in got[q].values())
        hit += len(set(best.tolist()) & {i for i, _ in got[q].values()})
    assert set(got) == set(range(0, 1500, 50)) and hit >= 0.9 * 150
    assert [got[0][i][0] for i in range(1, 6)] == [40, 41, 42, 43, 44] and [got[50][i][0] for i in range(1, 6)] == [0, 40, 41, 42, 43]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 0.0])], "vec_id long, embedding array<double>")
    assert rows(ann.nearest(few)) == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert ann.nearest(few.limit(0)).count() == 0


# 5, WARC

def test_warc_round_trip_and_audit(spark, tmp_path):
    data = [(i, f"http://h/{i}", f"é{i}\r\n\r\nWARC/1.0\r\n" * (i % 7)) for i in range(2100)] + [(None, None, None), (3, "http://h/3", "twice"), (9, "http://h/9", "é9")] * 2
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("hash", F.lit(0)).withColumn("idx", F.lit(0))
    warc.write_warc(warc.records(pages), str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    want = sorted((f"<urn:page:{'' if i is None else i}>", u or "", (h or "").encode()) for i, u, h in data)
    assert sorted((r.record_id, r.uri, bytes(r.payload)) for r in back.collect()) == want
    got = warc.fixity_report(pages).collect()
    assert sum(r.copies for r in got) == len(data)
    assert {r.page_id for r in got if r.status == "missing"} == {i for i in range(2100) if i % 211 == 5}
    assert {r.page_id for r in got if r.status == "damaged"} == {i for i in range(2100) if i % 101 == 7 and i % 211 != 5}
    assert warc.fixity_report(pages.limit(0)).count() == 0


def test_warc_audit_of_two_replicas(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"text {i} " * (i % 5)) for i in range(2300)], "page_id long, url string, html string")
    found = {}
    for name, html in (("a", F.col("html")), ("b", F.when(F.col("page_id") == 1500, F.lit("text? 0 text! 0 ")).otherwise(F.col("html")))):
        warc.write_warc(warc.records(pages, html), str(tmp_path / name))
        found[name] = save(warc.located(warc.read_warc(spark, str(tmp_path / name))), name)
    first, second = found["a"], found["b"]
    assert {r.status for r in warc.audit(first, first).collect()} == {"intact"}
    # the files agree with the manifest, and page 1500's longer record shifts those after it
    hashed = pages.select(*(e.alias(c) for c, e in warc._leaf_columns().items()))
    assert {r.status for r in warc.audit(warc.manifest(hashed), first).collect()} == {"intact"}
    at = lambda df: {(r.archive, r.start, r.end): r.hash for r in df.collect()}
    moved = second.where("archive < 2").unionByName(second.where("archive = 2").withColumn("start", F.col("start") + 8).withColumn("end", F.col("end") + 8))
    moved = moved.where("NOT (archive = 0 AND start = 0)").unionByName(first.where("archive = 0 AND start = 0").withColumn("archive", F.lit(7).cast("long")))
    a, b = at(first), at(moved)
    want = {k: "missing" if k not in b else "extra" if k not in a else "intact" if a[k] == b[k] else "damaged" for k in {*a, *b}}
    got = {(r.archive, r.start, r.end): r.status for r in warc.audit(first, moved).collect()}
    assert got == want and {*want.values()} >= {"missing", "extra", "intact"}
    # equal records at other ranges have other roots
    shifted = first.withColumn("start", F.col("start") + 8).withColumn("end", F.col("end") + 8)
    roots = [warc.tree(warc.manifest(hashed).select(F.col("archive").alias("grp"), "idx", "hash", (F.col("start") + d).alias("start"), (F.col("end") + d).alias("end")),
                       (3, 1), "t")[-1].first().hash for d in (0, 8)]
    assert roots[0] != roots[1] and {r.status for r in warc.audit(first, shifted).collect()} >= {"missing", "extra"}
    assert warc.audit(first.limit(0), first.limit(0)).count() == 0


def test_warc_audit_reads_only_what_differs(spark):
    sizes = "archive long, start long, end long, hash string"
    data = [(a, 9000 * i, 9000 * i + 9000, f"{a}-{i}") for a in range(40) for i in range(600)]
    first = spark.createDataFrame(data, sizes)
    read = []
    assert {r.status for r in warc.audit(first, first, read).collect()} == {"intact"} and read == [2]
    bad = [(*r[:3], "?") if r[:2] == (17, 9000 * 333) else r for r in data]
    read = []
    found = [r for r in warc.audit(first, spark.createDataFrame(bad, sizes), read).collect() if r.status != "intact"]
    assert [(r.archive, r.start, r.first, r.second, r.status) for r in found] == [(17, 9000 * 333, "17-333", "?", "damaged")]
    # each of the six levels (three of the collection, three of the archive) reads the children of one node of each replica
    assert read[0] == 2 and all(n <= 2 * warc.FANOUT for n in read) and len(read) == 6


# 6, BPE

def reference_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_reference(spark):
    hard = ["", None, "a's 'sing ''s  \n\n x  y's'll 123abc ½", " " * 9000 + "x" + "ab" * 6000 + "\n" * 70, "日本語 🙂🙂", "<|endoftext|>",
            "".join(map(chr, range(1, 3000)))]
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(hard)], "doc_id long, text string")).withColumn("ids", F.lit(1))
    enc = reference_encoding()
    got = {r.doc_id: r for r in bpe.digests(table, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    for r in table.collect():
        ids = enc.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == sha(r.text or "")
    assert bpe.digests(table.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_bpe_streaming():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    text = "é🙂 broken" * 50
    ids = codec.encode(text)
    assert codec.decode(ids, block=1) == (text.encode(), text)
    assert codec.decode(ids[1:2])[1].count("\ufffd") <= 1


# 7, personal data

BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def test_pii_base_equals_patterns():
    rng = np.random.default_rng(3)
    anchors = pii.automaton()
    parts = list("abc@@..++--  ()019é%_") + ["4111 1111 1111 1111", "1.2.3.4", "+1 (555) 010-9999", "a.b@c.de", "300.1.1.1"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(1, 40)))
        assert [s for s in pii.find(text, anchors) if s[0] in pii.BASE] == brute_pii(text), text


def test_pii_cues_in_any_case():
    anchors = pii.automaton()
    for lead in ("", "\u0130\u0130 ", "\u00c4 "):  # U+0130 lower-cases to two code points
        text = lead + "Https://a.example/X ACCOUNT NO 12345678 Ssn: 123-45-6789 iBaN DE89 3704 0044 0532 0130 00"
        spans = [s for s in pii.find(text, anchors) if s[0] not in pii.BASE]
        assert [text[a:b] for _, a, b in spans] == [
            "Https://a.example/X", "12345678", "123-45-6789", "DE89 3704 0044 0532 0130 00"], text
        assert [k for k, _, _ in spans] == ["url", "account", "account", "iban"]


def test_pii_extra_kinds_and_redaction(spark):
    text = "see https://a.example/x?y=1, IBAN: DE89 3704 0044 0532 0130 00 and account no 12345678; é a@b.co"
    spans = pii.find(text, pii.automaton())
    assert [(k, text[a:b]) for k, a, b in spans] == [("url", "https://a.example/x?y=1"), ("iban", "DE89 3704 0044 0532 0130 00"),
                                                     ("account", "12345678"), ("email", "a@b.co")]
    df = docs(spark, text, None, "", "x" * 200_000 + " a@b.co").withColumn("pii_text", F.lit("clash"))
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[0].text == "see <URL>, IBAN: <IBAN> and account no <ACCOUNT>; é <EMAIL>" and out[0].n_chars == len(out[0].text)
    assert out[1].text is None and out[2].text == "" and out[3].text.endswith("x <EMAIL>") and out[0].pii_text == "clash"
    got = {r.doc_id: r for r in pii.pii_report(df).collect()}
    assert got[1].spans == "" and got[1].base_sha256 == sha("") and got[3].spans == "email:200001:200007"
    assert pii.pii_report(df.limit(0)).count() == 0


# 8, quality rules

def test_quality_counts(spark):
    text = "a b c d e f\n\nx y\na b c d e f\n \t\nx y\n#|<"
    df = docs(spark, text, None, "", "w " * 5, "a b c d e " * 4000).withColumn("w", F.lit(1)).withColumn("lines", F.lit(1))
    got = {r.doc_id: r for r in quality.measure(df).collect()}
    words = text.split()
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    r = got[0]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), 3, 2, len(covered))
    assert got[1].n_words == got[2].n_words == 0 and got[4].n_repeat_words == 20000 and got[3].n_repeat_words == 0
    assert quality.measure(df.limit(0)).count() == 0


def test_binomial_tail(spark):
    from math import comb
    cases = [(0, 100), (3, 1000), (10, 5000), (40, 100), (0, 0), (150, 60_000)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.003).alias("p"))
    for k, n, p in rows(df):
        want = 1.0 if k >= n * 0.003 else sum(float(comb(n, i)) * 0.003**i * 0.997 ** (n - i) for i in range(k + 1)) if n < 2000 else None
        assert want is None or abs(p - want) < 1e-9 * max(1, want)
        assert 0 < p <= 1


def test_certified_cutoffs_hold_their_risk(spark):
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(6000):
        bad = i % 5 == 0
        words = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        words += ["###"] * int(rng.integers(8, 20) if bad else 0)
        texts.append(" ".join(words))
        labels.append((i, 0 if bad else 1))
    df = docs(spark, *texts)
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (10**6, 0)], "doc_id long, quality int")
    verdict = {r.doc_id: r.kept for r in quality.judge(df, lab).collect()}
    good = [i for i, q in labels if q]
    assert sum(not verdict[i] for i in good) <= 0.02 * len(good)
    assert sum(not verdict[i] for i, q in labels if not q) > 0.9 * (6000 - len(good))
    assert all(r.kept != r.base_failed for r in quality.judge(df, lab.limit(0)).collect())
    assert quality.judge(df.limit(0), lab).count() == 0


# 9, URL filter

def test_urls_against_plain_rules(spark):
    hosts = ["example.org", "a.example.org", "b.org", "x.com", "com", "org", "EXAMPLE.org", "notexample.org", "spam-farm.example.net", "m.spam-farm.example.net", "h.net", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12#x", "/en/2?q=/de/", "/de/", "/fr/x", "?a=/fr/", "#/fr/"]
    data = [(i, u) for i, u in enumerate([f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "example.org/es/", "x://y://z/"])]
    pages = spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("key", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages).collect()}
    for i, u in data:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        listed = any(host == b or host.endswith("." + b) for b in urls.BLOCKED_HOSTS)
        assert got[i] == (host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "block" if listed else "allow"), u
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key like '%77%'").unionByName(spark.createDataFrame([("absent",), (None,)], "key string"))
    cascade = urls.Cascade.build(listed, universe)
    wrong = universe.where(cascade.member(F.col("key")) != F.col("key").like("%77%"))
    assert len(cascade.levels) >= 2 and wrong.count() == 0


# 10, mixing

def test_mix_targets_and_cuts(spark):
    data = [(i, "w " * n, "en", s, 0) for i, (n, s) in enumerate([(10, "a"), (30, "a"), (0, "a"), (500, "b"), (7, "c"), (100, None), (100, None), (5, "\U0001F642")] * 5)]
    data += [(100, None, "en", "z", 0), (None, "x y", "en", "a", 0), (3, "w " * 500, "en", "b", 0)]
    df = spark.createDataFrame(data, DOCS).withColumn("size", F.lit("clash")).withColumn("range", F.lit("clash"))
    out = mixing.mix(df).collect()
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r["size"]
        goal = by.setdefault(r.source, [r.target, r.source_size, 0])
        goal[2] += r.taken
    for target, size, taken in by.values():
        assert taken == int(target) <= 2 * size
    assert abs(sum(t for t, _, _ in by.values()) - 1.5 * total) < 1e-6
    free = {s: v for s, v in by.items() if v[0] < 2 * v[1]}
    order = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    assert len({round(v[0] / weight[s], 6) for s, v in free.items()}) <= 1
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(df.repartition(7)).collect()))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    words = mixed.groupBy("source").agg(F.sum(mixing.n_words(F.col("text")))).collect()
    assert {s: n for s, n in map(tuple, words)} == {s: v[2] for s, v in by.items() if v[2]}
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0
