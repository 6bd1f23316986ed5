"""Operator 11, spelling variants by PartEnum signatures over letter multisets.

Words. Runs of Latin letters are counted in each task and then over all tasks. A word's letters
are a binary vector with one dimension for each letter and occurrence (the second ``e`` is a
dimension of its own). One inserted or deleted letter changes one dimension, one replaced letter
two, so near words are at a Hamming distance of at most two.

PartEnum. The dimensions are dealt into parts, and a word's signatures are its vector without
every choice of as many parts as dimensions may differ: two of ``PARTS_REPLACE`` between words of
one length, one of ``PARTS_INDEL`` between neighbouring lengths (the length is part of the
signature). What differs lies in the parts left out of at least one choice, so near words share a
signature, exactly. Rows are joined on equal signatures by sorting them into buckets; the words of
a bucket are compared letter by letter in the task that holds it and only near pairs leave it. A
bucket of more than BLOCK words is dealt into pairs of blocks, each a task's work.

Forms. A word's form is its most frequent near word if that has at least twice the count; as
counts rise along forms, chains end, and roots come from pointer jumping (a join a round, as many
as the logarithm of the longest chain).

Defined results: null texts have no words; an empty table gives no rows; repeated rows count
each; a null doc_id prints as nothing in the key of the deletions; words are compared whole,
whatever their length; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, save, ship
from .shingles import mix64

ship(__name__)

PARTS_REPLACE, PARTS_INDEL = 7, 4
#: Words of a bucket that are compared in one task, words counted before a task passes them on, rows gathered before they are compared.
BLOCK, KEPT_WORDS, GATHER = 16_384, 400_000, 1 << 17
#: Buckets up to this size are compared together; pairs in an array of a larger one.
FEW, PAIRS = 32, 1 << 18
#: Words up to this length are compared in columns of eight letters, longer ones by themselves.
PACKED = 64
MIN_LETTERS, MIN_COUNT, RATIO, DELETED = 5, 3, 2, 97

#: Latin-1 letters, A-Z lower-cased; all else separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _counted(batches):
    """word, n: the runs of a task's texts, with the planted deletions."""
    total: Counter = Counter()

    def passed_on():
        # a run all of whose occurrences lost a letter is left with none
        words = [w for w, n in total.items() if n]
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in part]), pa.array([total[w] for w in part], pa.int64())], names=["word", "n"])
        total.clear()

    crc = zlib.crc32
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            runs = text.encode("latin-1", "replace").translate(_LETTERS).split()
            total.update(runs)
            key = crc(f"{'' if doc_id is None else doc_id}:".encode())
            for run in [r for r in set(runs) if not crc(_utf8(r), key) % DELETED]:
                n, at = runs.count(run), crc(_utf8(run), key) % len(run)
                total[run] -= n
                if len(run) > 1:
                    total[run[:at] + run[at + 1:]] += n
            if len(total) > KEPT_WORDS:
                yield from passed_on()
    yield from passed_on()


def word_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of the words that are long and frequent enough, over all texts."""
    rows = documents.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.char_length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT))


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' letters as Latin-1 bytes laid end to end, and each word's offset in them."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    lead = data >= 0xC0
    if lead.any():  # letters from U+0080 on have two bytes of UTF-8
        before = np.concatenate((data[:1], data[:-1]))
        data = np.where(data & 0xC0 == 0x80, (before & 3) << 6 | data & 0x3F, data)[~lead]
        offsets = offsets - np.concatenate(([0], np.cumsum(lead)))[offsets]
    return data, offsets


def signatures_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and the number of the word that each belongs to; the lowest bit is 1 for neighbouring lengths."""
    length = np.diff(offsets)
    words = len(length)
    owner, letter = np.repeat(np.arange(words), length), data.astype(np.int64)
    order = np.lexsort((letter, owner))
    owner, letter = owner[order], letter[order]
    first = np.ones(len(letter), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1])
    at = np.arange(len(letter))
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    dimension = mix64((letter << 32 | nth).astype(np.uint64) + np.uint64(1))
    size = length.astype(np.uint64)
    out = []
    # kind, parts, parts left out, and the longer of the two lengths that may meet
    for kind, parts, drop, longer in ((0, PARTS_REPLACE, 2, size), (1, PARTS_INDEL, 1, size), (1, PARTS_INDEL, 1, size + np.uint64(1))):
        sums = np.zeros((words, parts), np.uint64)
        part = ((dimension >> np.uint64(40 if kind else 20)) % np.uint64(parts)).astype(np.int64)
        np.add.at(sums, (owner, part), dimension)
        total = sums.sum(1, dtype=np.uint64)
        for choice, left_out in enumerate(combinations(range(parts), drop)):
            seed = mix64(longer * np.uint64(128) + np.uint64(2 * choice + kind))
            rest = total - sums[:, list(left_out)].sum(1, dtype=np.uint64)
            out.append(mix64(rest ^ seed) & ~np.uint64(1) | np.uint64(kind))
    return np.concatenate(out).view(np.int64), np.tile(np.arange(words), len(out))


def _signed(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            sig, which = signatures_of(*letters(part.column(0)))
            which = pa.array(which)
            yield pa.RecordBatch.from_arrays([pa.array(sig), part.column(0).take(which), part.column(1).take(which)], names=["sig", "word", "n"])


def near(a: bytes, b: bytes) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced letter?"""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)):] == b[at + (len(b) >= len(a)):]


def _packed(data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' letters from the front and from the back, eight in a column; longer words than PACKED are left zero."""
    short = np.where(length <= PACKED, length, 0)
    data = data[np.repeat(length <= PACKED, length)]
    wide = 8 * max(1, -(-int(short.max(initial=1)) // 8))
    forth, back = np.zeros((2, len(length), wide), np.uint8)
    taken = np.arange(wide) < short[:, None]
    forth[taken] = data
    # read backwards, the words are reversed, and so is their order
    back[::-1][taken[::-1]] = data[::-1]
    return forth.view("<u8").T.copy(), back.view("<u8").T.copy()


def _alike(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal letters before the first that differs."""
    out, going = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for column in x:
        differ = column[i] ^ column[j]
        lowest = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        out += np.where(going, np.where(differ == 0, 8, lowest), 0)
        going &= differ == 0
    return out


def _one_replaced(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that differ in exactly one letter."""
    found = np.zeros(len(i), np.uint8)
    for column in x:
        d = column[i] ^ column[j]
        for s in (4, 2, 1):
            d |= d >> np.uint64(s)
        found += np.bitwise_count(d & np.uint64(0x0101010101010101))
        few = found <= 1
        i, j, found = i[few], j[few], found[few]
    return i[found == 1], j[found == 1]


def _meeting(bucket: np.ndarray):
    """Pairs of rows of one bucket (rows are sorted by bucket), in arrays of bounded size."""
    size = np.bincount(bucket)
    start = np.cumsum(size) - size
    for k in np.flatnonzero(size > FEW):  # a bucket of many rows by itself, some rows against all after them
        for at in range(start[k], start[k] + size[k], max(1, PAIRS // size[k])):
            some = np.arange(at, min(at + max(1, PAIRS // size[k]), start[k] + size[k]))
            i, j = np.repeat(some, start[k] + size[k] - at), np.tile(np.arange(at, start[k] + size[k]), len(some))
            yield i[i < j], j[i < j]
    at = np.flatnonzero(size[bucket] <= FEW)
    for step in range(1, FEW):  # small buckets together, rows that are ``step`` apart
        at = at[at + step < len(bucket)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            return
        yield at, at + step


def bucket_pairs(sig: np.ndarray, group: np.ndarray, side: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (i, j) of rows that are sorted by group; sides 0 and 1 meet each other only."""
    length = np.diff(offsets)
    forth, back = _packed(data, length)
    bucket = np.zeros(len(sig), np.int64)
    bucket[1:] = np.cumsum(group[1:] != group[:-1])
    indel, split = sig & 1 == 1, (side != 2).any()
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i, j in _meeting(bucket):
        if split:
            meet = (side[i] == 2) | (side[i] != side[j])
            i, j = i[meet], j[meet]
        apart = np.abs(length[i] - length[j])
        for kind in (0, 1):
            meet = (apart == kind) & (indel[i] == kind)
            a, b = i[meet], j[meet]
            long = np.maximum(length[a], length[b]) > PACKED
            if long.any():
                word = [bytes(data[offsets[k]:offsets[k + 1]]) for x in (a[long], b[long]) for k in x]
                half = len(word) // 2
                ok = np.array([near(x, y) for x, y in zip(word[:half], word[half:])], bool)
                out.append((a[long][ok], b[long][ok]))
                a, b = a[~long], b[~long]
            if kind:
                least = np.minimum(length[a], length[b])
                ok = np.minimum(_alike(forth, a, b), least) + np.minimum(_alike(back, a, b), least) >= least
                out.append((a[ok], b[ok]))
            else:
                out.append(_one_replaced(forth, a, b))
    return tuple(np.concatenate(x) for x in zip(*out))


def _near_in_buckets(batches):
    """word, near, near_n (both ways) from rows (sig, i, j, side, word, n) sorted by sig, i, j."""
    def pairs(table: pa.Table):
        sig, i, j, side = (table.column(c).to_numpy() for c in range(4))
        group = mix64(mix64(sig.view(np.uint64)) + (i.astype(np.uint64) << np.uint64(32) | j.astype(np.uint64)))
        word, n = (table.column(c).combine_chunks() for c in (4, 5))
        a, b = bucket_pairs(sig, group, side, *letters(word))
        for at in range(0, len(a), 25_000):
            x, y = (pa.array(np.concatenate((p[at:at + 25_000], q[at:at + 25_000]))) for p, q in ((a, b), (b, a)))
            yield pa.RecordBatch.from_arrays([word.take(x), word.take(y), n.take(y)], names=["word", "near", "near_n"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHER:
            table = pa.Table.from_batches(held).combine_chunks()
            last = np.array([table.column(c).to_numpy() for c in range(3)])
            # the last bucket may go on in the next batch
            cut = int(np.flatnonzero((last != last[:, -1:]).any(0)).max(initial=-1)) + 1
            if cut:
                yield from pairs(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), len(table) - cut
    if rows:
        yield from pairs(pa.Table.from_batches(held).combine_chunks())


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """word, near, near_n: all pairs of near words of ``vocabulary`` (word, n), both ways."""
    rows = vocabulary.select("word", "n").mapInArrow(_signed, "sig long, word string, n long")
    large = save(rows.groupBy("sig").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK), "spelling-large")
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / BLOCK).cast("int")
    dealt = rows.join(large.withColumnRenamed("sig", "large_sig"), F.col("sig") == F.col("large_sig"), "left").withColumn("blocks", blocks)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    dealt = dealt.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "word", "n")
    dealt = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return dealt.mapInArrow(_near_in_buckets, "word string, near string, near_n long").dropDuplicates(["word", "near"])


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for every row of ``forms`` (word, form), following forms to the last."""
    now = save(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        longer = now.join(step, F.col("root") == F.col("via"), "left")
        longer = save(longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        forget(now)
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        now = longer


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents."""
    vocabulary = save(word_counts(documents), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = near_pairs(vocabulary).groupBy(F.col("word").alias("w")).agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = vocabulary.join(found, F.col("word") == F.col("w"), "left")
    takes = -F.col("best.less") >= RATIO * F.col("n")
    rows = save(rows.select("word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(takes, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.where("form IS NOT NULL")).withColumnRenamed("word", "w")
    return rows.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_CRC_STEP = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"


def _crc_sql(text: str) -> str:
    """CRC-32 of text whose characters are below U+0100, byte by byte."""
    byte = "CASE WHEN unicode(c) < 128 THEN [unicode(c)::bigint] ELSE [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] END"
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: {_CRC_STEP})[1]"
    bits = f"list_reduce(flatten(list_transform(string_split({text}, ''), lambda c: {byte})), lambda c, b: {step}, 4294967295::bigint)"
    return f"xor({bits}, 4294967295::bigint)"


ORACLE = rf"""
WITH RECURSIVE run AS MATERIALIZED (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY 1, 2),
hashed AS MATERIALIZED (SELECT r, n, {_crc_sql("coalesce(doc_id::varchar, '') || ':' || r")} AS h FROM run),
word AS MATERIALIZED (SELECT word, sum(n)::bigint AS n FROM (SELECT n, CASE WHEN h % {DELETED} = 0
    THEN substring(r, 1, (h % length(r))::int) || substring(r, (h % length(r))::int + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
gap AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest, length(word) AS l
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gap a JOIN gap b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gap a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gap a JOIN word b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
form AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0)::bigint AS n_near, CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near_n END AS form_n FROM word w LEFT JOIN best b ON b.word = w.word),
way AS (SELECT word, word AS root, form AS next FROM form UNION ALL SELECT y.word, f.word, f.form FROM way y JOIN form f ON f.word = y.next)
SELECT f.word, f.form, y.root, f.n, f.n_near, f.form_n FROM form f JOIN way y ON y.word = f.word AND y.next IS NULL
"""
