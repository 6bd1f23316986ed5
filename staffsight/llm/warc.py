"""Operator 5, WARC records and a Merkle fixity audit of their replicas.

Pages become WARC records, records are laid out in archives in page order, and every replica's
archive gets a hash tree of its own: a leaf is the SHA-256 of the byte ranges and digests of the
records that start in one cell of CELL_BYTES, a node the SHA-256 of the hashes of up to FANOUT
consecutive children and of the byte range they span. As cells are fixed offset ranges, the trees of
two replicas need no common order. The archives' roots are the leaves of a second tree, whose root
stands for the whole collection. An audit takes two record tables with their own offsets
(``manifest``, or ``located`` of ``read_warc``), compares the roots and descends level by level,
reading only the children of nodes that differ; records are compared in the cells that differ and
nowhere else: damaged (another digest at the same range), missing or extra (a range that only one
replica has; a record moved to another place is missing there and extra here).

The query audits the manifest against a stored copy with damaged and lost records that keeps the
manifest's byte ranges, so a lost record does not shift those after it.

Defined results: null url and html are empty; a null page_id is in an archive of its own (-1);
equal records (same page and bytes) are one leaf with a number of copies; records of one
page with different bytes are ordered by digest; an empty table has no archive and no
damage; only page_id, url and html are read. Trees are built by aggregates of FANOUT children, and only
the number of levels reaches the driver.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, ship

ship(__name__)

#: Pages (by id) in an archive, and children of a tree node.
ARCHIVE_PAGES, FANOUT = 1000, 16
#: Bytes of an archive that one leaf stands for.
CELL_BYTES = 1 << 16
END = "\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a WARC record, with its closing line breaks."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.translate(F.coalesce(url, F.lit("")), "\r\n", "  "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body, F.lit(END))


def records(pages: DataFrame, html: Column | None = None) -> DataFrame:
    """page_id, archive, body (the record) for every page; ``html`` may replace the column."""
    pid = F.col("page_id").cast("long")
    return pages.select(pid.alias("page_id"), F.coalesce(F.floor(pid / ARCHIVE_PAGES), F.lit(-1)).cast("long").alias("archive"),
                        record(pid, F.col("url").cast("string"), F.col("html").cast("string") if html is None else html).alias("body"))


def manifest(hashed: DataFrame) -> DataFrame:
    """archive, idx, page_id, start, end, hash, copies and the other columns of ``hashed``.

    ``hashed`` has archive, page_id, hash, size; equal rows become one leaf.
    """
    leaves = hashed.groupBy(*hashed.columns).agg(F.count("*").alias("copies"))
    order = Window.partitionBy("archive").orderBy("page_id", "hash")
    end = F.sum(F.col("size") * F.col("copies")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (leaves.withColumn("idx", (F.row_number().over(order) - 1).cast("long")).withColumn("end", end)
            .withColumn("start", F.col("end") - F.col("size") * F.col("copies")))


def _parents(level: DataFrame) -> DataFrame:
    """One level up: (grp, idx, hash, start, end) from the children's."""
    kids = F.sort_array(F.collect_list(F.struct("idx", F.coalesce("hash", F.lit("-")).alias("hash"))))
    up = level.groupBy("grp", F.floor(F.col("idx") / FANOUT).alias("idx")).agg(
        F.array_join(F.transform(kids, lambda k: k["hash"]), "").alias("hash"),
        F.min("start").alias("start"), F.max("end").alias("end"))
    return up.withColumn("hash", _ranged("hash"))


def _ranged(digest: str) -> Column:
    """Hash of a digest (or of the children's hashes) and of the byte range start to end; null for null."""
    return F.sha2(F.concat(F.col(digest), F.lit(":"), *(
        x for c in ("start", "end") for x in (F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(":")))), 256)


def _heights(leaves: DataFrame) -> tuple[int, int]:
    """Levels above the leaves in an archive's tree and in the collection's."""
    most, last = leaves.agg(F.max("idx"), F.max("grp")).first()
    up = lambda n: math.ceil(math.log(n, FANOUT) - 1e-9) if n > 1 else 0
    return (0, 0) if most is None else (up(most + 1), up(last + 2))


def tree(leaves: DataFrame, heights: tuple[int, int], label: str) -> list[DataFrame]:
    """The levels, leaves (grp, idx, hash, start, end) first; grp is the archive.

    ``leaves`` has the records' digests as hash. In the collection's tree grp is -1 and idx is the archive + 1.
    """
    levels = [leaves.select("grp", "idx", _ranged("hash").alias("hash"), "start", "end")]
    for _ in range(heights[0]):
        levels.append(save(_parents(levels[-1]), f"merkle-{label}"))
    roots = levels[-1].select(F.lit(-1).cast("long").alias("grp"), (F.col("grp") + 1).alias("idx"), "hash", "start", "end")
    levels.append(roots)
    for _ in range(heights[1]):
        levels.append(save(_parents(levels[-1]), f"merkle-{label}"))
    return levels


def differing(left: list[DataFrame], right: list[DataFrame], heights: tuple[int, int], read: list[int] | None = None) -> DataFrame:
    """(grp, idx) of the leaves whose hashes differ, found by descending from the roots.

    ``read`` gets the number of nodes read on each level.
    """
    differ = None
    for depth in reversed(range(len(left))):
        a, b = left[depth].select("grp", "idx", F.col("hash").alias("ha")), right[depth].select("grp", "idx", F.col("hash").alias("hb"))
        if differ is not None:
            if depth == heights[0]:  # from the collection's leaves to the archives' roots
                parent = differ.select((F.col("idx") - 1).alias("grp"), F.lit(0).cast("long").alias("up"))
            else:
                parent = differ.select("grp", F.col("idx").alias("up"))
            below = lambda d: d.withColumn("up", F.floor(F.col("idx") / FANOUT) if depth != heights[0] else F.lit(0).cast("long")).join(
                parent, ["grp", "up"], "left_semi").drop("up")
            a, b = below(a), below(b)
        if read is not None:
            read.append(a.count() + b.count())
        both = a.join(b, ["grp", "idx"], "full").where(~F.col("ha").eqNullSafe(F.col("hb"))).select("grp", "idx")
        differ = save(both, "merkle-differ")
        if differ.isEmpty():
            break
    if depth:
        return left[0].select("grp", "idx").where(F.lit(False))
    return differ


def damaged_html() -> Column:
    """The query's second replica: some pages have a flipped first byte."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return F.when(F.pmod("page_id", F.lit(101)) == 7, F.concat(F.lit("~"), F.substr(html, F.lit(2), F.length(html)))).otherwise(html)


def lost() -> Column:
    """Pages whose record the query's second replica has lost."""
    return F.coalesce(F.pmod("page_id", F.lit(211)) == 5, F.lit(False))


def _located_cells(records: DataFrame) -> DataFrame:
    return records.withColumn("cell", F.floor(F.coalesce("start", F.lit(0)) / CELL_BYTES).cast("long"))


def cells(records: DataFrame) -> DataFrame:
    """grp, idx, hash, start, end: a replica's leaves, one for each cell in which a record starts."""
    line = F.concat_ws(":", F.col("start").cast("string"), F.col("end").cast("string"), "hash")
    return _located_cells(records).groupBy(F.col("archive").alias("grp"), F.col("cell").alias("idx")).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_set(line)), ","), 256).alias("hash"), F.min("start").alias("start"), F.max("end").alias("end"))


def audit(first: DataFrame, second: DataFrame, read: list[int] | None = None) -> DataFrame:
    """archive, start, end, first, second (digests), status of every record of two replicas.

    Both tables have archive, start, end, hash (a null hash is no record); status is intact, damaged,
    missing (not in ``second``) or extra (not in ``first``). Intact rows outside of differing cells are
    read from ``first`` alone. ``read`` gets the number of tree nodes read on each level.
    """
    given = [df.where("hash IS NOT NULL").select("archive", "start", "end", "hash") for df in (first, second)]
    leaves = [save(cells(df), "merkle-cells") for df in given]
    heights = tuple(max(h) for h in zip(*map(_heights, leaves)))
    trees = [tree(own, heights, name) for own, name in zip(leaves, ("first", "second"))]
    differ = differing(*trees, heights, read).select(F.col("grp").alias("archive"), F.col("idx").alias("cell"))
    open_, shut = ([_located_cells(df).join(differ, ["archive", "cell"], how) for df in given] for how in ("left_semi", "left_anti"))
    side = lambda df, name: df.groupBy("archive", "start", "end").agg(
        F.array_join(F.sort_array(F.collect_set("hash")), "").alias(name))
    both = side(open_[0], "first").join(side(open_[1], "second"), ["archive", "start", "end"], "full")
    status = (F.when(F.col("second").isNull(), "missing").when(F.col("first").isNull(), "extra")
              .when(F.col("first") == F.col("second"), "intact").otherwise("damaged"))
    same = side(shut[0], "first").withColumns({"second": F.col("first"), "status": F.lit("intact")})
    return both.withColumn("status", status).unionByName(same)


def fixity_report(pages: DataFrame) -> DataFrame:
    """The query: page_id, archive, position, copies, byte_start, byte_end, digest, status of every record."""
    copy = F.when(~lost(), F.sha2(record(F.col("page_id").cast("long"), F.col("url").cast("string"), damaged_html()), 256))
    hashed = pages.select(*(e.alias(c) for c, e in _leaf_columns().items()), copy.alias("copy_hash"))
    mine = save(manifest(hashed), "merkle-manifest")
    theirs = save(mine.select("archive", "start", "end", F.col("copy_hash").alias("hash")), "merkle-copy")
    found = audit(mine, theirs).select("archive", "start", "end", "status")
    return mine.join(found, ["archive", "start", "end"], "left").select(
        "page_id", "archive", F.col("idx").alias("position"), "copies", F.col("start").cast("long").alias("byte_start"),
        F.col("end").cast("long").alias("byte_end"), F.col("hash").alias("digest"), "status")


def _leaf_columns() -> dict[str, Column]:
    pid = F.col("page_id").cast("long")
    body = record(pid, F.col("url").cast("string"), F.col("html").cast("string"))
    return {"page_id": pid, "archive": F.coalesce(F.floor(pid / ARCHIVE_PAGES), F.lit(-1)).cast("long"),
            "hash": F.sha2(body, 256), "size": F.octet_length(body).cast("long")}


def write_warc(recs: DataFrame, path: str) -> None:
    """Write ``records`` as WARC files, one folder per archive, in page order."""
    rows = recs.select("archive", "page_id", F.expr(f"substr(body, 1, length(body) - {len(END)})").alias("value"))
    rows = rows.repartition("archive").sortWithinPartitions("archive", "page_id", "value").select("archive", "value")
    rows.write.partitionBy("archive").option("lineSep", END).text(path)


def _parse(batches):
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out, at = [], 0
            while at < len(data):
                head_end = data.index(b"\r\n\r\n", at) + 4
                head = dict(line.split(b": ", 1) for line in data[at:head_end - 4].split(b"\r\n")[1:])
                end = head_end + int(head[b"Content-Length"])
                out.append((path, at, end + 4 - at, head[b"WARC-Record-ID"].decode(), head[b"WARC-Target-URI"].decode(), data[head_end:end],
                            hashlib.sha256(data[at:end + 4]).hexdigest()))
                at = end + 4
            for k in range(0, len(out), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[k:k + 1000]), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()))],
                    names=["path", "offset", "size", "record_id", "uri", "payload", "digest"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """path, offset, size, record_id, uri, payload, digest (SHA-256 of the whole record) of every record below ``path``.

    A file is read by one task, as a WARC file is meant to be (about 1 GB at most).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return files.select("path", "content").mapInArrow(
        _parse, "path string, offset long, size long, record_id string, uri string, payload binary, digest string")


def located(read: DataFrame) -> DataFrame:
    """archive, start, end, hash of the records that ``read_warc`` returns from files of ``write_warc``."""
    return read.select(F.regexp_extract("path", r"/archive=(-?\d+)/", 1).cast("long").alias("archive"), F.col("offset").alias("start"),
                       (F.col("offset") + F.col("size")).alias("end"), F.col("digest").alias("hash"))


def _record_sql(html: str) -> str:
    return (f"concat('WARC/1.0', n, 'WARC-Type: resource', n, 'WARC-Record-ID: <urn:page:', coalesce(page_id::varchar, ''), '>', n, "
            f"'WARC-Target-URI: ', translate(coalesce(url, ''), n, '  '), n, 'Content-Type: text/html', n, 'Content-Length: ', "
            f"strlen({html})::varchar, n, n, {html}, n, n)")


ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, chr(13) || chr(10) AS n,
  CASE WHEN page_id % 101 = 7 THEN '~' || substr(coalesce(html, ''), 2) ELSE coalesce(html, '') END AS html2 FROM pages),
h AS (SELECT page_id, coalesce(floor(page_id / {ARCHIVE_PAGES})::bigint, -1) AS archive, sha256({_record_sql('html')}) AS digest,
  strlen({_record_sql('html')})::bigint AS size, CASE WHEN coalesce(page_id % 211 = 5, false) THEN NULL ELSE sha256({_record_sql('html2')}) END AS copy FROM p),
g AS (SELECT *, count(*) AS copies FROM h GROUP BY ALL)
SELECT page_id, archive, row_number() OVER w - 1 AS position, copies,
  (sum(size * copies) OVER w - size * copies)::bigint AS byte_start, (sum(size * copies) OVER w)::bigint AS byte_end, digest,
  CASE WHEN copy IS NULL THEN 'missing' WHEN copy <> digest THEN 'damaged' ELSE 'intact' END AS status
FROM g WINDOW w AS (PARTITION BY archive ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING)
"""
