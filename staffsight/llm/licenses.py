"""Operator 1, licence scan, by canonical digest lookup.

A text is brought to a canonical form: copyright lines are dropped, A-Z lower-cased,
equivalent spellings replaced, everything but letters and digits turned into single
spaces. The SHA-256 of the canonical form is looked up among the digests of known licence
texts. Two kinds of units are looked up whole: a document's entire text (a licence file)
and each of its lines (a licence statement that stands on a line of its own).

The known texts are the fixed table below (or the caller's), so the digest side of the join
is bounded by the program text and broadcast; documents are never shuffled.

Defined results: null and empty texts match nothing; a line that occurs twice is
reported twice (by line number); a document of one line that is a licence is reported both
as text and as line; repeated documents are reported each; only ``doc_id`` and ``text`` are
read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Licence id and statement or text.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice and "
            "this permission notice appear in all copies.\n\n"
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
            "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
            "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
            "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a "
            "copy of this software and associated documentation files (the \"Software\"), to deal in "
            "the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:\n\nThe above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS "
            "IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
            "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
            "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)

#: Pattern of a spelling after lower-casing, and the one it is read as.
SPELLINGS = (
    (r"\blicenc", "licens"),
    (r"\bsub-licens", "sublicens"),
    (r"\bnon-infring", "noninfring"),
    (r"\bnon-commercial", "noncommercial"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bmerchantibility\b", "merchantability"),
    (r"\bv(ersion)?\.? ?([0-9])", r"version \2"),
)

#: Letters that every known text has, whatever its spelling. Canonical forms keep
#: letters together that stand together, and no spelling rule makes these up, so a text
#: without any of them matches nothing and needs no canonical form.
ANCHORS = ("licen", "permission")

#: A line that is only a copyright notice: it names a year or a (c) mark.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*([0-9]{4}|\(c\)|©)[^\n]*$"


def canonical(text: Column) -> Column:
    text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.regexp_replace(text, COPYRIGHT_LINE, "")
    for old, new in SPELLINGS:
        text = F.regexp_replace(text, old, new.replace("\\2", "$2"))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def canonical_sql(text: str) -> str:
    """The same canonical form as DuckDB SQL."""
    text = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for old, new in ((COPYRIGHT_LINE, ""), *SPELLINGS):
        text = f"regexp_replace({text}, '{old}', '{new}', 'g')"
    return f"trim(regexp_replace({text}, '[^a-z0-9]+', ' ', 'g'))"


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license) of the known texts; as many rows at most as ``known`` has."""
    return (spark.createDataFrame(list(known), "license string, body string")
            .select(F.sha2(canonical(F.col("body")), 256).alias("digest"), "license").distinct())


def _has_anchor(text: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(text), F.lit(a)) for a in ANCHORS))


def scan_licenses(documents: DataFrame, known=KNOWN) -> DataFrame:
    """doc_id, unit ('text' or 'line'), line_no (0 for the text), license, digest."""
    anchored = all(any(a in body.lower() for a in ANCHORS) for _, body in known)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    rows = rows.where(_has_anchor(F.col("text"))) if anchored else rows
    units = rows.select("doc_id", F.posexplode(F.concat(F.array("text"), F.split("text", "\n"))).alias("line_no", "body"))
    units = units.where(_has_anchor(F.col("body"))) if anchored else units
    looked = units.select(
        "doc_id", F.when(F.col("line_no") == 0, "text").otherwise("line").alias("unit"),
        F.col("line_no").cast("long").alias("line_no"), F.sha2(canonical(F.col("body")), 256).alias("digest"))
    return looked.join(F.broadcast(known_digests(documents.sparkSession, known)), "digest").select(
        "doc_id", "unit", "line_no", "license", "digest")


ORACLE = f"""
WITH known AS (
  SELECT DISTINCT sha256({canonical_sql('body')}) AS digest, license
  FROM (VALUES {', '.join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in KNOWN)}) AS k(license, body)),
units AS (
  SELECT doc_id, 'text' AS unit, 0 AS line_no, coalesce(text, '') AS body FROM documents
  UNION ALL
  SELECT doc_id, 'line', unnest(range(1, len(lines) + 1)), unnest(lines)
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
SELECT doc_id, unit, line_no, license, digest
FROM (SELECT *, sha256({canonical_sql('body')}) AS digest FROM units) JOIN known USING (digest)
"""
