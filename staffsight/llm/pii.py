"""Operator 7, personal data, by anchor expansion.

An Aho-Corasick automaton runs over a text once and finds anchors: at-signs, plus signs,
digits, schemes and identifier cues (schemes and cues in any case). At an anchor a deterministic local parser expands the
span to both sides and validates it; nothing else of the text is looked at.

Kinds and their parsers (spans in code points, end exclusive):

* email  at ``@``: local part to the left up to the previous email, dotted labels to the right
* ip     at a digit: a chain of digit runs joined by single dots, cut in fours, parts <= 255
* card   at a digit: the longest run of digits with single spaces or hyphens between, 12 to 19
         digits passing Luhn
* phone  at ``+`` before a digit: digits and ``space ( ) . -`` up to the last digit, 9 to 15 digits
* url    at a scheme: up to white space or a quoting character, trailing punctuation dropped
* iban   at a cue (``IBAN``): two letters, two digits and 11 to 30 more, passing modulo 97
* account at a cue (``account``, ``acct``, ``SSN``, ...): the identifier that follows the cue

A match that fails its validation is dropped and the search goes on after it. Kinds do not
exclude one another; ``redact`` joins overlapping spans and keeps the first kind's name.

Defined results: null and empty texts have no spans; repeated rows are judged each; only
doc_id and text are read, so other columns cannot clash; an empty table gives no rows. The
work is local to a row: no shuffle, and memory is bounded by one batch of rows.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, ship

ship(__name__)

#: Kinds in the order in which spans with one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE = KINDS[:4]

#: Anchors by what they start, in lower case (they are found in any case).
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account no", "account number", "acct", "ssn", "passport no", "tax id")
_LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_PHONE = frozenset(" ().-0123456789")
_URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


def _run(text: str, i: int, allowed: frozenset, end: int) -> int:
    """End of the run of allowed characters from ``i`` on."""
    while i < end and text[i] in allowed:
        i += 1
    return i


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The email around the at-sign, not reaching back before ``floor``."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    n = len(text)
    end = _run(text, at + 1, _LABEL, n)
    if end == at + 1:
        return None
    first = end
    while end < n and text[end] == ".":
        nxt = _run(text, end + 1, _LABEL, n)
        if nxt == end + 1:
            break
        end = nxt
    return (start, end) if end > first else None


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _dotted(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """The ip spans of the chain of dotted digit runs at ``start``, and the chain's end."""
    n, runs, i = len(text), [], start
    while True:
        end = _run(text, i, _DIGITS, n)
        runs.append((i, end))
        if end + 1 < n and text[end] == "." and text[end + 1] in _DIGITS:
            i = end + 1
        else:
            break
    out = []
    for g in range(0, len(runs) - 3, 4):
        four = runs[g:g + 4]
        if all(_byte(text[a:b]) for a, b in four):
            out.append((four[0][0], four[3][1]))
    return out, runs[-1][1]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _card_chain(text: str, start: int) -> int:
    """End of the digits with single spaces or hyphens between them."""
    n, end = len(text), start + 1
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    return end


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    """The span from ``+`` to the last digit of the run, if it has three characters or more."""
    n = len(text)
    if plus + 1 >= n or text[plus + 1] not in _DIGITS:
        return None
    end = _run(text, plus + 2, _PHONE, n)
    while end > plus + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 else None


def _digits(text: str, start: int, end: int) -> str:
    return "".join(c for c in text[start:end] if c in _DIGITS)


def _url(text: str, start: int, after: int) -> tuple[int, int] | None:
    n, end = len(text), after
    while end < n and text[end] not in _URL_END:
        end += 1
    while end > after and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return (start, end) if end > after else None


def _skip_cue(text: str, i: int) -> int:
    """Past the separators that may stand between a cue and its identifier."""
    return _run(text, i, frozenset(" \t.:#="), min(len(text), i + 8))


def _iban(text: str, after: int) -> tuple[int, int] | None:
    i = _skip_cue(text, after)
    end, code = i, ""
    while end < len(text) and len(code) < 34 and (text[end] in _ALNUM or text[end] == " " and end + 1 < len(text) and text[end + 1] in _ALNUM):
        code += text[end].strip()
        end += 1
    # groups that follow may be ordinary words: give them back until the checksum holds
    while len(code) >= 15:
        if code[:2].isalpha() and code[:2].isupper() and code[2:4].isdigit():
            value = int("".join(str(int(c, 36)) for c in code[4:] + code[:4]))
            if value % 97 == 1:
                return i, end
        cut = text.rfind(" ", i, end)
        if cut < 0:
            return None
        end, code = cut, "".join(text[i:cut].split())
    return None


def _account(text: str, after: int) -> tuple[int, int] | None:
    i = _skip_cue(text, after)
    end = _run(text, i, _DIGITS | {"-"}, len(text))
    while end > i and text[end - 1] == "-":
        end -= 1
    return (i, end) if 6 <= len(_digits(text, i, end)) <= 20 else None


def automaton() -> ahocorasick.Automaton:
    """Anchors -> (what they start, length)."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for d in "0123456789":
        a.add_word(d, ("d", 1))
    for kind, cues in (("s", SCHEMES), ("i", IBAN_CUES), ("a", ACCOUNT_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a text, by start and kind.

    Anchors are looked up in a lower-cased copy whose positions are the text's own (the one
    letter that lower-cases to two code points takes the slower way); spans come from the text."""
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(_LOWER)
    out = []
    email_end = dotted_end = card_end = phone_end = url_end = 0
    for last, (what, size) in anchors.iter(low):
        if what == "d":
            if last >= dotted_end:
                spans, dotted_end = _dotted(text, last)
                out += [("ip", a, b) for a, b in spans]
            if last >= card_end:
                card_end = _card_chain(text, last)
                digits = _digits(text, last, card_end)
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", last, card_end))
        elif what == "@":
            span = _email(text, last, email_end)
            if span:
                out.append(("email", *span))
                email_end = span[1]
        elif what == "+":
            span = _phone(text, last) if last >= phone_end else None
            if span:
                phone_end = span[1]
                if 9 <= len(_digits(text, *span)) <= 15:
                    out.append(("phone", *span))
        elif what == "s":
            if last + 1 - size >= url_end and (span := _url(text, last + 1 - size, last + 1)):
                out.append(("url", *span))
                url_end = span[1]
        else:
            span = _iban(text, last + 1) if what == "i" else _account(text, last + 1)
            if span:
                out.append(("iban" if what == "i" else "account", *span))
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0])))


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans without overlaps; overlapping ones are joined under the first one's kind."""
    out: list[tuple[str, int, int]] = []
    for kind, a, b in spans:
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((kind, a, b))
    return out


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind's name in angle brackets."""
    out, at = [], 0
    for kind, a, b in merged(spans):
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _finder(batches):
    anchors = automaton()
    for batch in batches:
        spans = [find(t, anchors) if t else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], pa.list_(_SPAN))], names=["doc_id", "spans"])


def find_pii(documents: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end) for every document."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_finder, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def _redactor(batches):
    anchors = automaton()
    for batch in batches:
        at = batch.schema.get_field_index("pii_text")
        texts = [redacted(t, find(t, anchors)) if t else t for t in batch.column(at).to_pylist()]
        yield batch.set_column(at, "pii_text", pa.array(texts, pa.string()))


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with the personal data in ``text`` replaced; ``n_chars`` follows the text."""
    rest = [c for c in documents.columns if c != "text"]
    rows = documents.select(F.struct(*map(named, rest)).alias("pii_rest"), F.col("text").cast("string").alias("pii_text"))
    out = rows.mapInArrow(_redactor, rows.schema)
    own = {"text": F.col("pii_text")}
    if "n_chars" in rest:
        own["n_chars"] = F.length("pii_text").cast(documents.schema["n_chars"].dataType)
    return out.select(*(own.get(c, F.col("pii_rest")[c]).alias(c) for c in documents.columns))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def pii_report(documents: DataFrame) -> DataFrame:
    """The columns of the query."""
    found = find_pii(documents)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *(_count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
