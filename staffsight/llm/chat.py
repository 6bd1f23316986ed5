"""Operator 2, chat formatting, by grammar round trip.

Grammar of a rendered conversation (the control strings are ``### `` and ``</turn>``)::

    conversation := turn*
    turn         := "### " role ":" newline body "</turn>" newline

``body`` and ``role`` hold no control string, and a role holds no line break. A backslash
starts a two-character code: ``\\b`` a backslash, ``\\/`` a slash, ``\\#`` a number sign,
``\\n`` a line break. Each turn is first rendered as it stands and reparsed; where the
recovered turn differs from the source (its text holds a control string, a backslash, ...)
its content is escaped. The whole conversation is then reparsed, and the query fails
rather than return text that does not give the source turns back.

Defined results: null text and null role are empty; turns are ordered by turn, then role,
then text (null turns first); rows whose conversation id is null form one conversation;
an empty table gives no rows; repeated rows are repeated turns. Only SQL functions are
used, and one shuffle by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

OPEN, CLOSE = "### ", "</turn>"
END = CLOSE + "\n"
ASSISTANT = "assistant"

_CODES = (("\\", "\\b"), (CLOSE, "<\\/turn>"), (OPEN, "#\\## "))
_DECODE = (("\\/", "/"), ("\\#", "#"), ("\\n", "\n"), ("\\b", "\\"))


def escape(text: Column) -> Column:
    """``text`` without control strings; ``unescape`` gives the text back."""
    for old, new in _CODES:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    # every backslash of an escaped text starts a code, so the codes can be undone one
    # after the other as long as the backslash's own code comes last
    for old, new in _DECODE:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _piece(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(":\n"), body)


def _header(piece: Column) -> Column:
    return F.substring_index(piece, "\n", 1)


def _parse_piece(piece: Column) -> Column:
    """(role, text) of one turn without its end mark, or null where the grammar has none."""
    head = _header(piece)
    parts = F.struct(F.substr(head, F.lit(len(OPEN) + 1), F.length(head) - (len(OPEN) + 1)).alias("role"),
                     F.substr(piece, F.length(head) + 2, F.length(piece)).alias("body"))
    fits = (piece.startswith(OPEN) & head.endswith(":") & (F.length(head) > len(OPEN)) & F.contains(piece, F.lit("\n")))
    return let(F.when(fits, parts), lambda p: F.when(
        ~F.contains(p["role"], F.lit(OPEN)) & ~F.contains(p["body"], F.lit(OPEN)) & ~F.contains(p["body"], F.lit(CLOSE))
        & ~F.contains(p["role"], F.lit(CLOSE)),
        F.struct(unescape(p["role"]).alias("role"), unescape(p["body"]).alias("text"))))


def pieces(formatted: Column) -> Column:
    """The turns of a rendered conversation as they stand, without their end marks."""
    return let(F.split(formatted, END, -1), lambda p: F.slice(p, F.lit(1), F.size(p) - 1))


def parse(formatted: Column) -> Column:
    """Deterministic parser: array of (role, text), with null for a turn that is none."""
    return F.transform(pieces(formatted), _parse_piece)


def _render(turn: Column) -> Column:
    """One turn; escaped only if the plain rendering does not parse back to it."""
    plain = _piece(turn["role"], turn["text"])
    return F.when(_parse_piece(plain).eqNullSafe(F.struct(turn["role"].alias("role"), turn["text"].alias("text"))), plain).otherwise(
        _piece(escape_role(turn["role"]), escape(turn["text"])))


def format_chat(conversations: DataFrame, assistant: str = ASSISTANT) -> DataFrame:
    """conv_id, formatted, loss_mask for a table (conv_id, turn, role, text).

    ``loss_mask`` lists the assistant texts as (segment, start, length): the segment's
    index among ``pieces(formatted)``, and the span in it in code points from 1.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = (conversations
             .select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    out = turns.withColumn(
        "formatted", F.array_join(F.transform("turns", lambda t: F.concat(_render(t), F.lit(END))), ""))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    out = out.withColumn("formatted", F.when(parse(F.col("formatted")) == source, F.col("formatted"))
                         .otherwise(F.raise_error(F.lit("chat text does not parse back to its turns"))))
    spans = F.transform(pieces(F.col("formatted")), lambda p, i: F.when(
        _parse_piece(p)["role"] == assistant, F.struct(
            i.alias("segment"), (F.length(_header(p)) + 2).alias("start"), (F.length(p) - F.length(_header(p)) - 1).alias("length"))))
    mask = F.array_compact(spans)
    return out.select("conv_id", "formatted", mask.alias("loss_mask"))


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """The text under the loss mask, unescaped, in order."""
    return let(pieces(formatted), lambda parts: F.array_join(F.transform(loss_mask, lambda m: unescape(
        F.substr(F.get(parts, m["segment"]), m["start"], m["length"]))), ""))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of the query, read back from the formatted text."""
    read = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "loss", masked_text(F.col("formatted"), F.col("loss_mask")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
