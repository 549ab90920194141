r"""Chat formatting that is checked by parsing it back.

A conversation is rendered as one piece per turn:

    ### role: text</turn>

and a line feed. The grammar is deterministic: a piece ends at the first ``</turn>``; its head is ``### ``, the role up to the first colon that no backslash guards, a mode
sign and a space. Mode ``:`` holds role and text as they are; mode ``:\`` holds them escaped: ``\`` before
each ``\``, ``:``, ``#`` and the ``/`` of ``</turn>``.

Every turn is rendered as it is, parsed and compared with its source; only where the result differs, it is
escaped, parsed and compared again. As a piece that parses to exactly one turn holds its end only
at its end, a conversation of such pieces parses to exactly its turns. All of it happens in a row before
any shuffle, in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeward.llm.text import fresh

END = "</turn>"
_TAIL = END + "\n"
LEARNED = "assistant"

_HEAD = r"(?s)^\n?### ((?:[^:\\]++|\\.)*+):(\\?) (.*)$"


def escape(text: Column) -> Column:
    guarded = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for found in (":", "#"):
        guarded = F.replace(guarded, F.lit(found), F.lit("\\" + found))
    return F.replace(guarded, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _piece(role: Column, text: Column, mode: str) -> Column:
    return F.concat(F.lit("### "), role, F.lit(mode + " "), text, F.lit(_TAIL))


def plain_piece(role: Column, text: Column) -> Column:
    return _piece(role, text, ":")


def escaped_piece(role: Column, text: Column) -> Column:
    return _piece(escape(role), escape(text), ":\\")


def parse(rendered: Column) -> Column:
    """The turns of a rendered text: an array of role and text, null where a piece breaks the
    grammar. What follows the last end is a line feed in a sound text and left out."""
    pieces = F.split(rendered, END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), _turn)


def _turn(piece: Column) -> Column:
    good = piece.rlike(_HEAD)
    guarded = F.regexp_extract(piece, _HEAD, 2) != ""
    role, text = (F.regexp_extract(piece, _HEAD, k) for k in (1, 3))
    return F.struct(
        F.when(good, F.when(guarded, unescape(role)).otherwise(role)).alias("role"),
        F.when(good, F.when(guarded, unescape(text)).otherwise(text)).alias("text"),
    )


def _returns(piece: Column, role: Column, text: Column) -> Column:
    """True if a piece parses to exactly this turn: one end, at the end, and equal parts."""
    one = F.locate(END, piece) == F.length(piece) - len(_TAIL) + 1
    back = _turn(F.left(piece, F.length(piece) - len(_TAIL)))
    return one & back["role"].eqNullSafe(role) & back["text"].eqNullSafe(text)


def rendered_turns(turns: DataFrame) -> DataFrame:
    """Adds ``piece`` and ``escaped`` (whether it had to be) to ``conv_id, turn, role, text``.

    Null roles and texts count as empty. Fails if a piece does not come back even when escaped.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    role, text = F.col("role"), F.col("text")
    rows = rows.withColumn("plain", plain_piece(role, text))
    rows = rows.withColumn("escaped", ~_returns(F.col("plain"), role, text))
    rows = rows.withColumn("piece", F.when(F.col("escaped"), escaped_piece(role, text)).otherwise(F.col("plain")))
    failed = F.raise_error(F.concat(F.lit("no round trip for turn "), F.coalesce(F.col("turn").cast("string"), F.lit("null"))))
    sound = ~F.col("escaped") | _returns(F.col("piece"), role, text)
    return rows.withColumn("piece", F.when(sound, F.col("piece")).otherwise(failed.cast("string"))).drop("plain")


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``; the spans (start, end, in code
    points of ``formatted``, end exclusive) cover the texts of assistant turns as rendered.

    ``turns`` has ``conv_id, turn, role, text``; other columns are left out. Turns come in the order
    of ``turn``; ties in that of role and text, repeated rows once each. Nulls of ``turn`` come
    first; a null ``conv_id`` is one conversation. No rows give no rows.
    """
    rows = rendered_turns(turns).withColumn("size", F.length("piece").cast("bigint"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    behind = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    role = F.when(F.col("escaped"), F.length(escape(F.col("role"))) + 1).otherwise(F.length("role"))
    rows = rows.withColumn("at", behind).withColumn("start", F.col("at") + len("### ") + role + len(": "))
    item = F.struct(
        "at",
        F.col("piece"),
        F.when(F.col("role") == LEARNED, F.struct("start", (F.col("at") + F.col("size") - len(_TAIL)).alias("end"))).alias("span"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("items", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("items", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a parser recovers from ``conv_id, formatted``.

    ``n_turns``, ``turns_sha256`` over role and text with a line feed after each, ``loss_chars`` and ``loss_sha256``
    over the assistant's texts, and ``formatted_chars``.
    """
    turns = fresh(formatted, "turns")
    cut = formatted.withColumn(turns, parse(F.col("formatted")))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = fresh(formatted, "loss")
    cut = cut.withColumn(
        loss, F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == LEARNED), lambda t: t["text"]), "")
    )
    return cut.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(F.col(loss), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
