"""Row-local expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.names import CARD, CLIENT_ADDRESS, CLIENT_ANCHOR, DAY_SECONDS, TIME


def day_of(time: str = TIME) -> Column:
    """Whole days on an integer second axis."""
    return F.expr(f"cast(`{time}` as bigint) div {DAY_SECONDS}L")


def client_key(
    card: str = CARD, address: str = CLIENT_ADDRESS, anchor: str = CLIENT_ANCHOR, time: str = TIME
) -> Column:
    """``card_address_startday``, or NULL when any part is missing."""
    parts = [
        F.col(card).cast("bigint"),
        F.col(address).cast("bigint"),
        day_of(time) - F.col(anchor).cast("bigint"),
    ]
    complete = parts[0].isNotNull() & parts[1].isNotNull() & F.col(anchor).isNotNull()
    return F.when(complete, F.format_string("%d_%d_%d", *parts))


def missing_count(columns: Sequence[str]) -> Column:
    """How many of the columns, all of one type, are NULL.

    An array that drops its NULLs instead of a long sum: a few hundred nested additions overflow
    the planner's stack, and this form was measured fastest.
    """
    if not columns:
        return F.lit(0)
    present = F.array_compact(F.array(*[F.col(c) for c in columns]))
    return F.lit(len(columns)) - F.size(present)


def boolean_from_text(column: str) -> Column:
    """``true/t/1`` and ``false/f/0`` in any case; anything else is NULL."""
    text = F.lower(F.col(column))
    return F.when(text.isin("true", "t", "1"), F.lit(True)).when(
        text.isin("false", "f", "0"), F.lit(False)
    )


def is_fractional(column: str) -> Column:
    value = F.col(column)
    return value.isNotNull() & (value != F.floor(value))


def clipped(column: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(column, F.lit(low)), F.lit(high))


def optional_number(text: Column) -> Column:
    """A number written as text, where ``NA`` and ``NaN`` mean nothing was measured."""
    return F.when(~text.isin("NA", "NaN"), text.try_cast("double"))


def age_days(timestamp: Column, now: Column) -> Column:
    return (F.unix_timestamp(now) - F.unix_timestamp(timestamp)) / F.lit(86400.0)


def positive_probability(probabilities: Column, label: str = "1") -> Column:
    """The probability of ``label`` from an array of (label, prob) structs."""
    return F.filter(probabilities, lambda p: p["label"].cast("string") == F.lit(label))[0]["prob"]


def short_digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


_KINDS = {
    T.BooleanType: "bool",
    T.StringType: "str",
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "int",
}


def kind_of(data_type: T.DataType) -> str:
    """``int``, ``float``, ``str`` or ``bool``; unknown types count as ``float``."""
    return _KINDS.get(type(data_type), "float")
