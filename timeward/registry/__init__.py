"""Named queries over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None
    covers: tuple[str, ...]


ENTRIES: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``; ``covers`` lists the inventory rows it exercises."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, run, sql, tuple(covers.split()))
        return run

    return register


# Added before rounding, so that a value lying exactly between two roundings goes the same way in
# both engines whatever the last bit of its sum.
_NUDGE = "0.00000037"


def steady(column: Column, digits: int = 5) -> Column:
    return F.round(column + F.lit(float(_NUDGE)), digits)


def steady_double(column: Column, digits: int = 5) -> Column:
    """As :func:`steady`, of doubles and in doubles, as the SQL rounds them: Spark's ``round`` writes and reads each as
    a decimal, which on a wide feature row costs more than the rest of its projection."""
    power = F.lit(float(10**digits))
    # Minus zero becomes zero, as it does in a decimal.
    return F.rint((column + F.lit(float(_NUDGE))) * power) / power + F.lit(0.0)


def steady_sql(text: str, digits: int = 5) -> str:
    return f"round(({text}) + {_NUDGE}::DOUBLE, {digits})"


def load_all() -> dict[str, Entry]:
    from timeward.registry import (  # noqa: F401
        assembly,
        evaluation,
        governance,
        history,
        loading,
        modelling,
        splitting,
        verified,
    )

    return ENTRIES
