"""Joins of a row table against a table that is unique on its key.

Spark broadcasts the key side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot keys of
the row side. :func:`small_side` asks for a broadcast up front, but only for a counted side: it
saves shuffling wide rows before the small side's size is known.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.names import ID

_NULL_LANES = 1 << 20
# Bytes of a dictionary of many columns that may be broadcast.
BROADCAST_BYTES = 32 << 20
# Rows of (key, value) a broadcast may hold; a few tens of megabytes.
BROADCAST_ROWS = 500_000


def _left_probe(rows: DataFrame, side: DataFrame, probe: Column, key: str) -> DataFrame:
    """``rows`` left-joined to ``side`` on ``probe == key``.

    NULL probes match nothing, yet would all hash to one partition. A second key sends them to
    many: it is 0 for every row that can match, and on the side it is 0 in a form the optimizer
    does not fold away.
    """
    plain = [c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    unique = [ID] if ID in rows.columns else plain
    lane = F.when(probe.isNull(), F.pmod(F.xxhash64(*unique), F.lit(_NULL_LANES))).otherwise(
        F.lit(0).cast("bigint")
    )
    side = side.withColumn("_lane", F.pmod(F.xxhash64(key), F.lit(1).cast("bigint")))
    return rows.join(side, (probe == F.col(key)) & (lane == F.col("_lane")), "left").drop("_lane")


def small_side(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``side``, marked for broadcast if counting shows that it holds at most ``most`` rows."""
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def left_attach(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Every row, plus the columns of its 0..1 match on ``side``."""
    return rows.join(side, key, "left")


def inner_attach(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Rows that have a match, plus its columns."""
    return rows.join(side, key, "inner")


def with_membership(
    rows: DataFrame, members: DataFrame, column: str, flag: str, *, missing: bool | None = None
) -> DataFrame:
    """Adds ``flag``: does the row's ``column`` occur in ``members``?

    A NULL value gives ``missing``: NULL keeps "no entity" apart from "unseen entity".
    """
    known = (
        members.where(F.col(column).isNotNull())
        .select(F.col(column).alias("_member"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    found = F.when(F.col(column).isNull(), F.lit(missing)).otherwise(F.col("_hit").isNotNull())
    return (
        _left_probe(rows, known, F.col(column), "_member")
        .withColumn(flag, found.cast("boolean"))
        .drop("_member", "_hit")
    )


def with_lookup(
    rows: DataFrame, table: DataFrame, probe: Column, key: str, value: str, output: str
) -> DataFrame:
    """Adds ``output``: the table's ``value`` where its ``key`` equals ``probe``, else NULL."""
    side = small_side(table.select(F.col(key).alias("_key"), F.col(value).alias(output)))
    return _left_probe(rows, side, probe, "_key").drop("_key")


def with_dictionary(
    rows: DataFrame,
    dictionary: DataFrame,
    probes: Mapping[str, tuple[str, Column]],
    code: str,
    *,
    key: str | None = None,
    most_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds many outputs from one dictionary (``column, value``, ``code``), unique on its first two.

    ``probes`` maps each output to the dictionary's column and the text to look up; NULL and unknown texts give
    NULL. The dictionary's bytes are measured once. A small one is broadcast: every probe is map-side and nothing
    is shuffled. A larger one is joined once, whatever the number of outputs: the texts of a row go out as cells,
    meet the dictionary, and come back as one map per ``key``, which must be unique and not NULL. Without a key
    each output takes a join of its own.
    """
    if not probes:
        return rows
    wanted = sorted({column for column, _ in probes.values()})
    side = dictionary.where(F.col("column").isin(wanted)).select("column", "value", F.col(code).alias("_code"))
    size = F.sum(F.octet_length("column") + F.octet_length("value") + F.coalesce(F.octet_length(F.col("_code").cast("string")), F.lit(0)) + F.lit(32))
    small = (side.agg(size.alias("bytes")).first()["bytes"] or 0) <= most_bytes
    if small or key is None:
        for output, (column, text) in probes.items():
            own = side.where(F.col("column") == column).select(F.col("value").alias("_key"), F.col("_code").alias(output))
            rows = _left_probe(rows, F.broadcast(own) if small else own, text.cast("string"), "_key").drop("_key")
        return rows
    cells = F.array(
        *[
            F.struct(F.lit(place).alias("_place"), F.lit(column).alias("column"), text.cast("string").alias("value"))
            for place, (column, text) in enumerate(probes.values())
        ]
    )
    met = rows.select(F.col(key).alias("_row"), F.inline(cells)).where(F.col("value").isNotNull()).join(side, ["column", "value"])
    codes = met.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_place", "_code"))).alias("_codes"))
    joined = rows.join(codes, F.col(key) == F.col("_row"), "left")
    return joined.withColumns({o: F.col("_codes")[F.lit(place)] for place, o in enumerate(probes)}).drop("_row", "_codes")


def names_missing_from(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Names on the left that the right does not have."""
    return left.select(column).distinct().join(right.select(column).distinct(), column, "left_anti")


def names_in_both(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return left.select(column).intersect(right.select(column))
