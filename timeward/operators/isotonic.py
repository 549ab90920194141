"""Isotonic regression over any number of scores, of many groups in one pass.

The fit is a table of blocks: a stretch of scores, ``low`` to ``high``, that shares one ``value``. Records are laid
into their order and cut into ranges by position. Each range pools its own violators in one task, which turns most of
its records into few blocks. Where the last block of a range lies above the first one of the next, the blocks
are cut anew, half a range further on, and pooled again, until no neighbours descend: pooling neighbours that descend, in any
order, ends in the one isotonic fit. A task holds at most ``per_range`` blocks and the driver one number per round.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.functions.scalars import clipped
from timeward.operators.ordered import PER_RANGE, WHOLE_BELOW, accumulate, with_range_by
from timeward.session import materialize

# Blocks that are broadcast, at two records of 16 bytes each; more meet the scores in one order instead.
HELD_BLOCKS = 10_000
_PARTS = ("low", "high", "_total", "_weight")


def pool(total: Sequence[float], weight: Sequence[float]) -> list[int]:
    """Where the blocks start once neighbours whose means descend are pooled."""
    starts: list[int] = []
    sums: list[float] = []
    weights: list[float] = []
    for k, (s, w) in enumerate(zip(total, weight)):
        start = k
        while sums and sums[-1] * w >= s * weights[-1]:
            s, w, start = s + sums.pop(), w + weights.pop(), starts.pop()
        starts.append(start)
        sums.append(s)
        weights.append(w)
    return starts


def _pooled(part: pa.Table) -> pa.Table:
    part = part.sort_by("low")  # NaN last
    total, weight = part["_total"].to_numpy(), part["_weight"].to_numpy()
    starts = np.array(pool(total.tolist(), weight.tolist()))
    out = part.take(starts)
    lasts = np.append(starts[1:], len(part)) - 1
    made = {"high": part["high"].to_numpy()[lasts], "_total": np.add.reduceat(total, starts), "_weight": np.add.reduceat(weight, starts)}
    for name, values in made.items():
        out = out.set_column(out.schema.get_field_index(name), name, pa.array(values))
    return out


def _descents(blocks: DataFrame, by: list[str]) -> int:
    """Neighbouring ranges whose meeting blocks descend; one record per range is compared."""
    held = F.struct("_total", "_weight")
    ends = blocks.groupBy(*by, "_range").agg(
        F.min_by(held, "low").alias("_first"), F.max_by(held, "low").alias("_last")
    )
    along = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.lag("_last").over(along.orderBy("_range"))
    return (
        ends.withColumn("_before", before)
        .where(F.col("_before._total") * F.col("_first._weight") > F.col("_first._total") * F.col("_before._weight"))
        .count()
    )


def fit_blocks(
    points: DataFrame, score: str, label: str, weight: str, *, by: Sequence[str] = (), per_range: int = PER_RANGE
) -> DataFrame:
    """(``by``, low, high, value): the isotonic fit of each group's weighted points, as written blocks.

    Points of one score are pooled first, as equal scores must share a value. NULL scores, NULL labels and points
    without a weight drop out; NaN is the largest score. A group without points has no blocks.
    """
    by = list(by)
    w = F.col(weight).cast("double")
    usable = points.where(F.col(score).isNotNull() & F.col(label).isNotNull() & (w > 0))
    records = usable.groupBy(*by, F.col(score).cast("double").alias("low")).agg(
        F.sum(F.col(label).cast("double") * w).alias("_total"), F.sum(w).alias("_weight")
    )
    blocks = materialize(records.withColumn("high", F.col("low")).select(*by, *_PARTS), "points")
    made = T.StructType([*[blocks.schema[c] for c in by], T.StructField("_range", T.LongType()), *[blocks.schema[c] for c in _PARTS]])
    shift = 0
    while True:
        placed = accumulate(blocks.withColumn("_n", F.lit(1)), "low", ["_n"], by=by).select(
            *by, F.expr(f"(cum__n - 1 + {shift}) div {per_range}").alias("_range"), *_PARTS
        )
        blocks = materialize(placed.groupBy(*by, "_range").applyInArrow(_pooled, made), "blocks")
        if not _descents(blocks, by):
            return blocks.select(*by, "low", "high", (F.col("_total") / F.col("_weight")).alias("value"))
        shift = per_range // 2 - shift


def _ends(blocks: DataFrame, by: list[str]) -> DataFrame:
    """One record per end of a block; a block of one score has one."""
    return blocks.select(*by, F.explode(F.array_distinct(F.array("low", "high"))).alias("_at"), "value")


def _between(x: Column, below: Column, above: Column) -> Column:
    """The value at ``x`` on the line from one end to the next; beyond the outer ends, theirs."""
    rise = (above["value"] - below["value"]) * (x - below["_at"]) / (above["_at"] - below["_at"])
    return (
        F.when(below.isNull(), above["value"])
        .when(above.isNull() | (below["_at"] == x), below["value"])
        # A block is level, and so is the way to an end that lies infinitely far.
        .when(below["value"] == above["value"], below["value"])
        .otherwise(below["value"] + F.when(F.isnan(rise), F.lit(0.0)).otherwise(rise))
    )


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> list[Column]:
    return [left[a].eqNullSafe(right[b]) for a, b in pairs]


def _apply_held(rows: DataFrame, ends: DataFrame, x: str, output: str, by: list[str], held_blocks: int) -> DataFrame:
    """Ends broadcast as one sorted array per group, searched by halves."""
    named = [F.col(c).alias(f"_b_{c}") for c in by]
    held = ends.groupBy(*named).agg(F.sort_array(F.collect_list(F.struct("_at", "value"))).alias("_ends"))
    match = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by]
    joined = rows.join(F.broadcast(held), match or F.lit(True), "left")  # at most 2 * held_blocks records
    size, at = F.size("_ends"), F.col(x)

    def halved(seen: Column, _: Column) -> Column:
        middle = F.floor((seen["low"] + seen["high"]) / 2).cast("int")
        open_, reached = seen["low"] < seen["high"], F.get(F.col("_ends"), middle)["_at"] <= at
        return F.struct(
            F.when(open_ & reached, middle + 1).otherwise(seen["low"]).alias("low"),
            F.when(open_ & ~reached, middle).otherwise(seen["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit((2 * held_blocks).bit_length()))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    found = joined.withColumn("_k", F.aggregate(steps, start, halved, lambda seen: seen["low"]))
    below = F.when(F.col("_k") > 0, F.get(F.col("_ends"), F.col("_k") - 1))
    value = F.when(at.isNotNull() & (size > 0), _between(at, below, F.get(F.col("_ends"), F.col("_k"))))
    return found.withColumn(output, value).drop("_k", "_ends", *[f"_b_{c}" for c in by])


def _apply_merged(rows: DataFrame, ends: DataFrame, x: str, output: str, by: list[str], whole_below: int) -> DataFrame:
    """Distinct scores and ends in one order: each score sees the last end up to it and the first one from it on."""
    scores = rows.where(F.col(x).isNotNull()).select(*by, F.col(x).alias("_at")).distinct()
    both = (
        ends.unionByName(scores.withColumn("value", F.lit(None).cast("double")))
        .groupBy(*by, "_at")
        .agg(F.max("value").alias("value"))
        .withColumn("_end", F.when(F.col("value").isNotNull(), F.struct("_at", "value")))
    )
    both = materialize(both, "meeting")
    many = both.count() > whole_below
    placed = with_range_by(both.withColumn("_all", F.lit(0)), "_at", by or ["_all"]) if many else both.withColumn("_range", F.lit(0))
    spans = [*by, "_range"]
    inside = Window.partitionBy(*spans).orderBy("_at")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # One record per group and range from here to the join.
    along = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_range")
    handed = (
        placed.groupBy(*[F.col(c).alias(f"_b_{c}") for c in by], F.col("_range").alias("_b__range"))
        .agg(F.min("_end").alias("_first"), F.max("_end").alias("_last"))
        .withColumnsRenamed({f"_b_{c}": c for c in by} | {"_b__range": "_range"})
        .select(
            *[F.col(c).alias(f"_b_{c}") for c in by],
            F.col("_range").alias("_b__range"),
            F.last("_last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
            F.first("_first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_later"),
        )
    )
    seen = placed.withColumns(
        {"_below": F.last("_end", ignorenulls=True).over(upto), "_above": F.first("_end", ignorenulls=True).over(onward)}
    )
    valued = seen.join(handed, _same(seen, handed, [(c, f"_b_{c}") for c in spans])).select(
        *[F.col(c).alias(f"_c_{c}") for c in by],
        F.col("_at").alias("_c_at"),
        _between(F.col("_at"), F.coalesce("_below", "_earlier"), F.coalesce("_above", "_later")).alias("_c_value"),
    )
    match = _same(rows, valued, [*[(c, f"_c_{c}") for c in by], (x, "_c_at")])
    return rows.join(valued, match, "left").withColumn(output, F.col("_c_value")).drop("_c_at", "_c_value", *[f"_c_{c}" for c in by])


def apply_blocks(
    rows: DataFrame,
    blocks: DataFrame,
    score: str,
    output: str,
    *,
    by: Sequence[str] = (),
    held_blocks: int = HELD_BLOCKS,
    whole_below: int = WHOLE_BELOW,
) -> DataFrame:
    """Adds ``output``: the fit at each score, between blocks on a straight line, beyond them the nearest end's.

    NULL scores, and rows of a group without blocks, get NULL.
    """
    by = list(by)
    plain = rows.withColumn("_x", F.col(score).cast("double"))
    ends = _ends(blocks, by)
    if blocks.count() <= held_blocks:
        out = _apply_held(plain, ends, "_x", output, by, held_blocks)
    else:
        out = _apply_merged(plain, ends, "_x", output, by, whole_below)
    value = F.when(F.col(output).isNotNull(), clipped(F.col(output), 0.0, 1.0))
    return out.withColumn(output, value).drop("_x")
