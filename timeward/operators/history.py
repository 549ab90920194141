"""Aggregates over an entity's strictly earlier rows.

Every frame is a RANGE over integer seconds that stops one second before the current row, so
the row itself and every row sharing its instant stay out.

An entity with a modest number of rows takes the direct route: one window partition. Spark
merges all frames of one entity into a single shuffle, and rows without an entity are spread
over many partitions instead of forming one.

An entity with more rows than ``SLICE_ABOVE`` would put them all into one task, so it takes the
sliced route, in which no task ever holds more than a bounded part of an entity:

1. rows are pre-aggregated to one record per (entity, second), with map-side combine;
2. for bounded frames records are spread over (entity, time bucket), so a slice holds at most one record
   per second of its bucket, plus the copies described next;
3. a frame of width ``w`` cut at multiples of ``w`` is the part of the current slice before the
   row plus the tail of the previous slice. The tail comes from a copy of the records moved
   forward by ``w``, so both parts are running totals, never a re-scan of the frame and never a
   difference of large sums;
4. unbounded frames need no copies, so they have slices of their own: runs of days that end with the day on
   which an entity's rows pass a multiple of ``slice_rows``. A slice holds at most that many records and those
   of one day, and one carried record, the total of all earlier runs. Only an entity of more than one run
   has such records, so most data has none;
5. the result, one record per (entity, second), is joined back on both columns, which spreads
   an entity over its instants; AQE splits what a single instant still concentrates.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.names import DAY_SECONDS, ID
from timeward.session import materialize

# Rows of one entity above which its window is sliced. Spark re-reads a sliding frame for every
# row, so the bound also caps that work.
SLICE_ABOVE = 20_000
_LANES = 1 << 20
_OWN, _CARRY = -1, 0


class Sliced(Enum):
    """Stands for a list of hot entities that names them all."""

    ALL = "all"


@dataclass(frozen=True)
class Measure:
    """One output column.

    ``kind`` is ``count``, ``sum``, ``avg``, ``std`` or ``last`` (the latest earlier instant).
    ``frame`` is the width in seconds, ``None`` for all earlier rows.
    """

    name: str
    kind: str
    frame: int | None = None
    value: Column | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("count", "sum", "avg", "std", "last"):
            raise ValueError(f"unknown measure kind {self.kind!r}")
        if self.kind in ("sum", "avg", "std") and self.value is None:
            raise ValueError(f"{self.name} needs a value")
        if self.frame is not None and self.frame <= 0:
            raise ValueError(f"{self.name} needs a positive frame")


def _bucket(time: str, width: int) -> Column:
    return F.expr(f"({time} - pmod({time}, {width}L)) div {width}L")


def _frame_groups(measures: Sequence[Measure]) -> list[list[Measure]]:
    """Unbounded measures, and measures whose frames share one bucket width; usually a single group of these."""
    framed = [m for m in measures if m.frame is not None]
    groups = [[m for m in measures if m.frame is None]]
    widths = sorted({m.frame for m in framed})
    if not widths or math.lcm(*widths) <= 4 * max(widths):
        groups.append(framed)
    else:
        groups += [[m for m in framed if m.frame == w] for w in reversed(widths)]
    return [g for g in groups if g]


# Entries of a heavy-hitter sketch: three quarters of its table of 2^17 slots. Its counts are off by at most 3.5 rows in
# 2^17, and it lists whatever lies above twice that, so it lists all entities above a bound up to _SURE times as many rows.
_TRACKED = 98_304
_SURE = (1 << 17) // 7
_MERGERS = 64


def _as_text(entity: str) -> Column:
    return F.col(entity).cast("string")


def _suspects(rows: DataFrame, entities: Sequence[str], above: int) -> DataFrame:
    """(column, rows, missing, values): per entity column those values that may lie above the bound.

    One scan. Each task keeps a sketch of bounded size per column, sketches are merged in two steps, and the values of a
    column are at most 2 * _SURE + 1: no more can have half of the bound or more.
    """
    states = [
        F.expr(f"approx_top_k_accumulate(`_v{i}`, {_TRACKED}) FILTER (WHERE `_v{i}` IS NOT NULL)").alias(f"_s{i}")
        for i in range(len(entities))
    ]
    missing = [F.count_if(F.col(f"_v{i}").isNull()).alias(f"_m{i}") for i in range(len(entities))]
    merged = (
        rows.select(*[_as_text(e).alias(f"_v{i}") for i, e in enumerate(entities)])
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"), *states, *missing)
        .groupBy(F.lit(0).alias("_all"))  # no rows at all give no row
        .agg(
            F.sum("_rows").alias("_rows"),
            *[F.expr(f"approx_top_k_combine(_s{i}, {_TRACKED})").alias(f"_s{i}") for i in range(len(entities))],
            *[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(entities))],
        )
    )
    listed = [
        F.struct(
            F.lit(e).alias("column"),
            F.coalesce(F.col("_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.col(f"_m{i}"), F.lit(0)).alias("missing"),
            F.expr(f"transform(filter(approx_top_k_estimate(_s{i}, {2 * _SURE + 1}), f -> f.count > {above // 2}), f -> f.item)").alias("values"),
        )
        for i, e in enumerate(entities)
    ]
    return merged.select(F.inline(F.array(*listed)))


def _counted(rows: DataFrame, entities: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(e).alias("column"), _as_text(e).alias("value")) for e in entities])
    return rows.select(F.inline(pairs))


def find_hot(
    rows: DataFrame,
    entities: Sequence[str],
    above: int = SLICE_ABOVE,
    *,
    share_missing: Sequence[str] = (),
    sure: int = _SURE,
) -> dict[str, DataFrame | Sliced]:
    """For each entity column that has any value on more than ``above`` rows, those values.

    A sketch names the few values that may be hot, and only they are counted exactly. Beyond ``sure * above`` rows
    a sketch might miss one; then all values are counted, with map-side combine. Either way the hot values are written
    once, and one row per column comes back to the driver. A missing value counts only for columns in ``share_missing``.

    A bound below one lists every entity there is; they are neither counted nor written, ``Sliced.ALL`` stands for them.
    """
    entities = list(dict.fromkeys(entities))
    if above < 1:
        return dict.fromkeys(entities, Sliced.ALL)
    counts = F.count(F.lit(1)).alias("_n")
    seen = materialize(_suspects(rows, entities, above), "suspects")
    # One row per entity column.
    sizes = seen.select("column", "rows", "missing", F.size("values").alias("named")).collect()
    if not sizes or sizes[0]["rows"] <= above:
        return {}
    if sizes[0]["rows"] <= sure * above:
        named = [r["column"] for r in sizes if r["named"] > 0]
        found = seen.select("column", F.explode("values").alias("value"))
        # At most 2 * _SURE + 1 values per column.
        exact = _counted(rows, named).join(F.broadcast(found), ["column", "value"]) if named else found.limit(0)
    else:
        exact = _counted(rows, entities).where(F.col("value").isNotNull())
    hot = exact.groupBy("column", "value").agg(counts).where(F.col("_n") > above).select("column", "value")
    absent = [r["column"] for r in sizes if r["column"] in share_missing and r["missing"] > above]
    if absent:
        hot = hot.unionByName(
            seen.where(F.col("column").isin(absent)).select("column", F.lit(None).cast("string").alias("value"))
        )
    hot = materialize(hot, "hot-entities")
    present = {r["column"] for r in hot.select("column").distinct().collect()}
    return {
        e: hot.where(F.col("column") == e).select(F.col("value").cast(rows.schema[e].dataType).alias(e))
        for e in entities
        if e in present
    }


def add_history(
    rows: DataFrame,
    entity: str,
    time: str,
    measures: Sequence[Measure],
    *,
    hot: DataFrame | Sliced | None = None,
    base: DataFrame | None = None,
    share_missing_entity: bool = False,
    slice_rows: int = SLICE_ABOVE,
) -> DataFrame:
    """``rows`` plus one column per measure.

    ``hot`` lists the entities to slice (see :func:`find_hot`); their history is computed from
    ``base``, the rows before any other history was added, so that adding several histories does
    not repeat earlier ones. Where all are sliced no row is left for the direct route, so none is
    shuffled for it and the values of the measures don't travel with the rows. A row without an entity gets NULL for every
    measure;
    ``share_missing_entity`` instead treats the missing value as one entity, which is what an
    unguarded SQL window does.
    """
    # Frames end one second before the row and slices are cut at whole seconds.
    if not isinstance(rows.schema[time].dataType, T.IntegralType):
        raise ValueError(f"{time} must hold whole seconds, not {rows.schema[time].dataType.simpleString()}")
    same_entity = Column.eqNullSafe if share_missing_entity else Column.__eq__
    alone = F.lit(False) if share_missing_entity else F.col(entity).isNull()
    found: dict[str, Column] = {}
    kept = {*rows.columns, *[m.name for m in measures]}
    if hot is not None:
        many = base if base is not None else rows
        if hot is not Sliced.ALL:
            listed = hot.select(F.col(entity).alias("_listed"))
            many = many.join(listed, same_entity(F.col(entity), F.col("_listed")), "left_semi")
        elif not share_missing_entity:
            many = many.where(F.col(entity).isNotNull())
        for i, group in enumerate(_frame_groups(measures)):
            names = {m.name: f"_s_{m.name}" for m in group}
            sliced = history_by_instant(many, entity, time, group, slice_rows=slice_rows).select(
                F.col("_entity").alias(f"_e{i}"),
                F.col("_t").alias(f"_t{i}"),
                *[F.col(a).alias(b) for a, b in names.items()],
            )
            match = same_entity(F.col(entity), F.col(f"_e{i}")) & (F.col(time) == F.col(f"_t{i}"))
            rows = rows.join(sliced, match, "left")
            found |= {a: F.col(b) for a, b in names.items()}
        if hot is Sliced.ALL:
            out = rows.withColumns({m.name: found[m.name] for m in measures})
            return out.drop(*[c for c in out.columns if c not in kept])
        # Rows of a sliced entity need no window; they join the lanes of rows without one.
        alone = alone | F.col("_t0").isNotNull()
    if hot is None and share_missing_entity:
        keys = [F.col(entity)]
    else:
        lane = F.pmod(F.xxhash64(F.col(ID) if ID in rows.columns else F.col(time)), F.lit(_LANES))
        keys = [F.col(entity), F.when(alone, lane)]
    ordered = Window.partitionBy(*keys).orderBy(time)

    def column(m: Measure) -> Column:
        direct = _window_column(m, time, ordered)
        if not share_missing_entity:
            direct = F.when(F.col(entity).isNotNull(), direct)
        if hot is None:
            return direct
        return F.when(F.col("_t0").isNotNull(), found[m.name]).otherwise(direct)

    out = rows.withColumns({m.name: column(m) for m in measures})
    return out.drop(*[c for c in out.columns if c not in kept])


def _window_column(m: Measure, time: str, ordered) -> Column:
    start = Window.unboundedPreceding if m.frame is None else -m.frame
    window = ordered.rangeBetween(start, -1)
    if m.kind == "count":
        return F.count(F.lit(1)).over(window)
    if m.kind == "last":
        return F.max(time).over(window)
    value = m.value.cast("double")
    return {"sum": F.sum, "avg": F.avg, "std": F.stddev_samp}[m.kind](value).over(window)


def history_by_instant(
    rows: DataFrame, entity: str, time: str, measures: Sequence[Measure], *, slice_rows: int = SLICE_ABOVE
) -> DataFrame:
    """One record per (entity, second): ``_entity``, ``_t`` and the measures.

    The measures have bounded frames or unbounded ones, not both.
    """
    widths = sorted({m.frame for m in measures if m.frame is not None})
    if widths and any(m.frame is None for m in measures):
        raise ValueError("bounded and unbounded frames are cut into different slices")
    values: dict[str, str] = {}
    projected: list[Column] = []
    slots: dict[str, str | None] = {}
    for m in measures:
        if m.value is None:
            slots[m.name] = None
            continue
        key = f"{m.value} {m.kind == 'std'}"
        if key not in values:
            values[key] = f"_v{len(values)}"
            projected.append(m.value.cast("double").alias(values[key]))
        slots[m.name] = values[key]

    states: dict[str, Column] = {}
    for m in measures:
        slot = slots[m.name]
        if m.kind == "count":
            states["_n"] = F.count(F.lit(1))
        elif slot is not None:
            states[f"{slot}c"] = F.count(slot)
            states[f"{slot}s"] = F.sum(slot)
            if m.kind == "std":
                states[f"{slot}q"] = F.sum(F.col(slot) * F.col(slot))
    names = list(states)

    narrow = rows.select(
        F.col(entity).alias("_entity"), F.col(time).cast("bigint").alias("_t"), *projected
    )
    centred = _centred(narrow, sorted({slots[m.name] for m in measures if m.kind == "std"}))
    instants = (
        centred.groupBy("_entity", "_t")
        .agg(F.max("_t").alias("_last"), *[c.alias(n) for n, c in states.items()])
    )

    if not widths:
        out = _totals_before(instants, _starts(narrow, slice_rows), names)
    else:
        bucket = math.lcm(*widths)
        # The bucket-wide windows come first: their shuffle also serves the narrower ones.
        out = _place(instants, widths, bucket)
        for w in [bucket, *[w for w in reversed(widths) if w != bucket]]:
            out = _with_frames(out, w, bucket, measures, slots)
        out = out.where(F.col("_role") == _OWN)
    return out.select("_entity", "_t", *[_finish(m, slots[m.name]).alias(m.name) for m in measures])


def _centred(narrow: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Moves each value near zero within its entity, so that sums of squares keep their digits.

    The moves are whole numbers: whole values stay whole and their sums exact.
    """
    if not slots:
        return narrow
    centres = narrow.groupBy(F.col("_entity").alias("_centred")).agg(
        *[F.floor(F.avg(v)).alias(f"_m{v}") for v in slots]
    )
    joined = narrow.join(centres, F.col("_entity").eqNullSafe(F.col("_centred")), "left")
    return joined.withColumns({v: F.col(v) - F.col(f"_m{v}") for v in slots}).drop(
        "_centred", *[f"_m{v}" for v in slots]
    )


def _place(instants: DataFrame, widths: Sequence[int], bucket: int) -> DataFrame:
    """Each record in its own bucket, and once more per width, moved forward by that width."""
    spots = [F.struct(F.lit(_OWN).alias("_role"), F.col("_t").alias("_x"))]
    spots += [
        F.struct(F.lit(w).alias("_role"), (F.col("_t") + F.lit(w)).cast("bigint").alias("_x"))
        for w in widths
    ]
    return (
        instants.select("*", F.inline(F.array(*spots)))
        .withColumn("_b", _bucket("_x", bucket))
    )


def _starts(rows: DataFrame, slice_rows: int) -> DataFrame:
    """(entity, days) for each entity that is cut: the first day of every run of days but its first.

    A run ends with the day on which the entity's rows pass a multiple of ``slice_rows``, so there is at most one
    run to that many rows, whatever their entities are.
    """
    by_day = Window.partitionBy("_entity").orderBy("_b")
    earlier = F.coalesce(F.sum("_k").over(by_day.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = (
        rows.groupBy("_entity", _bucket("_t", DAY_SECONDS).alias("_b"))
        .agg(F.count(F.lit(1)).alias("_k"))
        .select("_entity", "_b", F.floor(earlier / slice_rows).alias("_run"))
    )
    return (
        runs.where(F.col("_run") > 0)
        .groupBy("_entity", "_run")
        .agg(F.min("_b").alias("_b"))
        .groupBy(F.col("_entity").alias("_cut"))
        .agg(F.array_sort(F.collect_list("_b")).alias("_days"))
    )


def _totals_before(instants: DataFrame, starts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each record with the totals of its entity's earlier records, as ``_fall`` and the state's name."""
    here = _bucket("_t", DAY_SECONDS)
    # One entry per slice_rows rows at most.
    placed = instants.join(F.broadcast(starts), F.col("_entity").eqNullSafe(F.col("_cut")), "left").withColumn(
        "_run", F.coalesce(F.size(F.filter("_days", lambda d: d <= here)), F.lit(0))
    )
    before = Window.partitionBy("_entity").orderBy("_run").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.where(F.col("_days").isNotNull())
        .groupBy("_entity", "_run")
        .agg(F.min("_t").alias("_t"), F.max("_last").alias("_last"), *[F.sum(n).alias(n) for n in names])
        .select(
            "_entity",
            (F.col("_t") - F.lit(1)).alias("_t"),
            "_run",
            F.lit(_CARRY).alias("_role"),
            F.max("_last").over(before).alias("_last"),
            *[F.sum(n).over(before).alias(n) for n in names],
        )
    )
    every = placed.select("_entity", "_t", "_run", F.lit(_OWN).alias("_role"), "_last", *names).unionByName(carried)
    ahead = Window.partitionBy("_entity", "_run").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    totals = {f"_fall{n}": F.sum(n).over(ahead) for n in names} | {"_fall_last": F.max("_last").over(ahead)}
    return every.withColumns(totals).where(F.col("_role") == _OWN)


def _states_of(measures: Sequence[Measure], slots: dict[str, str | None]) -> list[str]:
    found: dict[str, None] = {}
    for m in measures:
        slot = slots[m.name]
        if m.kind == "count":
            found["_n"] = None
        elif m.kind == "last":
            found["_last"] = None
        else:
            found[f"{slot}c"] = found[f"{slot}s"] = None
            if m.kind == "std":
                found[f"{slot}q"] = None
    return list(found)


def _total(state: str, role: Column, window) -> Column:
    picked = F.when(role, F.col(state))
    return (F.max(picked) if state == "_last" else F.sum(picked)).over(window)


def _with_frames(
    placed: DataFrame, width: int, bucket: int, measures: Sequence[Measure], slots: dict
) -> DataFrame:
    """Totals for the frame of this width, cut at multiples of it."""
    keys = ["_entity", "_b"]
    if width != bucket:
        placed = placed.withColumn("_sub", _bucket("_x", width))
        keys.append("_sub")
    base = Window.partitionBy(*keys)
    ahead = base.orderBy("_x").rangeBetween(Window.unboundedPreceding, -1)
    tail = base.orderBy(F.col("_x").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    role = F.col("_role")
    framed = _states_of([m for m in measures if m.frame == width], slots)
    front = {f"_h{s}": _total(s, role == _OWN, ahead) for s in framed}
    # Two steps, so that each Window node keeps a single sort order.
    out = placed.withColumns(front) if front else placed
    if framed:
        out = out.withColumns({f"_g{s}": _total(s, role == width, tail) for s in framed})
    # Moved records have done their work.
    out = out.where(role != width)
    merged = {}
    for s in framed:
        left, right = F.col(f"_h{s}"), F.col(f"_g{s}")
        # A moved record still carries the time it had before the move.
        both = F.greatest(left, right) if s == "_last" else (
            F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))
        )
        merged[f"_f{width}{s}"] = both
    out = out.withColumns(merged) if merged else out
    return out.drop("_sub", *[c for s in framed for c in (f"_h{s}", f"_g{s}")])


def _finish(m: Measure, slot: str | None) -> Column:
    tag = f"_f{'all' if m.frame is None else m.frame}"
    if m.kind == "count":
        return F.coalesce(F.col(f"{tag}_n"), F.lit(0)).cast("bigint")
    if m.kind == "last":
        return F.col(f"{tag}_last")
    count, total = F.col(f"{tag}{slot}c"), F.col(f"{tag}{slot}s")
    if m.kind == "sum":
        return F.when(count > 0, total)
    if m.kind == "avg":
        return F.when(count > 0, total / count)
    squares = F.col(f"{tag}{slot}q")
    spread = F.greatest(squares - total * total / count, F.lit(0.0))
    return F.when(count > 1, F.sqrt(spread / (count - 1)))


def add_entity_total(
    rows: DataFrame, entity: str, outputs: dict[str, Column]
) -> DataFrame:
    """Aggregates over the whole entity, later rows included.

    Looks into the future by design: only for measuring what that would be worth.
    """
    totals = (
        rows.where(F.col(entity).isNotNull())
        .groupBy(F.col(entity).alias("_entity"))
        .agg(*[c.alias(n) for n, c in outputs.items()])
    )
    return rows.join(totals, F.col(entity) == F.col("_entity"), "left").drop("_entity")
