"""Column audits: does a column keep its meaning over time, its distribution, its own signal?

One scan turns all columns into a counted store: rows per column, value, label, time window and segment, written
once. Every audit reads that store, so rows of any width are read once whatever is asked of them, and what
is ordered are counted values. Only per-column numbers, bounded by the schema, are ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.contract.tables import REJECTIONS
from timeward.names import ID, LABEL, PRODUCT, TIME
from timeward.operators.metrics import ranking_metrics
from timeward.operators.ordered import quantiles_of, running_totals
from timeward.policy import Policy
from timeward.session import materialize

_FLOOR = 1e-6
PSI_BINS = 10


def _placed(rows: DataFrame, cells: Sequence[Column], *keep: Column | str) -> DataFrame:
    """One record per cell: the kept columns, ``_place`` in ``cells`` and ``_cell``.

    The array is made below the generator, in compiled code; as the generator's own argument it would be
    interpreted cell by cell. The outer form, because the plain one is planned with a filter that makes the array
    twice. A place is a number, which is cheaper to group by than a name.
    """
    held = rows.select(*keep, F.array(*cells).alias("_cells"))
    return held.select(*[c for c in held.columns if c != "_cells"], F.posexplode_outer("_cells").alias("_place", "_cell"))


def _name(columns: Sequence[str]) -> Column:
    """The column at ``_place``."""
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("_place"))


# Rows that are counted at a time.
_AT_ONCE = 16_384


def _tally(keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the values at each place of ``_cells``, apart for each combination of the ``keys`` columns before it."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        seen: dict[tuple, int] = {}
        groups = zip(*(rows.column(k).to_pylist() for k in range(keys))) if keys else [()] * rows.num_rows
        codes = np.array([seen.setdefault(g, len(seen)) for g in groups], np.int64)
        flat = rows.column("_cells").combine_chunks().flatten()
        # Minus zero is zero, as it is when Spark groups.
        cells = flat.to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1) + 0.0
        present = flat.is_valid().to_numpy(zero_copy_only=False).reshape(cells.shape)
        places, values, kinds, counts = [], [], [], []
        for place in range(cells.shape[1]):
            here = present[:, place]
            levels, at = np.unique(cells[here, place], return_inverse=True)
            found = np.bincount(at * len(seen) + codes[here])
            hit = np.flatnonzero(found)
            places.append(np.full(len(hit), place, np.int32))
            values.append(levels[hit // len(seen)])
            kinds.append(hit % len(seen))
            counts.append(found[hit])
        kind = np.concatenate(kinds)
        combos = list(seen)
        sides = [pa.array([c[k] for c in combos], rows.schema.field(k).type).take(pa.array(kind)) for k in range(keys)]
        made = [pa.array(np.concatenate(x)) for x in (places, values, counts)]
        return pa.RecordBatch.from_arrays([*sides, *made], names=[*rows.schema.names[:keys], "_place", "value", "_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= _AT_ONCE:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _counted(rows: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """``column, value``, the kept columns and ``n``: how often each non-missing value occurs.

    Batches are counted where they lie, a column at a time; only counts are shuffled.
    """
    held = rows.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("_cells"))
    kept = held.columns[:-1]
    types = "".join(f"{c} {held.schema[c].dataType.simpleString()}, " for c in kept)
    parts = held.mapInArrow(_tally(len(kept)), f"{types}_place int, value double, _n long")
    sums = parts.groupBy("_place", "value", *kept).agg(F.sum("_n").alias("n"))
    return sums.select(_name(columns).alias("column"), "value", *kept, "n")


def counted_cells(
    rows: DataFrame,
    columns: Sequence[str],
    *,
    train: tuple[float, float] | None = None,
    holdout: tuple[float, float] | None = None,
    segment: str | None = None,
    label: str | None = LABEL,
    time: str = TIME,
) -> DataFrame:
    """The store: ``column, value, window, segment, label, n`` for every non-missing value, written once.

    ``window`` tells the two slices of the time axis apart and is NULL outside them; rows outside are left out
    where no segment is asked for. Counts of one (value, label) merge before the shuffle.
    """
    window = F.lit(None).cast("string")
    if train is not None and holdout is not None:
        # Two numbers, so that rows outside the windows go before anything wide is computed.
        low, high = (F.lit(x).cast(rows.schema[time].dataType) for x in rows.agg(F.min(time), F.max(time)).first())
        share = (F.col(time) - low) / F.nullif(high - low, F.lit(0))
        inside = lambda w: (share >= F.lit(w[0])) & (share <= F.lit(w[1]))
        window = F.when(inside(train), "train").when(inside(holdout), "holdout")
    kept = {
        "window": window,
        "segment": (F.lit(None) if segment is None else F.col(segment)).cast("string"),
        "label": F.lit(0) if label is None else F.coalesce(F.col(label).cast("int"), F.lit(0)),
    }
    if segment is None and train is not None:
        rows = rows.where(window.isNotNull())
    return materialize(_counted(rows, columns, *[c.alias(n) for n, c in kept.items()]), "counted-cells")


def _windows(store: DataFrame) -> DataFrame:
    return store.where(F.col("window").isNotNull())


def time_consistency(
    rows: DataFrame,
    columns: Sequence[str],
    *,
    train: tuple[float, float] = (0.0, 0.17),
    holdout: tuple[float, float] = (0.83, 1.0),
    margin: float = 0.0,
    label: str = LABEL,
    time: str = TIME,
) -> DataFrame:
    """Per column, its ranking power early and late, and whether the ranking turned around."""
    return time_consistency_of(counted_cells(rows, columns, train=train, holdout=holdout, label=label, time=time), margin=margin)


def time_consistency_of(store: DataFrame, *, margin: float = 0.0) -> DataFrame:
    found = ranking_metrics(_windows(store), "value", "label", weight="n", by=["column", "window"])
    pick = lambda w: F.max(F.when(F.col("window") == w, F.col("roc_auc")))
    early, late = F.col("auc_train") - 0.5, F.col("auc_holdout") - 0.5
    turned = (early * late < 0) & (F.abs(early) > margin) & (F.abs(late) > margin)
    return (
        found.groupBy("column")
        .agg(pick("train").alias("auc_train"), pick("holdout").alias("auc_holdout"))
        .select(
            "column",
            "auc_train",
            "auc_holdout",
            (F.signum(early) * (F.col("auc_holdout") - F.col("auc_train"))).alias("delta"),
            F.coalesce(turned, F.lit(False)).alias("inverted"),
        )
    )


def distribution_shift(
    rows: DataFrame,
    columns: Sequence[str],
    *,
    train: tuple[float, float] = (0.0, 0.17),
    holdout: tuple[float, float] = (0.83, 1.0),
    bins: int = PSI_BINS,
    time: str = TIME,
) -> DataFrame:
    """Per column, the population stability index of the late slice against the early one.

    Bins are the early slice's exact quantiles. A column constant there has no bins: its index is
    NULL and ``degenerate`` is set, which is a different finding from a shift.
    """
    return distribution_shift_of(counted_cells(rows, columns, train=train, holdout=holdout, label=None, time=time), bins=bins)


def distribution_shift_of(store: DataFrame, *, bins: int = PSI_BINS) -> DataFrame:
    slices = _windows(store)
    early = slices.where(F.col("window") == "train")
    counted = running_totals(early, "value", {"n": F.sum("n")}, by=["column"])
    cuts = quantiles_of(counted, "value", [i / bins for i in range(bins + 1)], by=["column"])
    # One row per column of the schema, each with a short array.
    edges = cuts.groupBy("column").agg(F.array_distinct(F.array_sort(F.collect_list("value"))).alias("_edges"))
    placed = slices.join(F.broadcast(edges), "column", "left")
    # Inner edges only: the outermost bins are open.
    inner = F.slice("_edges", 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    slot = F.coalesce(F.size(F.filter(inner, lambda e: e < F.col("value"))), F.lit(0))
    per_bin = (
        placed.select("column", "window", "n", slot.alias("bin"), F.when(F.col("_edges").isNotNull(), F.size("_edges")).alias("_edge_count"))
        .groupBy("column", "bin")
        .agg(
            F.sum(F.when(F.col("window") == "train", F.col("n")).otherwise(0)).alias("early"),
            F.sum(F.when(F.col("window") == "holdout", F.col("n")).otherwise(0)).alias("late"),
            F.max("_edge_count").alias("_edge_count"),
        )
    )
    totals = per_bin.groupBy("column").agg(F.sum("early").alias("_e"), F.sum("late").alias("_l"))
    p = F.greatest(F.col("early") / F.nullif(F.col("_e"), F.lit(0)), F.lit(_FLOOR))
    q = F.greatest(F.col("late") / F.nullif(F.col("_l"), F.lit(0)), F.lit(_FLOOR))
    return (
        per_bin.join(totals, "column")
        .groupBy("column")
        .agg(F.sum((q - p) * F.log(q / p)).alias("_psi"), F.max("_edge_count").alias("_edge_count"))
        .select(
            "column",
            F.when(F.col("_edge_count") > 1, F.col("_psi")).alias("psi"),
            (F.coalesce("_edge_count", F.lit(0)) <= 1).alias("degenerate"),
        )
    )


def missing_families(rows: DataFrame, columns: Sequence[str], *, id: str = ID) -> DataFrame:
    """(column, family): columns missing on exactly the same rows share a family.

    A pattern is recognised by its count and order-free sums of both halves of row hashes.
    """
    key = F.xxhash64(id)
    halves = [F.shiftrightunsigned(key, 32).alias("_high"), key.bitwiseAND(F.lit(0xFFFFFFFF)).alias("_low")]
    cells = _placed(rows, [F.col(c).isNull() for c in columns], *halves)
    part = lambda c: F.sum(F.when(F.col("_cell"), F.col(c)).otherwise(F.lit(0)))
    sums = cells.groupBy("_place").agg(F.count_if("_cell").alias("_n"), part("_high").alias("_h"), part("_low").alias("_l"))
    patterns = sums.select(_name(columns).alias("column"), "_n", "_h", "_l")
    named = patterns.groupBy("_n", "_h", "_l").agg(F.min("column").alias("family"))
    return patterns.join(named, ["_n", "_h", "_l"]).select("column", "family")


def distinct_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _counted(rows, columns).groupBy("column").agg(F.count(F.lit(1)).alias("levels"))


def redundancy(
    rows: DataFrame, groups: Mapping[str, Sequence[str]], *, least: float = 0.9
) -> DataFrame:
    """Per group, the column with most distinct values represents it; a member is redundant when
    its correlation with the representative reaches ``least``.

    One pass counts levels, one pass takes every correlation, combined before the shuffle.
    """
    members = [c for group in groups.values() for c in group]
    levels = {r["column"]: r["levels"] for r in distinct_values(rows, members).collect()}
    pairs = []
    for name, group in groups.items():
        ordered = sorted(group, key=lambda c: (-levels.get(c, 0), c))
        pairs += [(name, c, ordered[0]) for c in ordered]
    number = lambda c: F.col(c).cast("double")
    # A representative is not held against itself.
    cells = [
        F.struct((F.lit(None).cast("double") if c == r else number(c)).alias("own"), number(r).alias("other"))
        for _, c, r in pairs
    ]
    names = [F.get(F.array(*[F.lit(x) for x in side]), F.col("_place")) for side in zip(*pairs)]
    found = (
        _placed(rows, cells)
        .groupBy("_place")
        .agg(F.corr("_cell.own", "_cell.other").alias("correlation"))
        .select(*[c.alias(n) for n, c in zip(("family", "column", "representative"), names)], "correlation")
    )
    return found.withColumn("redundant", F.coalesce(F.abs("correlation") >= F.lit(least), F.lit(False)))


def segment_qualification(
    rows: DataFrame,
    columns: Sequence[str],
    *,
    segment: str = PRODUCT,
    floor: float = 0.60,
    max_drop: float = 0.08,
    label: str = LABEL,
) -> DataFrame:
    """Per column and segment: ranking power pooled and within, ignoring direction.

    ``hollow`` marks a column whose pooled power is above the floor and falls by more than
    ``max_drop`` inside the segment. Power is NULL where a class is absent: not measurable.
    """
    store = counted_cells(rows, columns, segment=segment, label=label)
    return segment_qualification_of(store, floor=floor, max_drop=max_drop)


def segment_qualification_of(store: DataFrame, *, floor: float = 0.60, max_drop: float = 0.08) -> DataFrame:
    power = F.greatest(F.col("roc_auc"), F.lit(1.0) - F.col("roc_auc"))
    pooled = ranking_metrics(store, "value", "label", weight="n", by=["column"]).select("column", power.alias("pooled"))
    within = ranking_metrics(store.where(F.col("segment").isNotNull()), "value", "label", weight="n", by=["column", "segment"])
    hollow = (F.col("pooled") >= F.lit(floor)) & (F.col("pooled") - F.col("within") > F.lit(max_drop))
    return (
        within.select("column", "segment", "rows", power.alias("within"))
        .join(pooled, "column")
        .select("column", "segment", "rows", "pooled", "within", F.coalesce(hollow, F.lit(False)).alias("hollow"))
    )


# ---- verdicts --------------------------------------------------------------------------------


def as_rejections(found: DataFrame, check: str, precedence: int, value: Column, unit: Column | None = None) -> DataFrame:
    return found.select(
        F.lit(precedence).alias("precedence"),
        F.lit(check).alias("check"),
        F.lit("timeward").alias("tool"),
        "column",
        value.cast("double").alias("value"),
        (F.lit("column") if unit is None else unit).alias("unit"),
    )


def time_rejections(found: DataFrame, *, families: DataFrame | None = None, precedence: int = 0) -> DataFrame:
    """Inverted columns; with ``families``, every member of a family that holds one."""
    bad = found.where("inverted")
    if families is None:
        return as_rejections(bad, "time_consistency", precedence, F.col("delta"))
    hit = bad.join(families, "column").select("family").distinct()
    members = families.join(hit, "family").join(found.select("column", "delta"), "column")
    unit = F.concat(F.lit("block:"), F.col("family"))
    return as_rejections(members, "time_consistency", precedence, F.col("delta"), unit)


def shift_rejections(
    found: DataFrame, *, threshold: float, reject_degenerate: bool = False, precedence: int = 1
) -> DataFrame:
    moved = F.coalesce(F.col("psi") > F.lit(threshold), F.lit(False))
    bad = moved | F.col("degenerate") if reject_degenerate else moved
    return as_rejections(found.where(bad), "distribution_shift", precedence, F.col("psi"))


def redundancy_rejections(found: DataFrame, *, precedence: int = 2) -> DataFrame:
    return as_rejections(found.where("redundant"), "redundancy", precedence, F.col("correlation"))


def segment_rejections(
    found: DataFrame, *, reject: bool = False, reject_unmeasurable: bool = False, precedence: int = 3
) -> DataFrame:
    """Hollow columns of the largest segment, if the policy rejects on them at all."""
    largest = found.groupBy("segment").agg(F.max("rows").alias("_n")).agg(F.max_by("segment", "_n").alias("_s"))
    inside = found.crossJoin(F.broadcast(largest)).where(F.col("segment") == F.col("_s"))  # one row
    bad = F.col("hollow")
    if reject_unmeasurable:
        bad = bad | F.col("within").isNull()
    return as_rejections(
        inside.where(bad & F.lit(reject)),
        "segment_qualification",
        precedence,
        F.col("pooled") - F.col("within"),
    )


def run_audits(
    rows: DataFrame,
    columns: Sequence[str],
    policy: Policy,
    *,
    groups: Mapping[str, Sequence[str]] | None = None,
    label: str = LABEL,
) -> DataFrame:
    """The rejections of every audit the policy enables, in order of precedence.

    ``groups`` are families of columns that carry one signal, from a partition file or from
    :func:`missing_families`; without them there is nothing to call redundant and no family to
    reject as a whole.
    """
    store = counted_cells(
        rows,
        columns,
        train=policy.train_window,
        holdout=policy.holdout_window,
        segment=policy.segment_column if policy.segment_enabled else None,
        label=label,
    )
    found = []
    if policy.enabled("time_consistency"):
        families = None
        if policy.reject_by_block and groups:
            pairs = [(c, g) for g, members in groups.items() for c in members]
            families = rows.sparkSession.createDataFrame(pairs, "column string, family string")
        result = time_consistency_of(store)
        found.append(time_rejections(result, families=families))
        if families is not None:
            lone = result.join(families, "column", "left_anti")
            found.append(time_rejections(lone))
    if policy.enabled("distribution_shift"):
        result = distribution_shift_of(store)
        found.append(
            shift_rejections(
                result, threshold=policy.psi_threshold, reject_degenerate=policy.reject_degenerate
            )
        )
    if policy.enabled("redundancy") and groups:
        found.append(redundancy_rejections(redundancy(rows, groups)))
    if policy.segment_enabled:
        result = segment_qualification_of(
            store, floor=policy.segment_pooled_floor, max_drop=policy.segment_max_drop
        )
        found.append(
            segment_rejections(
                result,
                reject=policy.segment_reject,
                reject_unmeasurable=policy.segment_reject_unmeasurable,
            )
        )
    if not found:
        return rows.sparkSession.createDataFrame([], REJECTIONS)
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


def to_fragments(rejections: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per check with its rejections nested, ready to be written as JSON.

    Every check in ``order`` gets a row, also one that rejected nothing.
    """
    spark = rejections.sparkSession
    checks = spark.createDataFrame([(i, c) for i, c in enumerate(order)], "precedence int, check string")
    nested = rejections.groupBy("check").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "column", "check", F.coalesce(F.col("value").cast("string"), F.lit("NA")).alias("value"), "unit"
                )
            )
        ).alias("rejections")
    )
    return checks.join(nested, "check", "left").select(
        "check",
        F.lit("timeward").alias("tool"),
        F.expr("map('precedence', cast(precedence as string))").alias("params"),
        F.expr("map('rejected', cast(coalesce(size(rejections), 0) as string))").alias("qualification"),
        F.coalesce(
            "rejections",
            F.expr("cast(array() as array<struct<column:string,check:string,value:string,unit:string>>)"),
        ).alias("rejections"),
    )
