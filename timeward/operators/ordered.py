"""Running totals, ranks and exact quantiles over a whole table's order.

A window without a partition key would pull the table into one task. Rows are first reduced to
one record per distinct value. Beyond a counted number of records the value axis is cut into
ranges, running totals are taken inside each range, and the totals of the earlier ranges are
joined on. The cuts only steer how evenly the work spreads; the result does not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeward.session import materialize

# Up to this many records, one sorted task beats ranges and a join.
WHOLE_BELOW = 100_000
# Records that one task sorts once the axis is cut.
PER_RANGE = 1_000_000
_LEAST_RANGES = 16
# Hash digits that fit a signed 64-bit integer.
_HASH_DIGITS = 15


def ranges_for(records: int) -> int:
    """As many ranges as leave about PER_RANGE records to each, so that tasks stay alike at any size."""
    return max(_LEAST_RANGES, -(-records // PER_RANGE))


def _more_than_one_task(values: DataFrame) -> int:
    """The number of records, or 0 if they fit one task. Of a written table only footers are read."""
    records = values.count()
    return 0 if records <= WHOLE_BELOW else records


def cut_points(values: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Range edges from approximate quantiles: one number per range on the driver.

    None at all when the counted records fit one task.
    """
    records = _more_than_one_task(values)
    if not records:
        return []
    ranges = ranges or ranges_for(records)
    fractions = [i / ranges for i in range(1, ranges)]
    return sorted(set(values.approxQuantile(column, fractions, 1.0 / (4 * ranges))))


def with_range(values: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Adds ``_range``, non-decreasing in ``column``; NaN, which sorts last, has the last one."""
    splits = [float("-inf"), *edges, float("inf")]
    slicer = Bucketizer(splits=splits, inputCol="_axis", outputCol="_range", handleInvalid="keep")
    placed = values.withColumn("_axis", F.col(column).cast("double"))
    return slicer.transform(placed).withColumn("_range", F.col("_range").cast("int")).drop("_axis")


def with_range_by(values: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Adds ``_range`` as above, with edges of each group's own: groups may lie on different scales."""
    axis = F.col(column).cast("double")
    sizes = values.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    ranges = ranges_for(largest)
    fractions = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    real = F.when(~F.isnan(axis), axis)
    edges = values.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(
        F.percentile_approx(real, fractions, F.lit(4 * ranges)).alias("_edges")
    )
    match = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    found = F.aggregate(
        F.sequence(F.lit(0), F.lit(ranges.bit_length())),
        F.struct(F.lit(0).alias("low"), F.lit(ranges - 1).alias("high")),
        lambda at, _: _halved(at, axis),
        lambda at: at["low"],
    )
    return values.join(edges, match).withColumn("_range", F.coalesce(found, F.lit(0))).drop(
        "_edges", *[f"_g_{c}" for c in by]
    )


def _halved(at: Column, axis: Column) -> Column:
    """One step of a binary search for the number of edges at or below a value."""
    middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
    above = axis >= F.get(F.col("_edges"), middle)
    open_ = at["low"] < at["high"]
    return F.struct(
        F.when(open_ & above, middle + 1).otherwise(at["low"]).alias("low"),
        F.when(open_ & ~above, middle).otherwise(at["high"]).alias("high"),
    )


def running_totals(
    rows: DataFrame,
    order: str,
    sums: dict[str, Column],
    *,
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """One record per distinct (``by``, ``order``) with each sum, the sum up to and including
    the value (``cum_``) and the sum over the group (``all_``). Rows with a NULL order drop out.

    Ties share a record, so every quantity built on this is tie-aware. NaN is the largest value.
    """
    by = list(by)
    values = (
        rows.where(F.col(order).isNotNull())
        .groupBy(*by, order)
        .agg(*[c.alias(n) for n, c in sums.items()])
    )
    if edges is None:
        # Counting, cutting and adding up read the records, not the rows that they were reduced from.
        values = materialize(values, "records")
    return accumulate(
        values, order, list(sums), by=by, descending=descending, ranges=ranges, edges=edges
    )


def accumulate(
    values: DataFrame,
    order: str,
    names: Sequence[str],
    *,
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """As :func:`running_totals`, for input that already holds one record per value."""
    by = list(by)
    if edges is None and by:
        # Groups are sorted side by side; only a large one needs ranges.
        sizes = values.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        if (sizes.agg(F.max("_n")).first()[0] or 0) > WHOLE_BELOW:
            return _accumulate_ranges(with_range_by(values, order, by), order, names, by, descending)
        edges = []
    if edges is None:
        edges = cut_points(values, order, ranges)
    if not edges:
        return _accumulate_whole(values, order, names, by, descending)
    return _accumulate_ranges(with_range(values, order, edges), order, names, by, descending)


def _accumulate_whole(
    values: DataFrame, order: str, names: Sequence[str], by: list[str], descending: bool
) -> DataFrame:
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = group.orderBy(F.col(order).desc() if descending else F.col(order).asc())
    upto = upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return values.withColumns(
        {
            **{f"all_{n}": F.sum(n).over(group) for n in names},
            **{f"cum_{n}": F.sum(n).over(upto) for n in names},
        }
    )


def _accumulate_ranges(
    placed: DataFrame, order: str, names: Sequence[str], by: list[str], descending: bool
) -> DataFrame:
    span = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = span.orderBy(F.col("_range").desc() if descending else F.col("_range"))
    earlier = earlier.rangeBetween(Window.unboundedPreceding, -1)
    # One record per group and range from here to the join.
    offsets = (
        placed.groupBy(*by, "_range")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *by,
            "_range",
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names],
            *[F.sum(n).over(span).alias(f"all_{n}") for n in names],
        )
    )
    keys = [*by, "_range"]
    match = [placed[k].eqNullSafe(offsets[k]) for k in keys]
    joined = placed.join(offsets, match, "inner").select(
        placed["*"], *[offsets[f"_o_{n}"] for n in names], *[offsets[f"all_{n}"] for n in names]
    )
    inside = (
        Window.partitionBy(*keys)
        .orderBy(F.col(order).desc() if descending else F.col(order).asc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return joined.withColumns(
        {f"cum_{n}": F.col(f"_o_{n}") + F.sum(n).over(inside) for n in names}
    ).drop("_range", *[f"_o_{n}" for n in names])


def totals_as_of(
    records: DataFrame,
    points: DataFrame,
    order: str,
    names: Sequence[str],
    *,
    descending: bool = False,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """An as-of merge: each distinct value of ``points``' only column, with ``cum_`` sums over the records up to and
    including it (``descending``: from it on) and ``all_`` sums.

    Both sides are laid into one order and totals run along it, across ranges where there are many: any number of
    records meets any number of points without being compared to them. NULLs drop out; NaN is the largest value.
    """
    here = points.select(F.col(points.columns[0]).cast("double").alias("_at"), *[F.lit(0).alias(n) for n in names], F.lit(True).alias("_point"))
    there = records.select(F.col(order).cast("double").alias("_at"), *names, F.lit(False).alias("_point"))
    both = (
        there.unionByName(here)
        .where(F.col("_at").isNotNull())
        .groupBy("_at")
        .agg(*[F.sum(n).alias(n) for n in names], F.bool_or("_point").alias("_point"))
    )
    if edges is None:
        both = materialize(both, "merged")
    merged = accumulate(both, "_at", names, descending=descending, edges=edges)
    return merged.where("_point").select(
        F.col("_at").alias(points.columns[0]), *[f"cum_{n}" for n in names], *[f"all_{n}" for n in names]
    )


def with_next(
    values: DataFrame, order: str, columns: Sequence[str], output: str, *, descending: bool = False, edges: Sequence[float] | None = None
) -> DataFrame:
    """Adds ``output``, a struct of the ``columns`` of the next record in the order; NULL for the last one.

    ``values`` holds one record per value. Inside a range the neighbour is the next row; the first record of each range
    is handed to the last one of the range before it, whatever ranges between them are empty.
    """
    along = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    held = F.struct(*columns)
    if edges is None:
        edges = cut_points(values, order)
    if not edges:
        return values.withColumn(output, F.lead(held).over(Window.partitionBy(F.lit(0)).orderBy(along(order))))
    placed = with_range(values, order, edges)
    inside = F.lead(held).over(Window.partitionBy("_range").orderBy(along(order)))
    first = F.max_by(held, order) if descending else F.min_by(held, order)
    # One record per range from here to the join.
    handed = placed.groupBy("_range").agg(first.alias("_first")).select(
        F.col("_range").alias("_to"), F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy(along("_range"))).alias("_handed")
    )
    joined = placed.withColumn(output, inside).join(F.broadcast(handed), F.col("_range") == F.col("_to"))
    return joined.withColumn(output, F.coalesce(output, "_handed")).drop("_range", "_to", "_handed")


def exact_quantiles(
    rows: DataFrame, column: str, fractions: Sequence[float], *, by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles: ``by``, ``fraction_index``, ``fraction``, ``value``."""
    counted = running_totals(rows, column, {"n": F.count(F.lit(1))}, by=by)
    return quantiles_of(counted, column, fractions, by=by)


def quantiles_of(
    counted: DataFrame, column: str, fractions: Sequence[float], *, by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`exact_quantiles`, of records with ``n``, ``cum_n`` and ``all_n`` in ascending order.

    Each value picks the ranks that land on it, so no task holds a table of values.
    """
    by = list(by)
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("fraction_index"), F.lit(float(q)).alias("fraction"))
            for i, q in enumerate(fractions)
        ]
    )
    position = lambda f: f["fraction"] * (F.col("all_n") - F.lit(1))
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - F.lit(1)
    hit = lambda rank: (rank >= first) & (rank <= last)
    picked = counted.select(
        *by,
        F.col(column).cast("double").alias("_value"),
        F.explode(
            F.transform(
                F.filter(
                    wanted,
                    lambda f: hit(F.floor(position(f))) | hit(F.ceil(position(f))),
                ),
                lambda f: F.struct(
                    f["fraction_index"].alias("fraction_index"),
                    f["fraction"].alias("fraction"),
                    hit(F.floor(position(f))).alias("low"),
                    hit(F.ceil(position(f))).alias("high"),
                    (position(f) - F.floor(position(f))).alias("part"),
                ),
            )
        ).alias("_f"),
    )
    low = F.max(F.when(F.col("_f.low"), F.col("_value")))
    high = F.max(F.when(F.col("_f.high"), F.col("_value")))
    return (
        picked.groupBy(
            *by,
            F.col("_f.fraction_index").alias("fraction_index"),
            F.col("_f.fraction").alias("fraction"),
        )
        .agg(low.alias("_low"), high.alias("_high"), F.max("_f.part").alias("_part"))
        .select(
            *by,
            "fraction_index",
            "fraction",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("value"),
        )
    )


def seeded_hash(seed: int, *columns: str) -> Column:
    """A hash that depends on the values and the seed alone, never on partitioning."""
    parts = [F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]]
    return F.sha2(F.concat_ws("|", *parts), 256)


def hash_rank(rows: DataFrame, key: str, seed: int, *, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank`` (from 1) and ``group_rows``: the position of each row in hash order.

    ``key`` must be unique within ``by``. Hashes are uniform, so even ranges of the leading digits
    balance the work; their number follows from the number of rows.
    """
    by = list(by)
    width = 16**_HASH_DIGITS // ranges_for(rows.count())
    digits = F.conv(F.substring(F.col("_hash"), 1, _HASH_DIGITS), 16, 10).cast("bigint")
    placed = (
        rows.withColumn("_hash", seeded_hash(seed, key))
        .withColumn("_range", (digits / F.lit(width)).cast("int"))
    )
    counts = placed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    span = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = span.orderBy("_range").rangeBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by,
        "_range",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(span).alias("group_rows"),
    )
    keys = [*by, "_range"]
    inside = Window.partitionBy(*keys).orderBy("_hash", key)
    joined = placed.join(offsets, [placed[k].eqNullSafe(offsets[k]) for k in keys], "inner").select(
        placed["*"], offsets["_offset"], offsets["group_rows"]
    )
    return joined.withColumn("rank", F.col("_offset") + F.row_number().over(inside)).drop(
        "_hash", "_range", "_offset"
    )
