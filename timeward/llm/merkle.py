"""A Merkle manifest of a dataset: one tree per group, and one over the groups' roots.

Nodes carry the interval of leaf ranks that they cover, so ancestry is containment: a node's parent is the
node one level up whose interval holds its own, and its siblings cover what is left of the parent's interval.
The ranks come from one range partitioning. Levels are taken in bands: the nodes of a band lie in
buckets of ``run ** BAND`` members, so that building is one grouping per band, and a bucket is joined to
its ancestors once per band, not once per level or leaf. A bucket holds the digests of its nodes level by level, in the
order of their intervals, which begin at multiples of the level's width: an interval's difference is a stretch of
digests before and one after. Rows travel in their buckets and are joined to nothing one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column
from timeward.operators.lookups import small_side
from timeward.session import materialize

RUN = 2
# Levels per band: a bucket holds 256 nodes of a binary tree.
BAND = 8
# Groups up to this many are broadcast with the paths above them, about two kilobytes each.
_SMALL = 10_000
# monotonically_increasing_id keeps the partition above these bits and the place in it below.
_PLACE_BITS = 33

_STEP = "struct<before:string,after:string>"
_BYTES = 32  # of a digest


def digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields, one after another: ``-`` for a null, else the count of
    UTF-8 bytes, a colon and the value as text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def climb(digests: list[str], levels: int, run: int = RUN) -> list[list[str]]:
    """Digests of all nodes over these, which are neighbours in order, level by level; the first level is they themselves."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([_joined(below[at : at + run]) for at in range(0, len(below), run)])
    return out


def _climb_batches(run: int) -> Callable[[pa.Array, pa.Array], pa.Array]:
    def fold(buckets: pa.Array, levels: pa.Array) -> pa.Array:
        out = [
            [bytes.fromhex("".join(level)) for level in climb(digests, high, run)]
            for digests, high in zip(buckets.to_pylist(), levels.to_pylist())
        ]
        return pa.array(out, pa.list_(pa.binary()))

    return fold


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``rank`` (long, from 0, gapless within each ``tree``) and ``size``, the rows of the tree.

    One range partitioning and a sort within partitions; a tree may hold any share of the rows. What is broadcast
    has one row per partition.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(
        rows.repartitionByRange(parts, tree, *order)
        .sortWithinPartitions(tree, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked_leaves",
    )
    part, place = F.shiftright("_at", _PLACE_BITS), F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    runs = cut.groupBy(tree, part.alias("_part")).agg(
        F.count("*").alias("_n"), F.min(place).alias("_first"), F.max(place).alias("_last")
    )
    runs = materialize(runs, "tree_runs")
    # Partitions are no more than the session's shuffle partitions, so their sizes fit the driver.
    sizes = sorted((r["_part"], r["n"]) for r in runs.groupBy("_part").agg((F.max("_last") + 1).alias("n")).collect())
    starts, total = [], 0
    for number, n in sizes:
        starts.append((number, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    trees = (
        runs.join(offsets, "_part")
        .groupBy(tree)
        .agg(F.min(F.col("_start") + F.col("_first")).alias("_begin"), F.sum("_n").alias("size"))
    )
    placed = cut.withColumn("_part", part).join(offsets, "_part").join(small_side(trees, _SMALL), tree)
    return placed.withColumn("rank", F.col("_start") + place - F.col("_begin")).drop("_part", "_start", "_begin", "_at")


def _height(size: Column, run: int) -> Column:
    """Levels until one node is left."""
    spans = F.transform(F.sequence(F.lit(0), F.lit(62)), lambda k: F.pow(F.lit(float(run)), k))
    return F.size(F.filter(spans, lambda width: width < size))


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _bands(leaves: DataFrame, run: int) -> list[DataFrame]:
    """Bands from the lowest up: ``tree, bucket, span, members, nodes, left``. ``bucket`` is the first rank covered, ``span``
    the ranks that a member covers, ``nodes`` the digests of each level, ``left`` the levels above this band."""
    level = leaves.select("tree", F.col("rank").alias("lo"), "digest", "row", _height(F.col("size"), run).alias("left"))
    bands, span = [], 1
    while True:
        wide = span * run**BAND
        bucket = (F.col("lo") - F.pmod(F.col("lo"), F.lit(wide))).alias("bucket")
        grouped = level.groupBy("tree", bucket).agg(
            F.array_sort(F.collect_list(F.struct("lo", "digest", "row"))).alias("members"), F.first("left").alias("left")
        )
        levels = F.least(F.col("left"), F.lit(BAND))
        nodes = arrow_column(_climb_batches(run), "array<binary>")(F.col("members.digest"), levels)
        band = materialize(
            grouped.select(
                "tree", "bucket", F.lit(span).cast("bigint").alias("span"), nodes.alias("nodes"), (F.col("left") - levels).alias("left"),
                F.transform("members", lambda m: F.struct(m["lo"], m["row"])).alias("members"),
            ),
            "merkle_band",
        )
        bands.append(band)
        level = band.where("left > 0").select(
            "tree", F.col("bucket").alias("lo"), _text(F.element_at("nodes", -1)).alias("digest"), F.lit(None).alias("row"), "left"
        )
        if level.isEmpty():
            return bands
        span = wide


def _own_steps(index: Column, run: int) -> Column:
    """Siblings within the band, level by level, of a bucket's member by its place."""

    def step(digests: Column, level: Column) -> Column:
        place = F.floor(index / F.pow(F.lit(float(run)), level)).cast("int")
        first = place - F.pmod(place, F.lit(run))
        before = F.substring(digests, _BYTES * first + 1, _BYTES * (place - first))
        after = F.substring(digests, _BYTES * (place + 1) + 1, _BYTES * (first + run - 1 - place))
        return F.struct(_text(before).alias("before"), _text(after).alias("after"))

    # The last level is the node over them all; its siblings are the next band's.
    return F.transform(F.slice("nodes", 1, F.size("nodes") - 1), step)


def _tops(bands: list[DataFrame]) -> DataFrame:
    """``tree, top``: one row per tree, from the band in which it ends."""
    found = None
    for band in bands:
        ended = band.where("left = 0").select("tree", _text(F.element_at("nodes", -1)).alias("top"))
        found = ended if found is None else found.union(ended)
    return found


def _paths(bands: list[DataFrame], crown: DataFrame, run: int) -> DataFrame:
    """``row, steps`` and the columns of ``crown`` for every leaf. ``crown``: ``tree``, ``upper`` steps above the tree, and more."""
    above = None
    for number, band in reversed(list(enumerate(bands))):
        held = band
        if above is not None:
            held = held.join(above, ["tree", "bucket"], "left")
        elif number:
            held = held.withColumn("higher", F.lit(None).cast(f"array<{_STEP}>"))
        extra = []
        if not number:
            held = held.join(small_side(crown, _SMALL), "tree")
            extra = [c for c in crown.columns if c not in ("tree", "upper")]
        higher = [F.coalesce("higher", F.array().cast(f"array<{_STEP}>"))] if "higher" in held.columns else []
        each = held.select("*", F.explode("members").alias("member"))
        own = _own_steps(F.floor((F.col("member.lo") - F.col("bucket")) / F.col("span")), run)
        if number:
            above = each.withColumn("higher", F.concat(own, *higher)).select("tree", F.col("member.lo").alias("bucket"), "higher")
        else:
            return each.select("member.row", *extra, F.concat(own, *higher, F.col("upper")).alias("steps"))


def proof_digest(steps: Column) -> Column:
    """sha256 of all siblings' digests, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda low, s: F.sha2(F.concat(s["before"], low, s["after"]), 256))


def manifest(leaves: DataFrame, group: Column, order: list[str], leaf: str = "leaf", run: int = RUN) -> DataFrame:
    """Adds ``subroot, root, steps`` to every row of ``leaves``, whose digests are in column ``leaf``.

    Rows of one ``group`` (text) form a tree, in the order of the columns ``order``, nulls first, equal ones by digest;
    groups' roots form the upper tree in bytewise order, the null group first. ``steps`` lead from the leaf to
    ``root``: the siblings before and after, each as one text of digests; a lone leaf of a lone group has none. Repeated
    rows are leaves of their own. No rows give no rows. Columns named ``subroot, root, steps`` give way, others
    stay; rows are shuffled twice and lie in a task by the bucket, so leave long texts out.
    """
    made = {"subroot", "root", "steps"}
    own = [c for c in leaves.columns if c.lower() not in made]
    tree = F.coalesce(F.concat(F.lit("1"), group), F.lit("0"))
    # Columns travel in a struct, so that no name clashes with one of ours. The number tells equal rows apart.
    held = materialize(
        leaves.select(
            tree.alias("tree"),
            F.struct(*order).alias("key"),
            F.col(leaf).alias("digest"),
            F.struct(*own).alias("row"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "merkle_leaves",
    )
    bands = _bands(ranked(held, "tree", ["key", "digest", "number"]), run)
    tops = materialize(_tops(bands).select(F.lit("").alias("forest"), F.col("tree").alias("name"), F.col("top").alias("digest")), "subroots")
    groups = ranked(tops, "forest", ["name"]).withColumnRenamed("forest", "tree").withColumn("row", F.struct("name", "digest"))
    upper = _bands(groups, run)
    whole = _tops(upper).select("tree", F.col("top").alias("root"), F.array().cast(f"array<{_STEP}>").alias("upper"))
    crown = _paths(upper, whole, run).select(
        F.col("row.name").alias("tree"), F.col("row.digest").alias("subroot"), "root", F.col("steps").alias("upper")
    )
    return _paths(bands, materialize(crown, "crown"), run).select("row.*", "subroot", "root", "steps")
