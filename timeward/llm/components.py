"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(rows: DataFrame) -> DataFrame:
    """Adds to each row ``a, b`` the least of ``a`` and all its ``b``."""
    least = rows.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return rows.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    rows = _with_least(_both_ways(edges))
    return rows.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = _with_least(down)
    own = rows.select("a", F.col("m").alias("b"))
    rest = rows.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.union(rest)


def _digest(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, longs); the root is the least node of
    its component. Only counts come to the driver; every round is a table in the shared folder.

    The number of rounds grows with the logarithm of the number of nodes. Edges between a node and
    itself and null ends are ignored; no edges give no rows.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _digest(edges)
    for _ in range(most_rounds if before[0] else 0):
        edges = materialize(_small_star(_large_star(edges)).distinct(), "stars")
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
