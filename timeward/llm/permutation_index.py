"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots (Chavez et al., 2008), and posted under each of them
with its place in that order. A query walks the inverted files of its own nearest pivots, adds up
Spearman's footrule between the two orders, and ranks the nearest share of vectors again by the exact
inner product. Vectors lie in blocks with inverted files of their own, queries in blocks too; each task
takes one block of either, and the blocks' best are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeward.llm.text import settle
from timeward.session import materialize

# Pivots: the bounded sample that the index is fitted on; PREFIX of them represent a vector.
PIVOTS = 256
PREFIX = 48
# Of a block this share of vectors, nearest by footrule, is ranked again, and LEAST at least. On vectors
# without any structure (random directions in 64 dimensions) that finds over nine tenths of the true neighbours.
SHARE = 0.5
LEAST = 256
ROWS, QUERIES = 16384, 1024


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, embedding`` of the rows that take part: an id, and a vector that is not zero and has neither
    null nor non-finite components. Where sizes differ, shorter vectors are zero in what they lack."""
    v = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    )
    sizes = rows.agg(F.min(F.size(v)).alias("least"), F.max(F.size(v)).alias("most")).first()
    if sizes["least"] == sizes["most"]:
        return rows
    return rows.withColumn("embedding", F.concat(v, F.array_repeat(F.lit(0.0), F.lit(sizes["most"]) - F.size(v))))


def _orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Nearest pivots of each vector, nearest first, ties to the first pivot."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix].astype("<i2")


def _represent(pivots: np.ndarray, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch["embedding"].to_pylist(), "<f8").reshape(batch.num_rows, -1)
            orders = _orders(vectors, pivots, prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array([o.tobytes() for o in orders], pa.binary()),
                ],
                names=["vec_id", "vector", "pivots"],
            )

    return run


def build(rows: DataFrame, pivots: int = PIVOTS, prefix: int = PREFIX) -> DataFrame:
    """Index of ``rows`` (as ``usable`` gives them), every row: ``vec_id, vector, pivots, place`` (its number)."""
    settle(rows.sparkSession)
    # Different vectors, so that copies of one don't fill the prefixes.
    sample = rows.select("embedding").distinct().orderBy(F.xxhash64("embedding"), "embedding").limit(pivots)
    chosen = np.array([r["embedding"] for r in sample.select("embedding").collect()], float)
    if not len(chosen):
        chosen = np.zeros((1, 1))
    held = rows.mapInArrow(_represent(chosen, prefix), "vec_id long, vector binary, pivots binary")
    return materialize(held.withColumn("place", F.monotonically_increasing_id()), "index")


class _Files:
    """Inverted files of one block: under each pivot the vectors and their places in them."""

    def __init__(self, orders: np.ndarray):
        self.n, self.m = orders.shape
        flat = np.argsort(orders, axis=None, kind="stable")
        self.rows, self.places = flat // self.m, (flat % self.m).astype(np.int32)
        self.starts = np.searchsorted(orders.ravel()[flat], np.arange(orders.max() + 2))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Sum of differences of places over the query's pivots; a pivot that a vector lacks counts as last."""
        m = self.m
        total = np.full(self.n, m * (m + 1) // 2, np.int32)
        for i, p in enumerate(order):
            if p + 1 < len(self.starts):
                at = slice(self.starts[p], self.starts[p + 1])
                total[self.rows[at]] += np.abs(self.places[at] - i) - (m - i)
        return total


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k: int, share: float, least: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        ids, vectors = rows["vec_id"].to_numpy(), _matrix(rows["vector"], "<f8")
        files = _Files(_matrix(rows["pivots"], "<i2"))
        wanted = min(len(ids), max(least, int(np.ceil(share * len(ids)))))
        found = []
        for q, vector, order in zip(
            queries["vec_id"].to_pylist(), _matrix(queries["vector"], "<f8"), _matrix(queries["pivots"], "<i2")
        ):
            far = files.footrule(order)
            near = np.flatnonzero(far <= np.partition(far, wanted - 1)[wanted - 1])
            near = near[ids[near] != q]
            # One sum per row in the same order, so that equal vectors score alike.
            scores = (vectors[near] * vector).sum(axis=1)
            if len(near) > k:
                best = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                near, scores = near[best], scores[best]
            top = np.lexsort([ids[near], -scores])[:k]
            found.append((np.full(len(top), q), ids[near[top]], scores[top]))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    return run


def search(
    index: DataFrame, is_query: Column, k: int = 20, share: float = SHARE, least: int = LEAST,
    rows: int = ROWS, queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each id of ``index`` that
    ``is_query`` holds for; all others, if there are fewer. Ties go to the smaller id.

    Rows that bear the query's id are its own. An id that is repeated is one query, with its least vector,
    but as many candidates as it has rows. No rows or no queries give no rows.
    """
    asked = materialize(
        index.where(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "pivots", "place")).alias("q")).select(
            "vec_id", "q.*"
        ),
        "queries",
    )
    n, m = index.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n // rows)), max(1, -(-m // queries))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    deal = lambda count: F.pmod(F.xxhash64("place"), F.lit(count)).cast("int")
    left = index.select("vec_id", "vector", "pivots", deal(row_blocks).alias("row_block"), every(query_blocks).alias("query_block"))
    right = asked.select("vec_id", "vector", "pivots", every(row_blocks).alias("row_block"), deal(query_blocks).alias("query_block"))
    keys = ["row_block", "query_block"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_search(k, share, least), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
