"""SimHash near-duplicates: every pair of fingerprints is compared exactly, tile by tile.

Distinct fingerprints are dealt into tiles by their population count. Two fingerprints at a
distance of at most the radius differ by at most the radius in population count, so only tiles
whose counts are that close meet, by an equi-join on the tile. Inside a pair of tiles numpy's
exclusive-or and bit counts compare sub-tiles; those whose population counts of the four 16-bit
quarters lie further apart than the radius are skipped. A pair of tiles returns a spanning forest
of its links, never all pairs, so that a large group of near copies costs no more rows than it has
members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.llm.components import components
from timeward.llm.text import arrow_column, as_bytes, fresh, settle
from timeward.session import materialize

RADIUS = 3
TILE = 65536
_SUB = 64
_STEP = 512
_SHINGLES_AT_ONCE = 65536


def _simhash(raw: bytes) -> int:
    from xxhash import xxh64_intdigest

    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    hashes = np.array([xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[k : k + _SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _simhashes(texts: pa.Array) -> pa.Array:
    return pa.array([_simhash(x) for x in as_bytes(texts)], pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the 64-bit SimHash of the 3-word shingles of ``text`` as a signed long.

    A-Z are lower-cased; shingles repeat; a shorter text is one shingle; no words give 0.
    """
    return docs.withColumn(out, arrow_column(_simhashes, "long")(F.col(text)))


class _Sets:
    """Disjoint sets over 0..n-1, joined in bulk."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        return self.parent

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            root = self.roots()
            i, j = root[i], root[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))


def _quarters(fps: np.ndarray) -> np.ndarray:
    parts = fps.view(np.uint16).reshape(-1, 4)
    return np.bitwise_count(parts).astype(np.int8)


class _Tile:
    """Fingerprints sorted by quarter counts, with the range of each count per sub-tile."""

    def __init__(self, fps: np.ndarray):
        counts = _quarters(fps)
        order = np.lexsort(counts.T[::-1])
        self.fps, counts = fps[order], counts[order]
        starts = np.arange(0, len(fps), _SUB)
        self.low = np.minimum.reduceat(counts, starts)
        self.high = np.maximum.reduceat(counts, starts)
        self.at = np.minimum(starts[:, None] + np.arange(_SUB), len(fps) - 1)


def _near(a: _Tile, b: _Tile, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that are linked in that pair of tiles, as a spanning forest."""
    gap = np.zeros((len(a.low), len(b.low)), np.int16)
    for q in range(4):
        over = a.low[:, q, None] - b.high[None, :, q]
        under = b.low[None, :, q] - a.high[:, q, None]
        gap += np.maximum(np.maximum(over, under), 0)
    close = gap <= radius
    if same:
        close = np.triu(close)
    rows, columns = np.nonzero(close)
    sets = _Sets(len(a.fps) if same else len(a.fps) + len(b.fps))
    shift = 0 if same else len(a.fps)
    for k in range(0, len(rows), _STEP):
        at, to = a.at[rows[k : k + _STEP]], b.at[columns[k : k + _STEP]]
        apart = np.bitwise_count(a.fps[at][:, :, None] ^ b.fps[to][:, None, :])
        s, i, j = np.nonzero(apart <= radius)
        if len(s):
            sets.join(at[s, i], to[s, j] + shift)
    root = sets.roots()
    child = np.flatnonzero(root != np.arange(len(root)))
    return child, root[child]


def _link_tiles(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch["same"][r].as_py()
                left = _Tile(batch["left"][r].values.to_numpy().view(np.uint64))
                right = left if same else _Tile(batch["right"][r].values.to_numpy().view(np.uint64))
                child, root = _near(left, right, radius, same)
                fps = (left.fps if same else np.concatenate([left.fps, right.fps])).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[child]), pa.array(fps[root])], names=["a", "b"]
                )

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints ``fp`` that connect exactly those whose
    distance chain stays within ``radius``. No fingerprints give no edges."""
    counted = prints.groupBy(F.bit_count("fp").alias("ones"))
    largest = counted.agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    parts = max(1, -(-largest // tile))
    tiles = materialize(
        prints.groupBy(
            F.bit_count("fp").alias("ones"), F.pmod(F.xxhash64("fp"), F.lit(parts)).alias("part")
        ).agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    left = (
        tiles.select("ones", "part", F.col("fps").alias("left"))
        .withColumn("right_ones", F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)))
        .withColumn("right_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .where("right_ones > ones OR right_part >= part")
    )
    right = tiles.select(
        F.col("ones").alias("right_ones"), F.col("part").alias("right_part"), F.col("fps").alias("right")
    )
    same = (F.col("ones") == F.col("right_ones")) & (F.col("part") == F.col("right_part"))
    pairs = left.join(right, ["right_ones", "right_part"]).select(
        "left", F.when(~same, F.col("right")).alias("right"), same.alias("same")
    )
    return pairs.mapInArrow(_link_tiles(radius), "a long, b long")


def classes(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``fp, root, component_id`` for each distinct ``fp`` of ``prints`` (``doc_id, fp``): the least
    fingerprint of its component and the smallest doc_id, null if none of its documents has one."""
    settle(prints.sparkSession)
    unique = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = components(links(unique, radius, tile))
    rooted = unique.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs`` (``doc_id, text``).

    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows stay.
    """
    settle(docs.sparkSession)
    prints = with_fingerprint(docs.select("doc_id", "text"), out="fp").select("doc_id", "fp")
    prints = materialize(prints, "fingerprints")
    named = materialize(classes(prints, radius, tile), "classes")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest
    doc_id; of repeated rows with that id one. All columns stay; the order does not.

    Null ids lose against any id; a component without ids keeps one of its rows.
    """
    settle(docs.sparkSession)
    fp, row_id = fresh(docs, "fp"), F.col("doc_id")
    printed = with_fingerprint(docs, out=fp)
    # Fingerprints are taken once for the classes and again for the rows that stay: cheaper than
    # writing every text a second time.
    prints = materialize(printed.select("doc_id", F.col(fp).alias("fp")), "fingerprints")
    named = classes(prints, radius, tile)
    best = (
        prints.groupBy("doc_id", "fp")
        .agg(F.count("*").alias("n"))
        .join(named, "fp")
        .where(row_id.eqNullSafe(F.col("component_id")))
        .groupBy("root", row_id.alias("best_id"))
        .agg(F.min("fp").alias("best_fp"))
        .drop("root")
    )
    kept = printed.join(
        materialize(best, "best"),
        row_id.eqNullSafe(F.col("best_id")) & (F.col(fp) == F.col("best_fp")),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", fp]).select(docs.columns)
