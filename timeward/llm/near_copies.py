"""Near copies by shingles: texts are linked from a Jaccard similarity of word shingles on.

Candidates come from min-hashes in bands: texts that share a band are joined to the least text of it,
and the components of those edges hold every pair that shares any band. Inside such a group sets of
shingles are compared exactly, so bands decide only what is compared. At a similarity of 0.8 a pair shares
none of the bands with a chance of 8 in a million, and with less than that above.

With a ``radius`` the SimHash tiles of :mod:`timeward.llm.simhash` link texts as well: every pair of fingerprints that
lie that close, whatever their shingles share.

Groups are cut into tiles by the bytes of their sets; a pair of tiles returns a spanning forest of its
links, never all pairs, so that a large group of near copies costs no more rows than its members and tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.llm import simhash
from timeward.llm.components import components
from timeward.llm.simhash import _LOWER
from timeward.llm.text import arrow_column, as_bytes, fresh, settle
from timeward.session import materialize

WIDTH = 5
SIMILARITY = 0.8
# 1 - (1 - 0.8^7)^50 = 0.999992 of the pairs at 0.8 share a band.
BANDS, BAND = 50, 7
TILE_BYTES = 1 << 21
_AT_ONCE = 4096
_draw = np.random.default_rng(17).integers(0, 2**64, (2, BANDS * BAND), np.uint64)
_FACTORS, _MASKS = _draw[0] | np.uint64(1), _draw[1]
_MIX = np.random.default_rng(18).integers(0, 2**64, BAND, np.uint64) | np.uint64(1)


def _shingles(raw: bytes, width: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted. A shorter text is one shingle; no words give none."""
    from xxhash import xxh64_intdigest

    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    made = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.array([xxh64_intdigest(s, 42) for s in made], np.uint64))


def _bands(hashes: np.ndarray) -> np.ndarray:
    """One number per band; texts without words share all of theirs."""
    least = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for k in range(0, len(hashes), _AT_ONCE):
        mixed = (hashes[None, k : k + _AT_ONCE] ^ _MASKS[:, None]) * _FACTORS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    rows = (least >> np.uint64(8)).reshape(BANDS, BAND) * _MIX
    keys = rows.sum(axis=1, dtype=np.uint64)
    keys = (keys ^ (keys >> np.uint64(29)) ^ np.arange(BANDS, dtype=np.uint64)) * _FACTORS[0]
    return keys.view(np.int64)


def _sketches(width: int) -> Callable[[pa.Array], pa.Array]:
    def run(texts: pa.Array) -> pa.Array:
        keys = [_bands(_shingles(raw, width)) for raw in as_bytes(texts)]
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(flat))

    return run


def _sets(width: int) -> Callable[[pa.Array], pa.Array]:
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_shingles(raw, width).tobytes() for raw in as_bytes(texts)], pa.binary())

    return run


def _forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges that connect exactly what chains of pairs from ``similarity`` on connect.

    Each set in turn meets those that nothing has reached yet, so a close group takes one round.
    """
    sizes = np.array([len(s) for s in sets])
    flat, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marked = np.zeros(len(flat), bool)
    left, edges, waiting = np.arange(len(sets)), [], []
    while len(left):
        if waiting:
            at = waiting.pop()
        else:
            at, left = left[0], left[1:]
        own = codes[starts[at] : ends[at]]
        near = left[(sizes[left] >= similarity * sizes[at]) & (similarity * sizes[left] <= sizes[at])]
        if not len(near):
            continue
        if sizes[at] == 0:
            found = near
        else:
            marked[own] = True
            total = sizes[near]
            firsts = np.cumsum(total) - total
            places = np.repeat(starts[near] - firsts, total) + np.arange(total.sum())
            shared = np.add.reduceat(marked[codes[places]], firsts, dtype=np.int64)
            marked[own] = False
            found = near[shared >= similarity * (sizes[at] + total - shared) - 1e-9]
        edges += [(int(at), int(x)) for x in found]
        waiting += found.tolist()
        left = np.setdiff1d(left, found, assume_unique=True)
    return edges


def _compare(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                rows = [x for side in ("left", "right") for x in batch[side][r].as_py() or ()]
                keys = np.array([x["key"] for x in rows], np.int64)
                edges = _forest([np.frombuffer(x["shingles"], np.uint64) for x in rows], similarity)
                a, b = keys[np.array(edges, np.int64).reshape(-1, 2)].T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(texts: DataFrame, groups: DataFrame, width: int, similarity: float, tile: int = TILE_BYTES) -> DataFrame:
    """Edges ``a, b`` between the keys of ``texts`` (``key, text``, one row per key) that connect exactly what
    chains of similar pairs connect inside the groups (``key, root``)."""
    sets = materialize(
        texts.join(groups, "key").select("key", "root", arrow_column(_sets(width), "binary")("text").alias("shingles")), "sets"
    )
    parts = sets.groupBy("root").agg(F.ceil(F.sum(F.octet_length("shingles") + 16) / tile).cast("int").alias("parts"))
    tiles = materialize(
        sets.join(parts, "root")
        .withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
        .groupBy("root", "parts", "part")
        .agg(F.collect_list(F.struct("key", "shingles")).alias("left")),
        "tiles",
    )
    nothing = F.lit(None).cast(tiles.schema["left"].dataType)
    alone = tiles.select("left", nothing.alias("right"))
    several = tiles.where("parts > 1")
    right = several.select("root", F.col("part").alias("other"), F.col("left").alias("right"))
    later = F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1))
    across = several.where("part < parts - 1").select("root", "left", later.alias("other")).join(right, ["root", "other"])
    return alone.unionByName(across.select("left", "right")).mapInArrow(_compare(similarity), "a long, b long")


def fingerprint_links(prints: DataFrame, radius: int, tile: int = simhash.TILE) -> DataFrame:
    """Edges ``a, b`` between keys of ``prints`` (``key, fp``) that connect exactly what chains of fingerprints within
    ``radius`` connect. Each fingerprint is stood for by its least key."""
    least = materialize(prints.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    alike = prints.join(least, "fp").where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    close = simhash.links(least.select("fp"), radius, tile)
    for end in ("a", "b"):
        close = close.join(least.select(F.col("fp").alias(end), F.col("least").alias(f"key_{end}")), end)
    return alike.unionByName(close.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))


def one_of_each(
    docs: DataFrame,
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    tile: int = TILE_BYTES,
    radius: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text``) without near copies: of each group that chains of pairs from
    ``similarity`` on, or with a ``radius`` of pairs of fingerprints within it, connect the row with the smallest doc_id; of repeated rows with that id one. All
    columns stay; the order does not.

    A-Z are lower-cased. Null, empty and blank texts are alike. Null ids lose against any id; a group
    without ids keeps one of its rows. Texts are told apart by 64-bit hashes.
    """
    settle(docs.sparkSession)
    name, best_id, best_key = (fresh(docs, n) for n in ("text_key", "best_id", "best_key"))
    keyed = docs.withColumn(name, F.xxhash64(F.coalesce("text", F.lit(""))))
    sketch = [F.col(name).alias("key"), arrow_column(_sketches(width), "array<long>")("text").alias("bands")]
    printed = keyed
    if radius is not None:
        fp = fresh(keyed, "fp")
        printed = simhash.with_fingerprint(keyed, out=fp)
        sketch.append(F.col(fp).alias("fp"))
    held = materialize(printed.select("doc_id", *sketch), "sketches")
    banded = held.select("key", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("key").alias("b"), F.max("key").alias("last")).where("b < last").drop("last")
    close = banded.join(least, "band").where("key <> b").select(F.col("key").alias("a"), "b").distinct()
    groups = materialize(components(close).select(F.col("node").alias("key"), "root"), "groups")
    texts = keyed.select(F.col(name).alias("key"), "text").join(groups, "key", "left_semi").dropDuplicates(["key"])
    linked = links(texts, groups, width, similarity, tile)
    if radius is not None:
        linked = linked.unionByName(fingerprint_links(held.select("key", "fp"), radius))
    found = components(linked).withColumnRenamed("node", "key")
    ids = held.groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    best = (
        ids.join(found, "key", "left")
        .groupBy(F.coalesce("root", "key").alias("root"))
        .agg(F.min_by(F.struct("doc_id", "key"), F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("best"))
        .select(F.col("best.doc_id").alias(best_id), F.col("best.key").alias(best_key))
    )
    kept = keyed.join(
        materialize(best, "best"),
        F.col("doc_id").eqNullSafe(F.col(best_id)) & (F.col(name) == F.col(best_key)),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", name]).select(docs.columns)
