"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are indexed in blocks, as they lie. A block's grid has its terms as rows, the most frequent first, and its
documents as columns, the shortest first. A cell is cut into quadrants until it holds one posting; it stores the
largest impact inside (Brisaboa et al., 2014). Only cells that hold something exist: an inner cell has a nibble
that says which quadrants do, and cells follow each other level by level, so that counting bits finds a child.

A query's terms descend together: a range of documents has one cell per term's row, and the sum of the weighted
maxima bounds what a document of the range can score. Ranges are opened in the order of their bounds, some at a
time, until no bound reaches the last of the best documents that the task has found.
"""

from __future__ import annotations

import heapq
import itertools
import math
import string
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeward.llm.text import as_bytes, ascii_lower, settle
from timeward.session import materialize, scratch_path

# Terms: ASCII letters and digits and everything beyond ASCII; A-Z count as a-z.
_KEPT = string.ascii_letters + string.digits
_FOLD = bytes(ord(chr(b).lower()) if chr(b) in _KEPT else 32 for b in range(128)) + bytes(range(128, 256))
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A block ends with the document that brings it to one of these: a task holds one block at a time.
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 1 << 14
# Bytes of one text that are cut into terms at a time.
_SLICE = 4 << 20
# Document ranges that are opened at a time.
_OPENED = 256
# Bytes of item texts searched in one pass over the index; more items take more passes.
ITEM_BYTES = 16 << 20
# Documents that a task keeps in one pass, over all items; as above.
HITS = 1 << 20
# Rows that a task hands on at a time.
_ROWS = 10_000
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_BLOCK = (
    "docs array<bigint>, terms binary, frequencies binary, depth int, nibbles binary, best binary, rows binary, columns binary"
)
_BITS = np.array([bin(k).count("1") for k in range(16)], np.uint8)


@dataclass(frozen=True)
class Index:
    """Blocks in the shared folder, and over all documents: those with a term, and their terms with repeats."""

    blocks: DataFrame
    documents: int
    terms: int


def _slices(raw: bytes) -> Iterator[list[bytes]]:
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + _SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _interleaved(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Bits of row and column by turns, the row's first."""

    def spread(x):
        x = x.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x | (x << np.uint64(shift))) & np.uint64(mask)
        return x

    return (spread(rows) << np.uint64(1)) | spread(columns)


def impact(counts: np.ndarray, lengths: list[int], columns: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What each posting adds to a score per unit of its term's weight: whole numbers below a million."""
    # Python's integers: 25 n N may pass 64 bits.
    m = np.array([75 + 25 * n * documents // terms for n in lengths], np.int64)[columns]
    tf = counts.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def treap(rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
    """Cells level by level: ``depth``, nibbles (0 for a cell of one posting), maxima, and the single postings' places."""
    depth = max(int(rows.max()).bit_length(), int(columns.max()).bit_length())
    codes = _interleaved(rows, columns)
    order = np.argsort(codes)
    codes, values = codes[order], values[order]
    places = order
    nibbles, best, single = [], [], []
    for level in range(depth + 1):
        shift = np.uint64(2 * (depth - level))
        cell = codes >> shift
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[starts, len(cell)])
        best.append(np.maximum.reduceat(values, starts).astype("<u4"))
        inner = sizes > 1
        single.append(places[starts[~inner]])
        if not inner.any():
            nibbles.append(np.zeros(len(starts), np.uint8))
            break
        quadrant = ((codes >> (shift - np.uint64(2))) & np.uint64(3)).astype(np.uint8)
        nibble = np.bitwise_or.reduceat(np.left_shift(np.uint8(1), quadrant), starts)
        nibbles.append(np.where(inner, nibble, 0).astype(np.uint8))
        kept = np.repeat(inner, sizes)
        codes, values, places = codes[kept], values[kept], places[kept]
    single = np.concatenate(single)
    return depth, np.concatenate(nibbles), np.concatenate(best), rows[single], columns[single]


def _block(ids: list, texts: list[bytes], documents: int, total: int) -> dict | None:
    """One block's row, or none where no text has a term."""
    vocabulary: dict[bytes, int] = defaultdict(itertools.count().__next__)
    numbers, docs, lengths = [], [], []
    for doc, raw in zip(ids, texts):
        parts = [np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)) for words in _slices(raw)]
        n = sum(map(len, parts))
        if n:
            docs.append(doc)
            lengths.append(n)
            numbers += parts
    if not docs:
        return None
    # Columns by length, so that neighbours have like impacts; rows by frequency, for the same reason.
    order = np.argsort(lengths, kind="stable")
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    flat = np.concatenate(numbers) * len(docs) + np.repeat(column, lengths)
    cells, counts = np.unique(flat, return_counts=True)
    term, columns = np.divmod(cells, len(docs))
    frequency = np.bincount(term, minlength=len(vocabulary))
    by_frequency = np.argsort(-frequency, kind="stable")
    row = np.empty(len(by_frequency), np.int64)
    row[by_frequency] = np.arange(len(by_frequency))
    lengths = [lengths[k] for k in order]
    values = impact(counts, lengths, columns, documents, total)
    depth, nibbles, best, rows, columns = treap(row[term], columns, values)
    known = list(vocabulary)
    return {
        "docs": [docs[k] for k in order],
        "terms": b" ".join([known[k] for k in by_frequency]),
        "frequencies": frequency[by_frequency].astype("<u4").tobytes(),
        "depth": depth,
        "nibbles": nibbles.tobytes(),
        "best": best.tobytes(),
        "rows": rows.astype("<u4").tobytes(),
        "columns": columns.astype("<u2").tobytes(),
    }


_ARROW_BLOCK = pa.schema(
    [("docs", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in ("terms", "frequencies")]
    + [("depth", pa.int32())]
    + [(n, pa.binary()) for n in ("nibbles", "best", "rows", "columns")]
)


def _build(documents: int, total: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                ids.append(doc)
                texts.append(raw)
                size += len(raw)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    if made := _block(ids, texts, documents, total):
                        yield pa.RecordBatch.from_pylist([made], _ARROW_BLOCK)
                    ids, texts, size = [], [], 0
        if made := _block(ids, texts, documents, total):
            yield pa.RecordBatch.from_pylist([made], _ARROW_BLOCK)

    return run


@contextmanager
def _small_batches(spark: SparkSession):
    """Within, a batch for the workers ends with the row that brings it to a block's size."""
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(BLOCK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a term, and their terms with repeats, cut as blocks cut them."""
    for batch in batches:
        sizes = [sum(map(len, _slices(raw))) for raw in as_bytes(batch.column(0))]
        yield pa.RecordBatch.from_pydict({"documents": [sum(n > 0 for n in sizes)], "terms": [sum(sizes)]})


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Indexes every row of ``docs``; nothing is shuffled.

    A null or empty text has no terms and is never found. Rows with an equal or null ``key`` are documents of
    their own. A long text makes a block of its own. Other columns are ignored; no rows give an empty index.
    Each block gets a file of its own: a Parquet file's writer and readers hold a hundred rows whatever their size.
    """
    spark = settle(docs.sparkSession)
    with _small_batches(spark):
        counted = docs.select(F.col(text).alias("text")).mapInArrow(_count, "documents bigint, terms bigint")
        documents, total = (n or 0 for n in counted.agg(F.sum("documents"), F.sum("terms")).first())
        rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        path = scratch_path(spark, "treaps")
        rows.mapInArrow(_build(documents, total), _BLOCK).write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)
    return Index(spark.read.schema(_BLOCK).parquet(path), documents, total)


class _Grid:
    """A block's treap, opened for descents."""

    def __init__(self, block: dict):
        self.docs = block["docs"]
        self.depth = block["depth"]
        self.nibbles = np.frombuffer(block["nibbles"], np.uint8)
        self.best = np.frombuffer(block["best"], "<u4").astype(np.int64)
        children = _BITS[self.nibbles].astype(np.int64)
        self.first = 1 + np.cumsum(children) - children
        self.single = np.cumsum(self.nibbles == 0) - 1
        self.rows = np.frombuffer(block["rows"], "<u4").astype(np.int64)
        self.columns = np.frombuffer(block["columns"], "<u2").astype(np.int64)
        # From this level on, a cell's columns are fewer than the block's.
        self.top = self.depth - (len(self.docs) - 1).bit_length()

    def _half(self, level: int, side: int, rows: np.ndarray, cells: np.ndarray):
        """Which of the cells go on into this half of their columns, one level down, and the cells there."""
        shift = self.depth - 1 - level
        nibble = self.nibbles[cells]
        quadrant = 2 * (rows >> shift & 1) + side
        alone = nibble == 0
        there = np.where(alone, (self.columns[self.single[cells]] >> shift & 1) == side, nibble >> quadrant & 1 == 1)
        below = np.where(alone, cells, self.first[cells] + _BITS[nibble & ((1 << quadrant) - 1)])[there]
        own = (self.nibbles[below] > 0) | (self.rows[self.single[below]] == rows[there])
        there[there] = own
        return there, below[own]

    def start(self, rows: np.ndarray):
        """Each row's cell at level ``top``; -1 where it holds nothing."""
        cells = np.zeros(len(rows), np.int64)
        if self.nibbles[0] == 0:
            return np.where(self.rows[0] == rows, cells, -1)
        live = np.arange(len(rows))
        for level in range(self.top):
            there, below = self._half(level, 0, rows[live], cells[live])
            cells[live[~there]] = -1
            live = live[there]
            cells[live] = below
        return cells

    def search(self, rows: np.ndarray, cells: np.ndarray, weights: np.ndarray, floor: Callable[[], int], found: Callable[[int, int], None]):
        """Calls ``found(score, column)`` for every document whose score reaches ``floor()``, which may rise."""
        bound = int(weights @ self.best[cells])
        ticket = itertools.count()
        ranges = [(-bound, next(ticket), self.top, np.zeros(1, np.int64), np.array([bound]), np.zeros(len(rows), np.int64), rows, cells, weights)]
        while ranges:
            top, _, level, begins, bounds, owner, rows, cells, weights = heapq.heappop(ranges)
            least = floor()
            if -top < least:
                return
            if level == self.depth:
                for score, column in zip(bounds.tolist(), begins.tolist()):
                    if score >= floor():
                        found(score, column)
                continue
            if bounds[-1] < least:
                open_ = (bounds >= least)[owner]
                owner, rows, cells, weights = owner[open_], rows[open_], cells[open_], weights[open_]
            halves = []
            for side in (0, 1):
                there, below = self._half(level, side, rows, cells)
                if len(below):
                    mine = owner[there]
                    starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    sums = np.add.reduceat(weights[there] * self.best[below], starts)
                    sizes = np.diff(np.r_[starts, len(mine)])
                    halves.append((2 * begins[mine[starts]] + side, sums, sizes, rows[there], below, weights[there]))
            if not halves:
                continue
            begins, bounds, sizes, rows, cells, weights = map(np.concatenate, zip(*halves))
            # By bound, the highest first, as far as they can matter.
            order = np.argsort(-bounds, kind="stable")
            order = order[bounds[order] >= least]
            starts = np.cumsum(sizes) - sizes
            for at in range(0, len(order), _OPENED):
                part = order[at : at + _OPENED]
                length = sizes[part]
                owner = np.repeat(np.arange(len(part)), length)
                pick = np.arange(len(owner)) + (starts[part] - (np.cumsum(length) - length))[owner]
                ranges_of = (level + 1, begins[part], bounds[part], owner, rows[pick], cells[pick], weights[pick])
                heapq.heappush(ranges, (-int(bounds[part[0]]), next(ticket), *ranges_of))


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of large values: only one at a time becomes Python objects."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _search(items: list[tuple[int | None, list[tuple[bytes, int]]]], k: int):
    """``items``: id and weighted terms. A task yields its own best ``k`` documents of each."""

    def run(batches):
        number = {t: n for n, t in enumerate(dict.fromkeys(t for _, terms in items for t, _ in terms))}
        asked = [
            (np.array([number[t] for t, _ in terms], np.int64), np.array([w for _, w in terms], np.int64)) for _, terms in items
        ]
        # Heaps of score and document, the worst on top; a null id counts as smaller than all others.
        best: list[list] = [[] for _ in items]
        for block in _one_by_one(batches):
            grid = _Grid(block)
            rows = np.full(len(number), -1, np.int64)
            for row, term in enumerate(block["terms"].split(b" ")):
                if (n := number.get(term)) is not None:
                    rows[n] = row
            cells = np.full(len(number), -1, np.int64)
            held = np.flatnonzero(rows >= 0)
            cells[held] = grid.start(rows[held])
            docs = [-math.inf if d is None else d for d in grid.docs]
            for (terms, weights), top in zip(asked, best):
                live = cells[terms] >= 0
                if not live.any():
                    continue
                mine = terms[live]

                def floor(top=top):
                    return top[0][0] if len(top) == k else 1

                def found(score, column, top=top, docs=docs):
                    one = (score, -docs[column])
                    if len(top) < k:
                        heapq.heappush(top, one)
                    else:
                        heapq.heappushpop(top, one)

                grid.search(rows[mine], cells[mine], weights[live], floor, found)
        out = ((items[n][0], None if d == math.inf else -d, s) for n, top in enumerate(best) for s, d in top)
        while part := list(itertools.islice(out, _ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in part], pa.int64()) for c in range(3)], names=["item_id", "doc_id", "score"])

    return run


def _frequencies(wanted: frozenset[bytes]):
    def run(batches):
        for block in _one_by_one(batches):
            terms, numbers = [], []
            for term, n in zip(block["terms"].split(b" "), np.frombuffer(block["frequencies"], "<u4").tolist()):
                if term in wanted:
                    terms.append(term)
                    numbers.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(numbers, pa.int64())], names=["term", "n"])

    return run


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``key, term, repeats``; rows with an equal key make one item."""
    terms = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(TERM), F.lit(0))
    return (
        items.select(F.col(key).cast("bigint").alias("key"), F.explode(terms).alias("term"))
        .groupBy("key", "term")
        .agg(F.count("*").alias("repeats"))
    )


def search(index: Index, items: DataFrame, k: int = 20, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that score highest for each item, above 0; ties by
    ascending document id, null first.

    An item's terms count as often as they stand in it. Rows with an equal ``key`` make one item. A null
    or empty text finds nothing. Items are collected in passes of bounded size, which also bounds what tasks keep;
    one item's text must fit a task.
    """
    spark = items.sparkSession
    terms = materialize(item_terms(items, key, text), "item_terms")
    size, asking = terms.agg(F.sum(F.octet_length("term") + 16), F.count_distinct(F.struct("key"))).first()
    passes = max(-(-(size or 0) // ITEM_BYTES), -(-asking * k // HITS), 1)
    results = []
    for number in range(passes):
        mine = terms.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == number).collect()
        wanted = frozenset(r["term"].encode() for r in mine)
        counted = index.blocks.select("terms", "frequencies").mapInArrow(_frequencies(wanted), "term binary, n bigint")
        with _small_batches(spark):
            frequency = {bytes(r["term"]): r["df"] for r in counted.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        asked: dict = {}
        for r in sorted(mine, key=lambda r: r["term"]):
            if (df := frequency.get(r["term"].encode())) and (w := weight(index.documents, df)):
                asked.setdefault(r["key"], []).append((r["term"].encode(), w * r["repeats"]))
        found = index.blocks.mapInArrow(_search(list(asked.items()), k), "item_id bigint, doc_id bigint, score bigint")
        with _small_batches(spark):
            results.append(materialize(found, "found"))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
