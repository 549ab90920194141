"""Packing by power-of-two decomposition.

A document of L ids is cut into floor(L / longest) pieces of the longest length and one piece for each
binary digit of the rest, longest first. A piece is a training sequence of its own: its length is
a power of two, so it takes no padding, and no sequence crosses documents. Batches are drawn from the
bucket of one length (column ``bucket``, the exponent); ``write_buckets`` lays the sequences out that way.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column, as_bytes, fresh, settle

LONGEST = 4096
END = 2

# Words of letters and a tail of signs without apostrophes, digits or combining marks: the vocabulary splits each part
# off as one, whatever stands around it.
_PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*()+=/_~^-]*)|(.+))$", re.M)
# Bytes that one generation of the memory may take, and bytes of text that are encoded at a time. A worker outlives its
# tasks, and what it remembers stands beside the heap of whatever runs next.
_CACHED = 64 << 20
_ENTRY = 200  # of a word, besides its letters and at most one id for each of them
_AT_ONCE = 1 << 19


def pieces_of(length: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces, in their order in the document: powers of two that add up."""
    rest = length % longest
    digits = [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * (length // longest) + digits


class _Memory:
    """Values by key in two generations: when the younger is full, the older goes and what is used again moves up.

    Full is a number of bytes, so that long keys count for what they take.
    """

    def __init__(self, most: int):
        self.most, self.bytes, self.young, self.old = most, 0, {}, {}

    def turn(self) -> None:
        if self.bytes >= self.most:
            self.bytes, self.young, self.old = 0, {}, self.young

    def missing(self, keys: set) -> list:
        """Keys that neither generation knows, of those that the younger does not; the others move up."""
        young, old = self.young, self.old
        self.bytes += _ENTRY * len(keys) + 5 * sum(map(len, keys))
        unknown = []
        for key in keys:
            if (value := old.get(key)) is None:
                unknown.append(key)
            else:
                young[key] = value
        return unknown


class _Encoder:
    """Ids of words as little-endian unsigned 32-bit bytes, remembered per word.

    White space only separates words in this vocabulary (its normalizer works within words), so a text's ids
    are those of its words, one after another. The new plain words of many texts are encoded as one text, in which an id
    with a word end closes each part; other words are encoded one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        vocabulary = self.whole.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = _Memory(_CACHED)

    def _learn(self, words: set[bytes]) -> None:
        unknown = self.words.missing(words)
        found = _PLAIN.findall(b"\n".join(unknown).decode())
        young = self.words.young
        plain = [raw for raw, (*_, other) in zip(unknown, found) if not other]
        if plain:
            coded = self.whole.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0]
            ids = np.array(coded.ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            # A word closes once, and once more where it has a tail.
            last = np.cumsum([2 if tail else 1 for _, tail, other in found if not other])
            if len(ends) != last[-1]:
                raise ValueError("the vocabulary does not close every part with a word end")
            cuts, raw_ids = (4 * ends[last - 1]).tolist(), ids.tobytes()
            young.update(zip(plain, map(raw_ids.__getitem__, map(slice, [0, *cuts], cuts))))
        odd = [(raw, other) for raw, (*_, other) in zip(unknown, found) if other]
        coded = self.whole.encode_batch_fast([w for _, w in odd], add_special_tokens=False)
        for (raw, _), one in zip(odd, coded):
            young[raw] = np.array(one.ids, "<u4").tobytes()

    def ids(self, raw: bytes) -> bytes:
        return self.encode([raw])[0]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. Texts, or slices of long ones, are taken together up to a size."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for number, raw in enumerate(texts):
            for part in _slices(raw):
                held.append((number, _lower(part).split()))
                size += len(part)
                if size >= _AT_ONCE:
                    self._flush(held, out)
                    held, size = [], 0
        self._flush(held, out)
        return [b"".join(parts) for parts in out]

    def _flush(self, held: list[tuple[int, list[bytes]]], out: list[list[bytes]]) -> None:
        self.words.turn()
        young = self.words.young
        open_, new = [], set()
        for number, words in held:
            ids = list(map(young.get, words))
            if None in ids:
                open_.append((out[number], len(out[number]), words, ids))
                new.update([w for w, i in zip(words, ids) if i is None])
                out[number].append(b"")
            else:
                out[number].append(b"".join(ids))
        self._learn(new)
        for parts, place, words, ids in open_:
            parts[place] = b"".join([young[w] if i is None else i for w, i in zip(words, ids)])


def _lower(raw: bytes) -> bytes:
    """The vocabulary is lower case; only its special tokens tell cases apart."""
    return raw if b"<|" in raw else raw.lower()


def _slices(raw: bytes):
    """The text in slices that end at a blank."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _AT_ONCE)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    import os

    # Spark already runs one task per core.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return _Encoder(path)


_PIECES = "array<struct<start:bigint,ids:binary>>"


def _cut(path: str, longest: int, end: int) -> Callable[[pa.Array], pa.Array]:
    last = np.array([end], "<u4").tobytes()

    def run(texts: pa.Array) -> pa.Array:
        starts, parts, offsets = [], [], [0]
        for ids in _encoder(path).encode(as_bytes(texts)):
            ids += last
            start = 0
            for n in pieces_of(len(ids) // 4, longest):
                starts.append(start)
                parts.append(ids[4 * start : 4 * (start + n)])
                start += n
            offsets.append(len(starts))
        both = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int64()), pa.array(parts, pa.binary())], ["start", "ids"]
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), both)

    return run


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(
    docs: DataFrame, vocabulary: str | None = None, longest: int = LONGEST, end: int = END, text: str = "text"
) -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, and ``start, length, bucket, ids,
    doc_tokens, sequence_id, offset``; ``ids`` are little-endian unsigned 32-bit numbers. Columns of
    those names in ``docs`` give way.

    A null or empty text is the end id alone, one piece of length 1. Repeated rows are packed once
    each. A long text gives as many longest pieces as it fills. No rows give no rows. The
    vocabulary is a path that all executors can read; it must drop white space, as ``word_bpe_49k`` does.
    """
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    settle(docs.sparkSession)
    cut = arrow_column(_cut(vocabulary or default_vocabulary(), longest, end), _PIECES)
    made = {"start", "length", "bucket", "ids", "doc_tokens", "sequence_id", "offset"}
    own = [c for c in docs.columns if c != text and c.lower() not in made]
    held = fresh(docs, "pieces")
    piece = fresh(docs, "piece")
    size = F.octet_length(F.col(f"{piece}.ids")) / 4
    return (
        docs.select(*own, cut(F.col(text)).alias(held))
        .select(
            *own,
            F.aggregate(held, F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p["ids"])).alias("doc_bytes_"),
            F.explode(held).alias(piece),
        )
        .select(
            *own,
            F.col(f"{piece}.start").alias("start"),
            size.cast("bigint").alias("length"),
            F.log2(size).cast("int").alias("bucket"),
            F.col(f"{piece}.ids").alias("ids"),
            (F.col("doc_bytes_") / 4).cast("bigint").alias("doc_tokens"),
            F.monotonically_increasing_id().alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"),
        )
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Writes one folder per length, so that a trainer reads equal lengths together."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def bucket_sizes(packed: DataFrame) -> DataFrame:
    """Sequences and ids of each bucket."""
    return packed.groupBy("bucket").agg(F.count("*").alias("sequences"), F.sum("length").alias("ids"))
