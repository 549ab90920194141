"""Toxicity by logistic regression over hashed word n-grams and skip-grams, fitted with FTRL-proximal.

Features of a text are the hashes of its words, of neighbouring words and of words with one between
them, each present or absent. FTRL-proximal (McMahan et al., 2013) keeps a rate per coordinate and sets
coordinates whose evidence stays below the L1 penalty to exactly zero, so the weights are a
short list that goes out with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column, settle, some_labelled

# Bounds of the training sample: documents of either class, words of a document in it.
PER_CLASS = 2500
MOST_WORDS = 20_000

BITS = 20
_WORD = re.compile(r"\w+")
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(64 - BITS)
_REMEMBERED = 500_000


class _Hashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[word] = crc32(word.encode("utf-8", "surrogatepass"))
        return found


_HASHES = _Hashes()


def features(text: str) -> np.ndarray:
    """Slots of a text's n-grams below 2^BITS; they may repeat."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = h[:-1] * np.uint64(31) + h[1:] + np.uint64(1 << 33)
    skips = h[:-2] * np.uint64(37) + h[2:] + np.uint64(1 << 34)
    return np.concatenate([h * _PAIR >> _SHIFT, pairs * _PAIR >> _SHIFT, skips * _SKIP >> _SHIFT]).astype(np.int32)


@dataclass(frozen=True)
class Weights:
    """Non-zero weights by slot, and the intercept."""

    slots: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << BITS, np.float32)
        full[self.slots] = self.values
        return full


def fit(
    rows: list[tuple[np.ndarray, int]], alpha: float = 0.5, beta: float = 1.0, l1: float | None = None, l2: float = 0.1,
    passes: int = 20,
) -> Weights:
    """FTRL-proximal over ``rows`` (distinct slots, label) in their order. No rows give no weights.

    The default of ``l1`` grows with the root of the number of rows, as the sum of gradients of a word
    without meaning does.
    """
    if l1 is None:
        l1 = 0.3 * len(rows) ** 0.5
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.where(at == bias, 0.0, l1)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - pull, 0.0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(passes):
        for slots, label in rows:
            at = np.append(slots, bias)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    full = weights(np.arange(bias + 1))
    slots = np.flatnonzero(full[:-1])
    return Weights(slots.astype(np.int32), full[slots].astype(np.float32), float(full[-1]))


def _slots(texts: pa.Array) -> pa.Array:
    return pa.array([np.unique(features(t or "")).astype("<i4").tobytes() for t in texts.to_pylist()], pa.binary())


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", per_class: int = PER_CLASS, most_words: int = MOST_WORDS
) -> Weights:
    """Fits on a bounded sample: at most ``per_class`` documents of either label among those ``allowed``,
    in the order of a hash of the id, that have at most ``most_words`` blanks. Their slots are all
    that reaches the driver."""
    settle(docs.sparkSession)
    sample = F.broadcast(some_labelled(labels, label, allowed, per_class))  # 2 * per_class rows
    blanks = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    rows = (
        docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(sample, "id")
        .where(blanks <= most_words)
        .select("id", "label", arrow_column(_slots, "binary")(F.col("text")).alias("slots"))
        .collect()
    )
    # Both classes alternate as a hash has it, alike wherever the rows came from.
    rows.sort(key=lambda r: (crc32(f"x{r['id']}".encode()), r["id"], r["slots"]))
    return fit([(np.frombuffer(r["slots"], np.int32), r["label"]) for r in rows])


def _score(weights: Weights) -> Callable[[pa.Array], pa.Array]:
    held: list[np.ndarray] = []

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(weights.dense())
        total = []
        for text in texts.to_pylist():
            slots = features(text or "")
            slots = np.unique(slots[held[0][slots] != 0])
            total.append(float(held[0][slots].sum(dtype=np.float64)) + weights.bias)
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(total, float), -500, 500))), pa.float64())

    return run


def with_toxicity(docs: DataFrame, weights: Weights, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds the probability that each whole text is toxic.

    Null and empty texts have no features and score the intercept's probability. Only the text
    counts, so repeated rows score alike. A column named ``out`` is replaced, all others stay.
    """
    settle(docs.sparkSession)
    return docs.withColumn(out, arrow_column(_score(weights), "double")(F.col(text)))
