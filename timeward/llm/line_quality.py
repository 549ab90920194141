"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own shape and that of the lines around it; two neighbouring
lines share a transition weight. Weights maximise the conditional likelihood of the lines of a
bounded sample of labelled documents, whose lines all bear the document's label. A document's score is the
mean of its lines' forward-backward marginals, weighted by length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column, as_bytes, fresh, settle, some_labelled

# Bounds of the training sample: documents of either class, lines of one sequence, sequences.
PER_CLASS = 1500
SEQUENCE = 32
SEQUENCES = 8000
ROUNDS = 150
L2 = 1e-3

_SYMBOLS = b"#*$%&|<>{}[]\\^~=_@+"
_MARKS = b"!?"
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_ENDS = b".!?:;\"')"

OWN = (
    "bias", "length", "words", "word_length", "symbols", "some_symbols", "marks", "digits", "upper", "mostly_upper",
    "distinct", "stutter", "ends_sentence", "seen_before", "blank",
)
N_OWN = len(OWN)


def _lacks(raw: bytes, found: bytes) -> int:
    return len(raw) - len(raw.translate(None, found))


def _shape(raw: bytes, seen: set[bytes]) -> tuple:
    n, words = len(raw), raw.split()
    if not words:
        return (1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)
    known = raw in seen
    seen.add(raw)
    k = len(words)
    symbols, upper, letters = _lacks(raw, _SYMBOLS) / n, _lacks(raw, _UPPER), _lacks(raw, _LETTERS)
    upper /= letters or 1
    return (
        1.0,
        min(np.log1p(n) / 6, 2.0),
        min(np.log1p(k) / 4, 2.0),
        min(n / k / 10, 3.0),
        symbols**0.5,
        float(symbols > 0.05),
        min(_lacks(raw, _MARKS) / k, 2.0),
        (_lacks(raw, _DIGITS) / n) ** 0.5,
        upper,
        float(upper > 0.5),
        len(set(words)) / k,
        sum(map(bytes.__eq__, words, words[1:])) / k,
        float(words[-1][-1] in _ENDS),
        float(known),
        0.0,
    )


def line_features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Own and neighbouring features of each line (rows), and the lines' lengths in bytes."""
    lines, seen = raw.split(b"\n"), set()
    own = np.array([_shape(line, seen) for line in lines], np.float32)
    around = np.zeros_like(own)
    around[1:] += 0.5 * own[:-1]
    around[:-1] += 0.5 * own[1:]
    # At either end, the line itself stands for the neighbour it lacks.
    around[0] += 0.5 * own[0]
    around[-1] += 0.5 * own[-1]
    return np.hstack([own, around[:, 1:]]), np.array([len(x) for x in lines], np.float64)


N_FEATURES = 2 * N_OWN - 1


@dataclass(frozen=True)
class Field:
    """Weights of "good" against "bad" per feature, and of the four transitions [before, now]."""

    weights: np.ndarray
    moves: np.ndarray


def _forward_backward(scores: np.ndarray, real: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of "good", expected transitions, and the sum of log partitions.

    ``scores`` (sequences x places) are log-odds; ``real`` marks the places that a sequence has.
    """
    n, t = scores.shape
    node = np.stack([np.zeros_like(scores), scores], axis=2)
    node[~real] = 0.0
    ahead = np.zeros((n, t, 2))
    back = np.zeros((n, t, 2))
    ahead[:, 0] = node[:, 0]
    add = np.logaddexp
    for k in range(1, t):
        step = ahead[:, k - 1, :, None] + moves
        moved = add(step[:, 0], step[:, 1]) + node[:, k]
        ahead[:, k] = np.where(real[:, k, None], moved, ahead[:, k - 1])
    for k in range(t - 2, -1, -1):
        step = moves + (node[:, k + 1] + back[:, k + 1])[:, None, :]
        moved = add(step[:, :, 0], step[:, :, 1])
        back[:, k] = np.where(real[:, k + 1, None], moved, 0.0)
    total = add(ahead[:, -1, 0], ahead[:, -1, 1])
    both = ahead + back
    good = np.where(real, 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500))), 0.0)
    pair = ahead[:, :-1, :, None] + moves + (node[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    expected = (np.exp(np.minimum(pair, 0.0)) * real[:, 1:, None, None]).sum(axis=(0, 1))
    return good, expected, float(total.sum())


def fit(features: np.ndarray, real: np.ndarray, good: np.ndarray, rounds: int = ROUNDS, l2: float = L2) -> Field:
    """Weights from padded sequences (sequences x places x features) of which each is all good or
    all bad, by Adam on the whole sample. Both classes weigh the same. No sequences give weights of zero."""
    n, t, f = features.shape
    weights, moves = np.zeros(f), np.zeros((2, 2))
    if not n:
        return Field(weights, moves)
    share = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())) * n
    wanted = np.where(real, good[:, None], 0.0)
    pairs = real[:, 1:].sum(axis=1)
    theta, m, v = np.zeros(f + 4), np.zeros(f + 4), np.zeros(f + 4)
    flat = features.reshape(n * t, f).astype(np.float64)
    lines = real.sum()
    for r in range(1, rounds + 1):
        weights, moves = theta[:f], theta[f:].reshape(2, 2)
        gradient = np.zeros(f + 4)
        scores = (flat @ weights).reshape(n, t)
        marginal, _, _ = _forward_backward(scores, real, moves)
        gradient[:f] = ((wanted - marginal) * share[:, None]).ravel() @ flat
        for label in (False, True):
            part = good == label
            if part.any():
                _, expected, _ = _forward_backward(scores[part], real[part], moves)
                seen = np.zeros((2, 2))
                seen[int(label), int(label)] = pairs[part].sum()
                gradient[f:] += (share[part][0] * (seen - expected)).ravel()
        gradient = gradient / lines - l2 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Field(theta[:f].copy(), theta[f:].reshape(2, 2).copy())


def line_marginals(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of "good" for each line of one document of any length."""
    from math import exp, log1p

    def add(a: float, b: float) -> float:
        return max(a, b) + log1p(exp(-abs(a - b)))

    (m00, m01), (m10, m11) = moves.tolist()
    ahead = [0.0] * len(scores)  # log-odds of the forward messages
    odds = 0.0
    listed = scores.tolist()
    for k, s in enumerate(listed):
        odds = s if k == 0 else s + add(m01, m11 + odds) - add(m00, m10 + odds)
        ahead[k] = odds
    odds = 0.0
    for k in range(len(listed) - 2, -1, -1):
        later = listed[k + 1] + odds
        odds = add(m10, m11 + later) - add(m00, m01 + later)
        ahead[k] += odds
    return 1 / (1 + np.exp(-np.clip(ahead, -500, 500)))


def score_text(raw: bytes, field: Field) -> float:
    """Length-weighted mean of the lines' marginals; 0 for a text without a word."""
    if not raw.strip():
        return 0.0
    features, lengths = line_features(raw)
    return float(line_marginals(features @ field.weights, field.moves) @ lengths / lengths.sum())


def _sequences(texts: pa.Array) -> pa.Array:
    """The lines' features of each text, cut into sequences, as little-endian 32-bit floats."""
    rows = []
    for raw in as_bytes(texts):
        found = line_features(raw)[0]
        rows.append([found[k : k + SEQUENCE].tobytes() for k in range(0, len(found), SEQUENCE)])
    return pa.array(rows, pa.list_(pa.binary()))


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality",
    per_class: int = PER_CLASS, sequences: int = SEQUENCES,
) -> Field:
    """Fits the field on a bounded sample: at most ``per_class`` documents of either label (0 bad, 1 good)
    among ``labels`` that are ``allowed``, and of their whole texts at most ``sequences`` stretches of
    SEQUENCE lines, both in the order of a hash. That is all that reaches the driver."""
    settle(docs.sparkSession)
    sample = F.broadcast(some_labelled(labels, label, allowed, per_class))  # 2 * per_class rows
    rows = (
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(sample, "id")
        .select("id", "label", F.posexplode(arrow_column(_sequences, "array<binary>")(F.col("text"))).alias("k", "lines"))
        .orderBy(F.xxhash64("id", "k"), "id", "k", "lines")
        .limit(sequences)
        .select("label", "lines")
        .collect()
    )
    features = np.zeros((len(rows), SEQUENCE, N_FEATURES), np.float32)
    real = np.zeros((len(rows), SEQUENCE), bool)
    for k, row in enumerate(rows):
        found = np.frombuffer(row["lines"], np.float32).reshape(-1, N_FEATURES)
        features[k, : len(found)], real[k, : len(found)] = found, True
    return fit(features, real, np.array([r["label"] == 1 for r in rows], bool))


def _score(field: Field) -> Callable[[pa.Array], pa.Array]:
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([score_text(raw, field) for raw in as_bytes(texts)], pa.float64())

    return run


def _label(field: Field) -> Callable[[pa.Array], pa.Array]:
    def run(texts: pa.Array) -> pa.Array:
        found = (line_features(raw)[0] @ field.weights for raw in as_bytes(texts))
        return pa.array([line_marginals(s, field.moves) for s in found], pa.list_(pa.float64()))

    return run


def with_quality(docs: DataFrame, field: Field, text: str = "text", out: str = "quality") -> DataFrame:
    """Adds the quality (0 to 1, higher is better) of each whole text.

    Null, empty and blank texts score 0. Only the text counts, so repeated rows score alike. A
    column named ``out`` is replaced, all others stay.
    """
    settle(docs.sparkSession)
    return docs.withColumn(out, arrow_column(_score(field), "double")(F.col(text)))


def with_line_labels(docs: DataFrame, field: Field, text: str = "text", out: str = "good_lines") -> DataFrame:
    """Adds for each line, cut at line feeds, whether it is likelier good than bad."""
    settle(docs.sparkSession)
    held = fresh(docs, "marginals")
    found = docs.withColumn(held, arrow_column(_label(field), "array<double>")(F.col(text)))
    return found.withColumn(out, F.transform(held, lambda p: p > 0.5)).drop(held)
