"""Line-field quality and toxicity: gradients and marginals against plain sums, held-out accuracy, hard rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.samples import empty_docs, hard_docs, hard_rows, prose
from timeward.llm import line_quality as lines
from timeward.llm import toxicity
from timeward.llm.text import remainder, some_labelled, table

LARGER = SMALL.replace("sf0.001", "sf0.01")


def _all_paths(scores, moves):
    weights = {}
    for path in itertools.product((0, 1), repeat=len(scores)):
        total = sum(s for s, y in zip(scores, path) if y) + sum(moves[a][b] for a, b in zip(path, path[1:]))
        weights[path] = np.exp(total)
    return weights


@pytest.mark.parametrize("n", [1, 2, 5])
def test_marginals_equal_all_paths(n):
    r = np.random.default_rng(n)
    scores, moves = r.normal(size=n) * 2, r.normal(size=(2, 2))
    paths = _all_paths(scores, moves)
    z = sum(paths.values())
    want = [sum(w for p, w in paths.items() if p[k]) / z for k in range(n)]
    assert np.allclose(lines.line_marginals(scores, moves), want)
    padded = np.concatenate([scores, np.zeros(3)])[None]
    real = np.arange(n + 3)[None] < n
    good, expected, log_z = lines._forward_backward(padded, real, moves)
    assert np.allclose(good[0, :n], want) and not good[0, n:].any()
    assert np.isclose(log_z, np.log(z))
    pairs = np.zeros((2, 2))
    for p, w in paths.items():
        for a, b in zip(p, p[1:]):
            pairs[a, b] += w / z
    assert np.allclose(expected, pairs)


def test_score_equals_the_weighted_mean_over_all_paths():
    r = np.random.default_rng(3)
    field = lines.Field(r.normal(size=lines.N_FEATURES), r.normal(size=(2, 2)))
    for text in (b"one", b"One line.\n\nBUY NOW!!! $$$", b"a b c\na b c\n\nlast words here 123\n", b"\n\nx"):
        features, _ = lines.line_features(text)
        paths = _all_paths(features @ field.weights, field.moves)
        sizes = [len(x) for x in text.split(b"\n")]
        want = sum(w * sum(n for n, y in zip(sizes, p) if y) for p, w in paths.items()) / sum(paths.values()) / sum(sizes)
        assert lines.score_text(text, field) == pytest.approx(want)


def test_neighbours_are_features():
    found, lengths = lines.line_features(b"one line.\nTHE NEXT!!\n\nlast")
    assert found.shape == (4, lines.N_FEATURES) and lengths.tolist() == [9, 10, 0, 4]
    n = lines.N_OWN
    assert np.allclose(found[1, n:], 0.5 * (found[0, 1:n] + found[2, 1:n]))
    assert np.allclose(found[0, n:], 0.5 * (found[0, 1:n] + found[1, 1:n]))


def test_a_very_long_document_has_marginals():
    marginals = lines.line_marginals(np.full(50_000, 3.0), np.zeros((2, 2)))
    assert np.allclose(marginals, 1 / (1 + np.exp(-3.0)))


def test_fit_without_rows():
    field = lines.fit(np.zeros((0, lines.SEQUENCE, lines.N_FEATURES), np.float32), np.zeros((0, lines.SEQUENCE), bool), np.zeros(0, bool))
    assert lines.score_text(b"some text", field) == pytest.approx(0.5)


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    held = remainder(F.col("doc_id"), 4) == 2
    field = lines.train(docs, labels, ~held)
    scored = lines.with_quality(docs, field, out="score").join(labels.drop("toxic"), "doc_id").where(held)
    rows = scored.select("score", "quality").collect()
    assert len(rows) > 50
    right = sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in rows)
    assert right / len(rows) > 0.95
    assert all(r["score"] >= 0.7 for r in rows if r["quality"] == 1)

    hard = lines.with_quality(hard_docs(spark).withColumn("quality", F.lit("old")), field).collect()
    assert len(hard) == len(hard_rows())
    for r in hard:
        assert 0 <= r["quality"] <= 1
        assert r["quality"] == lines.score_text((r["text"] or "").encode(), field)
        if not (r["text"] or "").strip():
            assert r["quality"] == 0
    labelled = lines.with_line_labels(hard_docs(spark), field).collect()
    assert all(len(r["good_lines"]) == (r["text"] or "").count("\n") + 1 for r in labelled)
    assert lines.with_quality(empty_docs(spark), field).count() == 0


def test_training_ignores_what_is_held_out(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    allowed = remainder(F.col("doc_id"), 4) != 2
    import zlib

    found = {(r["id"], r["label"]) for r in some_labelled(labels, "quality", allowed, 1000).collect()}
    assert found == {(k, k % 2) for k in range(200) if zlib.crc32(str(k).encode()) % 4 != 2}
    assert some_labelled(labels, "quality", allowed, 10).count() == 20


def _toxic_set():
    r, rows = random.Random(1), []
    for k in range(800):
        text = [f"w{int(1.01 ** r.randrange(900))}" for _ in range(r.randrange(30, 120))]
        if bad := k % 4 == 0:
            for _ in range(3):
                text[r.randrange(len(text))] = r.choice(["nasty", "vile", "You rotten thing"])
        rows.append((k, " ".join(text), int(bad)))
    return rows


def test_ftrl_finds_the_words_and_is_sparse(spark):
    rows = _toxic_set()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = remainder(F.col("doc_id"), 5) == 0
    weights = toxicity.train(docs, labels, ~held)
    assert 0 < len(weights.slots) < 1000
    scored = toxicity.with_toxicity(docs, weights).join(labels, "doc_id").where(held).collect()
    assert len(scored) > 40
    right = sum((r["toxicity"] >= 0.5) == (r["toxic"] == 1) for r in scored)
    assert right / len(scored) > 0.95
    assert all(r["toxicity"] < 0.5 for r in scored if not r["toxic"])

    hard = toxicity.with_toxicity(hard_docs(spark).withColumn("toxicity", F.lit("old")), weights).collect()
    assert len(hard) == len(hard_rows()) and all(0 <= r["toxicity"] <= 1 for r in hard)
    assert len({r["toxicity"] for r in hard if not (r["text"] or "").strip()}) == 1
    assert toxicity.with_toxicity(empty_docs(spark), weights).count() == 0
    assert len(toxicity.train(docs.where("false"), labels, ~held).slots) == 0


def test_ftrl_equals_a_plain_loop():
    r = np.random.default_rng(0)
    rows = [(np.unique(r.integers(0, 30, 6)).astype(np.int32), int(r.integers(0, 2))) for _ in range(50)]
    found = toxicity.fit(rows, alpha=0.5, l1=0.3, l2=0.2, passes=2).dense()
    z, n = {}, {}
    bias = -1

    def weight(i):
        pull = 0.0 if i == bias else 0.3
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= pull else -(zi - np.sign(zi) * pull) / ((1.0 + n.get(i, 0.0) ** 0.5) / 0.5 + 0.2)

    for _ in range(2):
        for slots, y in rows:
            at = [*slots.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in at:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / 0.5
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    assert np.allclose(found[:30], [weight(i) for i in range(30)], atol=1e-6)


def test_skip_grams_are_features():
    a, b = toxicity.features("one two three"), toxicity.features("one other three")
    assert len(a) == 3 + 2 + 1 and len(set(a) & set(b)) == 3
    assert len(toxicity.features("")) == 0 and len(toxicity.features("one")) == 1
