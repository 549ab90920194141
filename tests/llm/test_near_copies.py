import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.samples import DOCS, components, empty_docs, hard_rows, prose, row
from timeward.llm import near_copies as near


def _set(text, width=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _planted():
    """Copies with scattered changes of words, from one to as many as similarity 0.8 bears, and beyond."""
    r, rows = random.Random(8), []
    for k in range(60):
        words = prose(1000 + k, 300).split()
        rows.append(row(len(rows), " ".join(words)))
        for n in (1, 3, 6, 9):
            changed = list(words)
            for at in r.sample(range(len(words)), n):
                changed[at] = f"new{at}"
            rows.append(row(len(rows), " ".join(changed)))
    return rows


def _expected(rows):
    sets = {k: _set(r[1]) for k, r in enumerate(rows)}
    return components(sorted(sets), lambda a, b: _jaccard(sets[a], sets[b]) >= 0.8)


@pytest.mark.parametrize("tile", [5000, near.TILE_BYTES])
def test_planted_copies_go(spark, tile):
    rows = _planted()
    linked = _expected(rows)
    want = {min(rows[j][0] for j in linked if linked[j] == root) for root in set(linked.values())}
    got = [r["doc_id"] for r in near.one_of_each(spark.createDataFrame(rows, DOCS), tile=tile).collect()]
    assert sorted(got) == sorted(want)
    assert 60 <= len(want) < len(rows) / 2


def test_the_pipeline_drops_them(spark):
    rows = _planted()[:50]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = [_set(r["text"]) for r in stage(spark, spark.createDataFrame(rows, DOCS), SMALL).collect()]
    assert not any(_jaccard(a, b) >= 0.8 for k, a in enumerate(kept) for b in kept[k + 1 :])
    linked = _expected(rows)
    assert len(kept) == len(set(linked.values()))


def test_bands_find_pairs_from_the_threshold_on():
    r, missed, n = np.random.default_rng(2), 0, 2000
    for _ in range(n):
        h = r.integers(0, 2**64, 330, np.uint64)
        a, b = h[:300], h[33 : 333]  # 267 of 330 shared: 0.81
        missed += not (near._bands(np.sort(a)) == near._bands(np.sort(b))).any()
    assert missed <= 1


def test_hard_rows_keep_one_of_each(spark):
    rows = hard_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns({"text_key": F.lit("x"), "best_id": F.lit("y")})
    found = near.one_of_each(docs)
    assert found.columns == docs.columns
    linked = _expected(rows)
    names = {root: min((rows[j][0] for j in linked if linked[j] == root and rows[j][0] is not None), default=None) for root in set(linked.values())}
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(map(str, names.values()))
    assert near.one_of_each(empty_docs(spark)).count() == 0
