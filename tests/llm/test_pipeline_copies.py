"""The pipeline's near copies: op10's fingerprints and the Jaccard rule, together."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.samples import DOCS, components, empty_docs, hard_rows, prose, row
from tests.llm.samples import simhash as plain_simhash
from tests.llm.test_near_copies import _jaccard, _planted, _set
from timeward.llm import near_copies as near
from timeward.llm import simhash


def _rows():
    """Copies by shingles, and texts that a repeated passage makes alike in fingerprint alone."""
    rows = _planted()[:40] + hard_rows()
    for k in range(6):
        rows.append(row(5000 + k, f"{prose(77, 11)} " * 60 + prose(900 + k, 40)))
    random.Random(4).shuffle(rows)
    return rows


def _linked(rows):
    sets = [_set(r[1]) for r in rows]
    prints = [plain_simhash(r[1]) for r in rows]
    alike = lambda a, b: _jaccard(sets[a], sets[b]) >= 0.8 or (prints[a] ^ prints[b]).bit_count() <= 3
    return components(range(len(rows)), alike)


def test_stage_links_by_either_rule(spark):
    rows = _rows()
    linked = _linked(rows)
    names = [min((rows[j][0] for j in linked if linked[j] == root and rows[j][0] is not None), default=None) for root in set(linked.values())]
    docs = spark.createDataFrame(rows, DOCS)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    found = [r["doc_id"] for r in stage(spark, docs, SMALL).collect()]
    assert sorted(map(str, found)) == sorted(map(str, names))
    assert len([i for i in found if i is not None and 5000 <= i < 5006]) == 1
    by_shingles = near.one_of_each(docs).select("doc_id").where("doc_id BETWEEN 5000 AND 5005")
    assert by_shingles.count() == 6


def test_columns_and_no_rows(spark):
    docs = spark.createDataFrame(hard_rows(), DOCS).withColumns({"fp": F.lit("x"), "text_key": F.lit("y")})
    found = near.one_of_each(docs, radius=simhash.RADIUS)
    assert found.columns == docs.columns
    assert {(r["fp"], r["text_key"]) for r in found.collect()} == {("x", "y")}
    assert near.one_of_each(empty_docs(spark), radius=simhash.RADIUS).count() == 0
