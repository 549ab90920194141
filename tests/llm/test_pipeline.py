import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.conftest import SMALL
from tests.llm.samples import DOCS, hard_rows
from tests.llm.test_simhash import _copies
from tests.oracle import compare
from timeward.llm import mixing, outliers, packing, secret_scan, simhash
from timeward.llm.queries import QUERIES, SQL
from timeward.session import materialize

import pytest


def test_stages_agree_with_their_operators(spark):
    docs = spark.createDataFrame(hard_rows() + _copies(), DOCS)
    columns = docs.columns
    held = []
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), name)
        held.append(docs)
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
    ruled, lone, clean, mixed, packed = held
    assert ruled.count() == outliers.with_verdict(spark.createDataFrame(hard_rows() + _copies(), DOCS)).where("kept").count()
    prints = [r["fp"] for r in simhash.near_duplicates(lone).collect()]
    assert len(prints) == lone.count() > 10
    assert not any((a ^ b).bit_count() <= 3 for k, a in enumerate(prints) for b in prints[k + 1 :])
    assert clean.count() == lone.count()
    assert all(not secret_scan.find(r["text"] or "") for r in clean.collect())
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in clean.collect()}
    whole = Tokenizer.from_file(packing.default_vocabulary())
    want = sum(len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(len(np.frombuffer(r["ids"], "<u4")) for r in packed.collect()) == want


def test_the_mixture_keeps_its_permutation(spark):
    docs = spark.createDataFrame([(k, f"word{k} " * 9, "en", "abc"[k % 7 % 3], 9) for k in range(400)], DOCS)
    stage = materialize(pipeline.source_mix(spark, docs, SMALL), "mix")
    wanted = mixing.mixed(docs).select("doc_id", "source", "mix_pass", "mix_place").collect()
    place = {}
    for r in wanted:
        place.setdefault(r["doc_id"], []).append((r["source"], r["mix_pass"], r["mix_place"]))
    rows = stage.withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()
    assert len(rows) == len(wanted)
    by_file = {}
    for r in rows:
        by_file.setdefault(r["file"], []).append(r["doc_id"])
    for ids in by_file.values():
        # A document that comes twice has a place in every pass: some choice of them rises.
        last = ("", -1, -1)
        for i in ids:
            last = min(p for p in place[i] if p >= last)


def test_run_is_registered(spark):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scans", "source_mix", "packing"]
    assert entry.queries()["pipeline"](spark, SMALL).count() > 0
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, SQL[name]) == []


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_mixture_defaults_keep_all(spark):
    assert mixing.Mix().budget is None
