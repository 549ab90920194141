import random

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import DOCS, components, empty_docs, hard_docs, hard_rows, prose, row, simhash
from timeward.llm import simhash as near
from timeward.llm.components import components as spark_components


def _expected(rows):
    prints = {r[1] or "": simhash(r[1]) for r in rows}
    linked = components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    names = {}
    for r in rows:
        root = linked[prints[r[1] or ""]]
        names[root] = min((x for x in (names.get(root), r[0]) if x is not None), default=None)
    return [(r[0], prints[r[1] or ""], names[linked[prints[r[1] or ""]]]) for r in rows]


def _copies():
    """Near copies in chains, exact copies and lone texts."""
    r, rows = random.Random(5), []
    for k in range(40):
        text = prose(k, 300).split()
        for c in range(r.randrange(1, 8)):
            rows.append(row(len(rows) + 100, " ".join(text), source=r.choice("ab")))
            if r.random() < 0.7:
                text[r.randrange(len(text))] = "changed"
    return rows


@pytest.mark.parametrize("tile", [8, 65536])
def test_components_equal_brute_force(spark, tile):
    rows = _copies() + hard_rows()
    docs = spark.createDataFrame(rows, DOCS)
    found = near.near_duplicates(docs, tile=tile).collect()
    got = sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in found), key=str)
    assert got == sorted(_expected(rows), key=str)


@pytest.mark.parametrize("tile", [16, 65536])
def test_links_of_close_fingerprints(spark, tile):
    r = random.Random(3)
    values = {0, 2**64 - 1, 7, 15}
    for _ in range(60):
        base = r.getrandbits(64)
        for _ in range(5):
            values.add(base)
            for _ in range(r.randrange(1, 3)):
                base ^= 1 << r.randrange(64)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    rows = spark.createDataFrame([(signed(v), signed(v)) for v in values], "doc_id long, fp long")
    found = {x["fp"] & (2**64 - 1): x["component_id"] for x in near.classes(rows, tile=tile).collect()}
    linked = components(sorted(values), lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for v in values:
        groups.setdefault(linked[v], []).append(signed(v))
    assert found == {v: min(groups[linked[v]]) for v in values}


def test_long_chain_of_edges(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 501)]
    found = dict(map(tuple, spark_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


def test_one_of_each(spark):
    rows = _copies() + hard_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns({"fp": F.lit("x"), "root": F.lit("y")})
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert {(r["fp"], r["root"]) for r in found} == {("x", "y")}
    want = _expected(rows)
    names = {c for _, _, c in want}
    assert sorted(str(r["doc_id"]) for r in found) == sorted(map(str, names))
    originals = {(r[0], r[1]) for r in rows}
    assert all((r["doc_id"], r["text"]) in originals for r in found)


def test_components_without_ids_keep_a_row_each(spark):
    rows = [row(None, prose(1, 90)), row(None, prose(1, 90)), row(None, prose(2, 90))]
    assert near.one_of_each(spark.createDataFrame(rows, DOCS)).count() == 2


def test_no_rows(spark):
    assert near.near_duplicates(empty_docs(spark)).count() == 0
    assert near.one_of_each(empty_docs(spark)).count() == 0


def test_row_count_stays(spark):
    assert near.near_duplicates(hard_docs(spark)).count() == len(hard_rows())
