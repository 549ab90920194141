import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import empty_docs, hard_docs, hard_rows, prose
from timeward.llm import treap_search as search

ITEMS = "item_id long, text string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(search.TERM, low)


def brute(docs, items, k=20):
    """``docs``: id and text; ``items``: id and text."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        scored = []
        for doc, c, n in held:
            m = 75 + (25 * n * n_docs) // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, r in wanted.items()
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        rows += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def answers(found):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_treap_against_its_definition(seed):
    r = np.random.default_rng(seed)
    cells = np.unique(r.integers(0, 700, size=200 if seed else 1))
    rows, columns = np.divmod(cells, 23 + seed)
    values = r.integers(1, 1000, size=len(cells))
    depth, nibbles, best, single_rows, single_columns = search.treap(rows, columns, values)
    # Cells by definition: those whose parent has more than one posting.
    expected = []
    inside = [np.arange(len(cells))]
    for level in range(depth + 1):
        below = []
        for members in inside:
            quadrants = {}
            for m in members:
                q = 2 * (rows[m] >> (depth - 1 - level) & 1) + (columns[m] >> (depth - 1 - level) & 1) if level < depth else 0
                quadrants.setdefault(int(q), []).append(m)
            many = len(members) > 1
            expected.append((sum(1 << q for q in quadrants) if many else 0, max(values[m] for m in members)))
            if many:
                below += [quadrants[q] for q in sorted(quadrants)]
        inside = below
    assert list(zip(nibbles.tolist(), best.tolist())) == expected
    assert sorted(zip(single_rows, single_columns)) == sorted(zip(rows, columns))


@pytest.mark.parametrize("block", [1, 300, 5000, 1 << 23])
def test_search_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "_OPENED", 4)
    monkeypatch.setattr(search, "ITEM_BYTES", 4000)
    r = random.Random(block)
    docs = [(k, prose(k // 2 if k % 5 == 0 else k, r.choice([1, 5, 30, 200]))) for k in range(240)] + hard_like()
    items = [(k, prose(1000 + k, 12)) for k in range(30)] + [(50, docs[6][1]), (51, None), (52, "..."), (53, "zzz unknown"), (54, "É é alpha1"), (54, "alpha2"), (None, "alpha3 alpha3 beta7")]
    made = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = index_with(made, block)
    assert answers(search.search(index, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def hard_like():
    return [(r[0], r[1]) for r in hard_rows()]


def index_with(docs, block):
    """As ``build`` does, with blocks of another size in the workers."""
    docs_, n = docs.collect(), docs.sparkSession
    held = [terms(r["text"]) for r in docs_]
    documents, total = sum(map(bool, held)), sum(map(len, held))
    rows, ids, texts, size = [], [], [], 0
    for r in docs_:
        ids.append(r["doc_id"])
        texts.append((r["text"] or "").encode())
        size += len(texts[-1])
        if size >= block:
            rows.append(search._block(ids, texts, documents, total))
            ids, texts, size = [], [], 0
    rows.append(search._block(ids, texts, documents, total))
    return search.Index(n.createDataFrame([r for r in rows if r], search._BLOCK), documents, total)


def test_built_index_counts_and_finds_the_same(spark):
    docs = hard_like() + [(100 + k, prose(k, 50)) for k in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = search.build(frame)
    held = [terms(t) for _, t in docs]
    assert (index.documents, index.terms) == (sum(map(bool, held)), sum(map(len, held)))
    items = [(1, prose(3, 20)), (2, "one two"), (3, docs[5][1])]
    assert answers(search.search(index, spark.createDataFrame(items, ITEMS), k=7)) == brute(docs, items, 7)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = prose(1, 500).encode()
    whole = text.translate(search._FOLD).split()
    monkeypatch.setattr(search, "_SLICE", 17)
    assert [w for part in search._slices(text) for w in part] == whole
    assert list(search._slices(b"")) == []


def test_descent_opens_few_ranges():
    docs = [(k, prose(k, 60)) for k in range(2000)]
    docs[777] = (777, docs[777][1] + " rare1 rare2 rare3")
    block = search._block([d for d, _ in docs], [t.encode() for _, t in docs], 2000, 120_003)
    grid = search._Grid(block)
    names = block["terms"].split(b" ")
    rows = np.array([names.index(t) for t in (b"rare1", b"rare2", b"rare3", b"alpha1", b"beta2")])
    cells = grid.start(rows)
    best, seen = [0], []

    def found(score, column):
        seen.append(column)
        best[0] = max(best[0], score)

    grid.search(rows, cells, np.array([8000, 8000, 8000, 3000, 3000]), lambda: max(best[0], 1), found)
    assert grid.docs[seen[0]] == 777 and len(seen) < 50


def test_hard_rows_and_clashing_names(spark):
    docs = hard_docs(spark).withColumn("key", F.lit(1)).withColumn("terms", F.lit("x")).withColumn("docs", F.lit(2))
    items = spark.createDataFrame([(1, "alpha1 one"), (2, None)], ITEMS).withColumn("score", F.lit(1)).withColumn("rank", F.lit(3))
    index = search.build(docs)
    assert answers(search.search(index, items)) == brute(hard_like(), [(1, "alpha1 one")])
    nothing = search.build(empty_docs(spark))
    assert (nothing.documents, nothing.terms) == (0, 0)
    assert search.search(nothing, items).collect() == []
    assert search.search(index, items.limit(0)).collect() == []


def test_a_file_holds_one_block(spark):
    docs = [(k, f"common word{k % 7}" + " rare" * (k % 9_000 == 5)) for k in range(2 * search.BLOCK_DOCS + 100)]
    index = search.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    files = index.blocks.groupBy(F.input_file_name()).count().collect()
    assert [r["count"] for r in files] == [1, 1, 1]
    items = [(1, "rare word5"), (2, "common")]
    assert answers(search.search(index, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_passes_bound_what_tasks_keep(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(search, "HITS", 60)
    monkeypatch.setattr(search, "materialize", lambda df, name, f=search.materialize: passes.append(name) or f(df, name))
    docs = [(k, prose(k, 30)) for k in range(80)]
    items = [(k, prose(500 + k, 3)) for k in range(14)] + [(None, "alpha1")]
    index = search.build(spark.createDataFrame(docs, "doc_id long, text string"))
    assert answers(search.search(index, spark.createDataFrame(items, ITEMS), k=20)) == brute(docs, items)
    assert passes.count("found") == 5


def test_hits_leave_a_task_in_parts(monkeypatch):
    monkeypatch.setattr(search, "_ROWS", 7)
    texts = [prose(k, 20).encode() for k in range(50)]
    block = search._block(list(range(50)), texts, 50, 1000)
    names = block["terms"].split(b" ")
    asked = [(k, [(names[k], 5)]) for k in range(4)]
    parts = list(search._search(asked, 20)(iter([search.pa.RecordBatch.from_pylist([block], search._ARROW_BLOCK)])))
    whole = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    assert len(parts) > 1 and max(p.num_rows for p in parts) <= 7
    assert len(set(whole)) == len(whole) == sum(min(20, int(f)) for f in np.frombuffer(block["frequencies"], "<u4")[:4])


def test_small_batches_end_at_a_blocks_size(spark):
    wide = spark.range(6, numPartitions=1).select(F.expr(f"repeat('x', {search.BLOCK_BYTES // 2 + 1})").alias("text"))

    def rows(batches):
        for batch in batches:
            yield search.pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get(search._BATCH_BYTES)
    with search._small_batches(spark):
        assert [r["n"] for r in wide.mapInArrow(rows, "n bigint").collect()] == [2, 2, 2]
    assert spark.conf.get(search._BATCH_BYTES) == before
