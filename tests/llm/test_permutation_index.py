import numpy as np
import pytest
from pyspark.sql import functions as F

from timeward.llm import permutation_index as index

SCHEMA = "vec_id long, embedding array<float>, rank string"


def _rows(n=1500, d=16):
    r = np.random.default_rng(4)
    return [(k, v.tolist()) for k, v in enumerate(r.normal(size=(n, d)).astype(np.float32))]


def _brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    e = np.array([v for _, v in rows], float)
    found = {}
    for q in queries:
        s = (e * e[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        order = [j for j in np.lexsort([ids, -s]) if ids[j] != q][:k]
        found[q] = [(int(ids[j]), float(s[j])) for j in order]
    return found


def _found(frame):
    held = {}
    for r in frame.orderBy("query_id", "rank").collect():
        held.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(held[r["query_id"]])
    return held


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def test_recall_against_brute_force(spark):
    rows = _rows()
    built = index.build(index.usable(_frame(spark, rows)))
    assert built.count() == len(rows)
    got = _found(index.search(built, F.col("vec_id") % 20 == 0, rows=700, queries=40))
    want = _brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    assert all(len(v) == 20 for v in got.values())


def test_footrule_equals_the_definition():
    r = np.random.default_rng(1)
    orders = np.array([r.permutation(30)[:6] for _ in range(200)], "<i2")
    query = r.permutation(30)[:6].astype("<i2")
    want = [sum(abs(i - (list(o).index(p) if p in o else 6)) for i, p in enumerate(query)) for o in orders]
    assert index._Files(orders).footrule(query).tolist() == want


def test_hard_rows(spark):
    rows = _rows(30, 4)
    same = [(100 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(50)]
    bad = [
        (None, [1.0, 0.0, 0.0, 0.0]), (200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 1.0, 1.0]),
        (280, [float("nan"), 1.0, 1.0, 1.0]), (300, [float("inf"), 1.0, 1.0, 1.0]),
    ]
    built = index.build(index.usable(_frame(spark, rows + same + bad + [(319, [1.0, 2.0])])))
    same.append((319, [1.0, 2.0, 0.0, 0.0]))
    assert built.count() == 81
    got = _found(index.search(built, F.col("vec_id") % 20 == 0, rows=25, queries=2))
    want = _brute(rows + same, [0, 20, 100, 120, 140], 20)
    assert got.keys() == want.keys()
    for q, pairs in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in pairs]
        assert np.allclose([s for _, s in got[q]], [s for _, s in pairs], rtol=1e-14)


def test_few_and_no_rows(spark):
    built = index.build(index.usable(_frame(spark, _rows(5, 3))))
    assert len(_found(index.search(built, F.col("vec_id") == 0))[0]) == 4
    alone = index.build(index.usable(_frame(spark, _rows(1, 3))))
    assert index.search(alone, F.col("vec_id") == 0).count() == 0
    none = index.build(index.usable(_frame(spark, [])))
    assert index.search(none, F.col("vec_id") == 0).count() == 0


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    got = _found(index.search(index.build(index.usable(_frame(spark, rows))), F.col("vec_id") == 0))
    assert got == {0: [(1, 1.0), (1, 1.0), (2, 0.0)]}
    assert pytest.approx(1.0) == got[0][0][1]


def test_vectors_of_other_sizes_take_part(spark):
    rows = _rows(60, 6) + [(100 + k, v[:4]) for k, v in _rows(20, 6)]
    got = _found(index.search(index.build(index.usable(_frame(spark, rows))), F.col("vec_id") == 103))
    query = np.array(rows[63][1] + [0, 0], float)
    exact = sorted((-float(np.array(v + [0] * (6 - len(v)), float) @ query), k) for k, v in rows if k != 103)[:20]
    assert [k for _, k in exact] == [k for k, _ in got[103]]
