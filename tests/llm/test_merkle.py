import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import empty_docs, hard_docs, hard_rows
from timeward.llm import merkle


def h(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def plain(leaves, run):
    """Root and steps of every leaf, level by level."""
    nodes, groups, steps = list(leaves), [[k] for k in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), run):
            family = nodes[at : at + run]
            for k in range(len(family)):
                for m in groups[at + k]:
                    steps[m].append(("".join(family[:k]), "".join(family[k + 1 :])))
            above.append(h(*family))
            held.append([m for g in groups[at : at + run] for m in g])
        nodes, groups = above, held
    return nodes[0], steps


@pytest.mark.parametrize("run", [2, 3])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_climb_ends_in_the_root(n, run):
    leaves = [h(str(k)) for k in range(n)]
    levels = next(k for k in range(20) if run**k >= n)
    nodes = merkle.climb(leaves, levels, run)
    assert [len(x) for x in nodes] == [-(-n // run**k) for k in range(levels + 1)]
    assert nodes[0] == leaves and nodes[-1] == [plain(leaves, run)[0]]


@pytest.mark.parametrize("run", [2, 5])
def test_bands_equal_one_tree(spark, monkeypatch, run):
    monkeypatch.setattr(merkle, "BAND", 2)
    r = random.Random(run)
    sizes = {None: 1, "b": 67, "é": 2, "a": 33, "Z": 16, "": 5, "zz": 64, "c": 17}
    rows = [(g, k, h(str(g), str(k))) for g, n in sizes.items() for k in range(n)]
    r.shuffle(rows)
    leaves = spark.createDataFrame(rows, "g string, k long, leaf string")
    found = merkle.manifest(leaves, F.col("g"), ["k"], run=run)
    found = found.withColumn("folded", merkle.folded(F.col("leaf"), F.col("steps"))).collect()
    assert len(found) == len(rows)
    groups = sorted(sizes, key=lambda g: (g is not None, (g or "").encode()))
    lower = {g: plain([h(str(g), str(k)) for k in range(sizes[g])], run) for g in groups}
    root, upper = plain([lower[g][0] for g in groups], run)
    for row in found:
        g = row["g"]
        assert (row["subroot"], row["root"], row["folded"]) == (lower[g][0], root, root)
        assert [tuple(s) for s in row["steps"]] == lower[g][1][row["k"]] + upper[groups.index(g)]


def test_fields_tell_nulls_and_borders_apart(spark):
    rows = spark.createDataFrame([(None, "-"), ("", "ab"), ("a", "b"), ("é", None)], "x string, y string")
    got = [r[0] for r in rows.select(merkle.digest(F.col("x"), F.col("y"))).collect()]
    assert got == [h(t) for t in ("-1:-", "0:2:ab", "1:a1:b", "2:é-")]


def test_tampering_shows_in_the_tampered_leaf_only(spark):
    rows = [("g", k, h(str(k))) for k in range(300)]
    made = merkle.manifest(spark.createDataFrame(rows, "g string, k long, leaf string"), F.col("g"), ["k"])
    other = F.when(F.col("k") == 123, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf"))
    wrong = made.where(merkle.folded(other, F.col("steps")) != F.col("root")).collect()
    assert [r["k"] for r in wrong] == [123]


def test_hard_rows_and_clashing_names(spark):
    docs = hard_docs(spark)
    leaf = merkle.digest(*[F.col(c) for c in docs.columns])
    clashing = {n: F.lit(1) for n in ("tree", "rank", "digest", "bucket", "top", "steps", "number", "size", "row", "key")}
    found = merkle.manifest(docs.withColumn("leaf", leaf).withColumns(clashing), F.col("lang"), ["doc_id"])
    rows = found.collect()
    assert len(rows) == len(hard_rows()) and len({r["root"] for r in rows}) == 1
    assert set(found.columns) == {*docs.columns, "leaf", *clashing, "subroot", "root"}
    assert found.where(merkle.folded(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0
    # Repeated rows are leaves of their own: their proofs differ, their digests don't.
    twice = [r for r in rows if r["doc_id"] == 7]
    assert twice[0]["leaf"] == twice[1]["leaf"] and twice[0]["steps"] != twice[1]["steps"]
    assert merkle.manifest(empty_docs(spark).withColumn("leaf", leaf), F.col("lang"), ["doc_id"]).collect() == []
