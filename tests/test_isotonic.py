"""The distributed isotonic fit against a plain loop, with any cuts, and its application on both routes."""

import random

import numpy as np
import pytest

from timeward.operators.calibration import Calibrator, load_calibrator
from timeward.operators.isotonic import apply_blocks, fit_blocks, pool

SCHEMA = "g string, s double, y int, w double"


def plain(points):
    """(low, high, value) by pooling descending neighbours, one distinct score after the other."""
    sums = {}
    for s, y, w in points:
        held = sums.setdefault(s, [0.0, 0.0])
        held[0] += y * w
        held[1] += w
    blocks = []
    for s in sorted(sums):
        blocks.append([s, s, *sums[s]])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            _, high, t, w = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + t, blocks[-1][3] + w]
    return [(low, high, t / w) for low, high, t, w in blocks]


def shapes(n):
    r = random.Random(n)
    return {
        "noise": [(r.randrange(n) / n, int(r.random() < 0.3), 1.0) for _ in range(n)],
        "rising": [(k / n, int(r.random() < k / n), float(r.randrange(1, 4))) for k in range(n)],
        "falling": [(k / n, int(k < n // 2), 1.0) for k in range(n)],
        # Every second neighbour descends, so nothing but pairs is pooled and few blocks go.
        "saw": [(float(k), y, w) for k in range(n) for y, w in ((1, 1.0 + (k ^ 1)), (0, 2.0 * n))],
        "steps": [(float(k), int(k >= n // 2), 1.0) for k in range(n)],
        None: [(0.5, 1, 1.0), (0.5, 0, 3.0)],
    }


@pytest.fixture(scope="module")
def points(spark):
    made = shapes(300)
    rows = [(g, *p) for g, ps in made.items() for p in ps]
    return made, spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("per_range", [1_000_000, 20])
def test_all_groups_equal_the_plain_loop_whatever_the_cuts(points, per_range):
    made, df = points
    got = {}
    for r in fit_blocks(df, "s", "y", "w", by=["g"], per_range=per_range).collect():
        got.setdefault(r["g"], []).append((r["low"], r["high"], r["value"]))
    assert set(got) == set(made)
    for g, ps in made.items():
        wanted = plain(ps)
        assert np.allclose(np.array(sorted(got[g])), np.array(wanted)), g


def test_without_groups_and_without_points(spark, points):
    made, df = points
    one = df.where("g = 'noise'")
    got = sorted(map(tuple, fit_blocks(one, "s", "y", "w", per_range=16).select("low", "high", "value").collect()))
    assert np.allclose(np.array(got), np.array(plain(made["noise"])))
    none = fit_blocks(df.where("false"), "s", "y", "w")
    assert none.count() == 0
    assert [r["q"] for r in apply_blocks(one.limit(2), none, "s", "q").collect()] == [None, None]
    assert {r["q"] for r in apply_blocks(one.limit(2), none, "s", "q", held_blocks=-1).collect()} == {None}


def test_missing_and_odd_points(spark):
    rows = [("a", 1.0, 0, 1.0), ("a", 2.0, 1, 1.0), ("a", None, 1, 1.0), ("a", 1.5, None, 1.0), ("a", 0.0, 1, 0.0), ("a", float("nan"), 1, 1.0)]
    got = fit_blocks(spark.createDataFrame(rows, SCHEMA), "s", "y", "w", per_range=2).collect()
    assert sorted((r["value"], r["low"]) for r in got)[0] == (0.0, 1.0)
    assert {r["value"] for r in got} == {0.0, 1.0} and any(r["high"] != r["high"] for r in got)


@pytest.mark.parametrize("route", [{}, {"held_blocks": -1}, {"held_blocks": -1, "whole_below": 0}])
def test_scores_are_placed_on_the_line_between_blocks(spark, points, route):
    made, df = points
    blocks = fit_blocks(df, "s", "y", "w", by=["g"], per_range=64)
    r = random.Random(1)
    asked = [(k, g, r.uniform(-1, 2) * (300 if g in ("saw", "steps") else 1)) for k, g in enumerate(list(made) * 40)]
    asked += [(1000, "noise", None), (1001, "unknown", 0.5), (1002, "noise", float("nan")), (1003, "noise", made["noise"][0][0])]
    rows = spark.createDataFrame(asked, "k int, g string, s double")
    got = {x["k"]: x["q"] for x in apply_blocks(rows, blocks, "s", "q", by=["g"], **route).collect()}
    assert len(got) == len(asked) and got[1000] is None and got[1001] is None
    for k, g, s in asked:
        if k in (1000, 1001):
            continue
        ends = sorted({(x, v) for low, high, v in plain(made[g]) for x in (low, high)})
        wanted = ends[-1][1] if s != s else np.interp(s, [e[0] for e in ends], [e[1] for e in ends])
        assert got[k] == pytest.approx(min(max(wanted, 0.0), 1.0), abs=1e-12)


def test_blocks_are_stored_and_read_back(spark, points, tmp_path):
    _, df = points
    one = df.where("g = 'rising'")
    fitted = Calibrator("isotonic", fit_blocks(one, "s", "y", "w"))
    fitted.save(str(tmp_path / "c"))
    back = load_calibrator(spark, "isotonic", str(tmp_path / "c"))
    shown = lambda c: sorted((r["s"], r["q"]) for r in c.apply(one, "s", "q").collect())
    assert shown(fitted) == shown(back)


def test_pool_starts():
    assert pool([], []) == []
    assert pool([0, 1, 0, 1], [1, 1, 1, 1]) == [0, 1, 3]
    assert pool([1, 0, 0], [1, 1, 1]) == [0]
