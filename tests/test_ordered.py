import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeward.operators import ordered
from timeward.operators.ordered import exact_quantiles, hash_rank, running_totals


@pytest.fixture
def ranged(monkeypatch):
    """Sends even small inputs down the route for large ones."""
    monkeypatch.setattr(ordered, "WHOLE_BELOW", 0)


def _values(n=500):
    draw = random.Random(3)
    return [(draw.choice("ab"), draw.randrange(60) / 7) for _ in range(n)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("edges", [None, [1.0, 2.5, 2.6, 8.0]])
def test_running_totals(spark, descending, edges):
    rows = _values()
    df = spark.createDataFrame(rows, "g string, x double")
    found = running_totals(
        df, "x", {"n": F.count(F.lit(1))}, by=["g"], descending=descending, edges=edges
    ).collect()
    for r in found:
        group = [x for g, x in rows if g == r["g"]]
        upto = [x for x in group if (x >= r["x"] if descending else x <= r["x"])]
        assert (r["n"], r["cum_n"], r["all_n"]) == (group.count(r["x"]), len(upto), len(group))
    assert len(found) == len(set(rows))


def test_quantiles_equal_numpy(spark, ranged):
    rows = _values()
    df = spark.createDataFrame(rows, "g string, x double")
    fractions = [i / 19 for i in range(20)]
    whole = {r["fraction_index"]: r["value"] for r in exact_quantiles(df, "x", fractions).collect()}
    expected = np.quantile([x for _, x in rows], fractions)
    assert [whole[i] for i in range(20)] == pytest.approx(list(expected))
    grouped = exact_quantiles(df, "x", [0.5], by=["g"]).collect()
    for r in grouped:
        assert r["value"] == pytest.approx(np.median([x for g, x in rows if g == r["g"]]))


def test_hash_rank_is_a_permutation_that_ignores_partitioning(spark):
    df = spark.range(3000).withColumn("c", F.col("id") % 3)
    once = {r["id"]: r["rank"] for r in hash_rank(df, "id", 5, by=["c"]).collect()}
    again = {r["id"]: r["rank"] for r in hash_rank(df.repartition(13), "id", 5, by=["c"]).collect()}
    assert once == again
    for c in range(3):
        assert sorted(v for k, v in once.items() if k % 3 == c) == list(range(1, 1001))
    other = {r["id"]: r["rank"] for r in hash_rank(df, "id", 6, by=["c"]).collect()}
    assert other != once


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [False, True])
def test_both_routes_place_nan_last(spark, monkeypatch, by, descending):
    rows = [("a", float(k % 90)) for k in range(300)] + [("b", 1e-6 * k) for k in range(200)] + [("a", float("nan")), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    shown = lambda: sorted(map(repr, running_totals(df, "x", {"n": F.count(F.lit(1))}, by=by, descending=descending).collect()))
    whole = shown()
    monkeypatch.setattr(ordered, "WHOLE_BELOW", 0)
    assert shown() == whole


def test_ranges_follow_the_records(spark, monkeypatch):
    assert ordered.ranges_for(10**11) == 10**5
    monkeypatch.setattr(ordered, "PER_RANGE", 10_000)
    df = spark.range(1_000_000).select((F.col("id") * F.lit(0.5)).alias("x"))
    edges = ordered.cut_points(df, "x")
    sizes = [r["count"] for r in ordered.with_range(df, "x", edges).groupBy("_range").count().collect()]
    assert len(sizes) == 100 and max(sizes) < 20_000


def test_groups_on_other_scales_are_cut_alike(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id") * 1e-9).otherwise(F.col("id") * 1e6).alias("x")
    )
    sizes = [r["count"] for r in ordered.with_range_by(df, "x", ["g"]).groupBy("g", "_range").count().collect()]
    assert len(sizes) >= 30 and max(sizes) < 2_500


_ROUTES = [None, [], [0.0], [-3.0, -2.9, 0.5, 2.0, 9.0]]


@pytest.mark.parametrize("edges", _ROUTES)
@pytest.mark.parametrize("descending", [False, True])
def test_totals_as_of_points(spark, descending, edges):
    import random

    from timeward.operators.ordered import totals_as_of

    r = random.Random(3)
    records = [(r.randrange(-40, 40) / 10, r.randrange(5)) for _ in range(60)] + [(None, 7), (float("nan"), 11)]
    points = [-9.0, -4.0, -1.25, 0.0, 0.5, 0.5, 2.0, 3.9, 4.0, 50.0, None] + [records[k][0] for k in range(9)]
    made = spark.createDataFrame(records, "x double, n long")
    asked = spark.createDataFrame([(p,) for p in points], "at double")
    found = {x["at"]: (x["cum_n"], x["all_n"]) for x in totals_as_of(made, asked, "x", ["n"], descending=descending, edges=edges).collect()}
    known = [(x, n) for x, n in records if x is not None]
    above = lambda x, p: x != x or x >= p
    below = lambda x, p: x == x and x <= p
    expected = {p: sum(n for x, n in known if (above if descending else below)(x, p)) for p in points if p is not None}
    assert found == {p: (n, sum(n for _, n in known)) for p, n in expected.items()}


@pytest.mark.parametrize("edges", _ROUTES)
@pytest.mark.parametrize("descending", [False, True])
def test_neighbours_across_ranges(spark, descending, edges):
    from timeward.operators.ordered import with_next

    values = [-7.5, -3.0, -2.95, -2.9, 0.0, 0.25, 0.5, 3.0, 20.0, 21.0]
    made = spark.createDataFrame([(x, k, None if k % 3 else "s") for k, x in enumerate(values)], "x double, k long, s string")
    found = {r["x"]: r["after"] for r in with_next(made, "x", ["k", "s"], "after", descending=descending, edges=edges).collect()}
    order = sorted(values, reverse=descending)
    following = dict(zip(order, order[1:]))
    for x in values:
        k = values.index(following[x]) if x in following else None
        assert (found[x] and tuple(found[x])) == (None if k is None else (k, None if k % 3 else "s"))


def test_roc_points_and_thresholds_alike_on_both_routes(spark):
    from pyspark.sql import functions as F

    from timeward.operators.metrics import curve_at, roc_points, score_curve

    rows = spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("p"), (F.col("id") % 9 == 0).cast("int").alias("isFraud"), (F.col("id") % 50).cast("double").alias("TransactionAmt")
    )
    curve = score_curve(rows, "p", amount="TransactionAmt").cache()
    points = spark.range(40).select((F.col("id") / 37 - 0.02).alias("threshold"))
    shown = lambda df: sorted(map(tuple, df.collect()))
    edges = [0.1, 0.101, 0.5, 0.9]
    assert shown(roc_points(curve, "p", most=60)) == shown(roc_points(curve, "p", most=60, edges=edges))
    assert shown(roc_points(curve, "p", most=5000)) == shown(roc_points(curve, "p", most=5000, edges=edges))
    whole = shown(curve_at(curve, points, "p"))
    assert whole == shown(curve_at(curve, points, "p", edges=edges)) and len(whole) == 40
    plan = curve_at(curve, points, "p")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
