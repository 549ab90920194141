import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeward.operators import ordered
from timeward.operators.calibration import (
    choose_method,
    fit_calibrator,
    fold_losses,
    with_folds,
)
from timeward.operators.metrics import (
    MetricError,
    budget_threshold,
    calibration_error,
    cheapest_threshold,
    cost_curve,
    curve_at,
    dominant_segment,
    evaluate_thresholds,
    noise_summary,
    operating_cost,
    operating_point,
    positive_weight,
    precision_recall_points,
    product_segments,
    ranking_metrics,
    reliability,
    roc_points,
    score_curve,
)

SCHEMA = "TransactionID long, isFraud int, p double, TransactionAmt double"


def make_rows(n=600, rate=0.1, seed=1, levels=80):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        label = int(draw.random() < rate)
        p = min(1.0, max(0.0, draw.gauss(0.3 + 0.25 * label, 0.2)))
        out.append((i, label, round(p * levels) / levels, float(draw.randrange(1, 500))))
    return out


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


def reference_ap(rows):
    positives = sum(r[1] for r in rows)
    total, seen, hits = 0.0, 0, 0
    for t in sorted({r[2] for r in rows}, reverse=True):
        group = [r for r in rows if r[2] == t]
        found = sum(r[1] for r in group)
        seen, hits = seen + len(group), hits + found
        total += found / positives * hits / seen
    return total


def reference_auc(rows):
    pos = [r[2] for r in rows if r[1]]
    neg = [r[2] for r in rows if not r[1]]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def reference_cost(rows, t, flat=5.0):
    return sum(r[3] for r in rows if r[1] and r[2] < t) + flat * sum(not r[1] and r[2] >= t for r in rows)


@pytest.mark.parametrize("small", [True, False])
def test_ranking_equals_pairwise_counting(scored, rows, monkeypatch, small):
    if not small:
        monkeypatch.setattr(ordered, "WHOLE_BELOW", 0)
    found = ranking_metrics(scored, "p").first()
    assert found["pr_auc"] == pytest.approx(reference_ap(rows))
    assert found["roc_auc"] == pytest.approx(reference_auc(rows))


def test_ranking_without_positives_is_null(scored):
    found = ranking_metrics(scored.where("isFraud = 0"), "p").first()
    assert found["pr_auc"] is None and found["roc_auc"] is None
    with pytest.raises(MetricError):
        positive_weight(scored.where("isFraud = 0"))


@pytest.mark.parametrize("budget", [0.005, 0.01, 0.02, 0.05])
def test_budget_threshold_is_the_lowest_that_fits(scored, rows, budget):
    t = budget_threshold(score_curve(scored, "p"), "p", budget=budget)
    rate = lambda x: sum(not r[1] and r[2] >= x for r in rows) / sum(not r[1] for r in rows)
    assert rate(t) <= budget
    assert rate(max(r[2] for r in rows if r[2] < t)) > budget


def test_impossible_budget_raises(spark):
    df = spark.createDataFrame([(1, 0, 0.9, 1.0), (2, 1, 0.9, 1.0)], SCHEMA)
    with pytest.raises(MetricError):
        budget_threshold(score_curve(df, "p"), "p")
    with pytest.raises(MetricError):
        budget_threshold(score_curve(df.where("isFraud = 1"), "p"), "p")


def test_cost_at_the_extremes(scored, rows):
    legit = sum(not r[1] for r in rows)
    fraud = sum(r[3] for r in rows if r[1])
    assert operating_cost(scored, "p", 1.1).first()["cost"] == pytest.approx(fraud)
    assert operating_cost(scored, "p", -0.1).first()["cost"] == pytest.approx(5.0 * legit)


def test_thresholds_evaluated_together(spark, scored, rows):
    wanted = [-0.1, 0.3, 0.4, 0.7, 1.1]
    grid = spark.createDataFrame([(t,) for t in wanted], "threshold double")
    found = {r["threshold"]: r for r in evaluate_thresholds(scored, grid, "p").collect()}
    assert sorted(found) == wanted
    for t, r in found.items():
        caught = sum(x[1] and x[2] >= t for x in rows)
        blocked = sum(x[2] >= t for x in rows)
        assert r["caught"] + r["missed"] == sum(x[1] for x in rows)
        assert (r["caught"], r["blocked"]) == (caught, blocked)
        assert r["precision"] == pytest.approx(caught / blocked if blocked else 0.0)
        assert r["total_cost"] == pytest.approx(reference_cost(rows, t))


def test_cheapest_threshold_is_on_the_grid_and_lowest(scored, rows):
    grid = np.unique(np.quantile([r[2] for r in rows], np.linspace(0, 1, 200)))
    costs = [reference_cost(rows, t) for t in grid]
    found = cheapest_threshold(cost_curve(scored, "p")).first()
    assert found["threshold"] == pytest.approx(grid[int(np.argmin(costs))])
    assert found["total_cost"] == pytest.approx(min(costs))


def test_reliability_bins(spark):
    df = spark.createDataFrame([(i, int(i >= 50), float(i >= 50), 1.0) for i in range(100)], SCHEMA)
    bins = reliability(df, "p")
    got = bins.orderBy("bin").collect()
    assert len(got) == 10 and sum(r["rows"] for r in got) == 100
    assert (got[0]["rows"], got[9]["rows"], got[4]["mean_predicted"]) == (50, 50, 0.0)
    assert calibration_error(bins).first()[0] == 0.0
    edges = spark.createDataFrame([(1, 0, 0.3, 1.0), (2, 0, 0.7, 1.0), (3, 1, 1.0, 1.0)], SCHEMA)
    filled = {r["bin"] for r in reliability(edges, "p").collect() if r["rows"]}
    assert filled == {3, 7, 9}


def test_operating_point_beyond_every_score(scored, rows):
    points = precision_recall_points(score_curve(scored, "p"), "p")
    top = max(r[2] for r in rows)
    assert operating_point(points, 5.0).first()["threshold"] == top
    assert operating_point(points, 0.401).first()["threshold"] == min(r[2] for r in rows if r[2] >= 0.401)


def test_roc_points_are_few_and_monotone(spark):
    df = spark.createDataFrame(make_rows(1500, 0.3, 4, 100_000), SCHEMA)
    got = roc_points(score_curve(df, "p"), "p", most=50).orderBy("position").collect()
    assert len(got) <= 50
    assert (got[0]["false_positive_rate"], got[-1]["true_positive_rate"]) == (0.0, 1.0)
    for a, b in zip(got, got[1:]):
        assert a["false_positive_rate"] <= b["false_positive_rate"]
        assert a["true_positive_rate"] <= b["true_positive_rate"]


def test_segments(spark):
    make = lambda rows: spark.createDataFrame(rows, "product string, pr_auc double, rows long, positive_rate double")
    found = dominant_segment(make([("W", 0.2130, 45426, 0.0198), ("C", 0.7265, 6481, 0.1467)])).first()
    assert found["product"] == "W" and found["share"] > 0.5
    assert dominant_segment(make([("a", 0.5, 10, 0.1), ("b", 0.5, 10, 0.1), ("c", 0.5, 10, 0.1)])).count() == 0


def test_small_product_segments_are_left_out(spark):
    rows = [(i, int(i % 10 == 0), (i % 97) / 97, "big") for i in range(600)]
    rows += [(i, 1, 0.5, "small") for i in range(600, 650)] + [(i, 0, 0.1, None) for i in range(650, 1300)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, p double, ProductCD string")
    assert [r["product"] for r in product_segments(df, "p").collect()] == ["big"]


def test_noise_summary(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.7, 1.0)], "a double, b double")
    got = {r["metric"]: r for r in noise_summary(df, ["a", "b"]).collect()}
    assert got["a"]["sd"] == pytest.approx(math.sqrt(0.02)) and got["b"]["sd"] == 0.0
    assert noise_summary(df.limit(1), ["a"]).first()["sd"] == 0.0


# ---- calibration -----------------------------------------------------------------------------


def pooled(points):
    """Pool adjacent violators on (score, label) pairs."""
    blocks = []
    for x in sorted({p[0] for p in points}):
        ys = [y for s, y in points if s == x]
        blocks.append([sum(ys), len(ys), [x]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {x: s / n for s, n, xs in blocks for x in xs}


def test_isotonic_equals_pooling_and_clips(spark, scored, rows):
    fitted = fit_calibrator(scored, "p", "isotonic")
    wanted = pooled([(r[2], r[1]) for r in rows])
    for r in fitted.apply(scored, "p", "q").collect():
        assert r["q"] == pytest.approx(wanted[r["p"]], abs=1e-9)
    outside = spark.createDataFrame([(1, 0, -5.0, 1.0), (2, 0, 5.0, 1.0)], SCHEMA)
    got = sorted(r["q"] for r in fitted.apply(outside, "p", "q").collect())
    assert got == pytest.approx([min(wanted.values()), max(wanted.values())])


def test_platt_minimises_the_penalised_loss(scored, rows):
    x = np.array([r[2] for r in rows])
    y = np.array([r[1] for r in rows])
    w = b = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(w * x + b)))
        g = np.array([((p - y) * x).sum() + w, (p - y).sum()])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum()]])
        w, b = np.array([w, b]) - np.linalg.solve(h, g)
    got = fit_calibrator(scored, "p", "platt").apply(scored, "p", "q").collect()
    for r in got:
        assert r["q"] == pytest.approx(1 / (1 + math.exp(-(w * r["p"] + b))), abs=2e-4)
    assert sum(r["q"] for r in got) / len(got) == pytest.approx(y.mean(), abs=1e-3)


def test_folds_are_stratified_and_stable(scored, rows):
    dealt = {r["TransactionID"]: r["fold"] for r in with_folds(scored).collect()}
    again = {r["TransactionID"]: r["fold"] for r in with_folds(scored.repartition(7)).collect()}
    assert dealt == again
    for label in (0, 1):
        sizes = [sum(dealt[r[0]] == f for r in rows if r[1] == label) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_zero_budget_disqualifies_isotonic(scored):
    losses = fold_losses(scored, "p", folds=3)
    got = {r["method"]: r for r in choose_method(losses, budget=0.0).collect()}
    assert set(got) == {"isotonic", "platt"}
    assert got["isotonic"]["disqualified"] and got["platt"]["chosen"]
    assert got["platt"]["pr_auc_loss"] == pytest.approx(0.0, abs=1e-12)


def test_method_choice_rules(spark):
    make = lambda rows: spark.createDataFrame(rows, "fold int, method string, log_loss double, pr_auc_loss double")
    chosen = lambda rows, budget: choose_method(make(rows), budget=budget).where("chosen").first()["method"]
    rows = [(0, "isotonic", 0.1, 0.02), (0, "platt", 0.2, 0.001)]
    assert chosen(rows, 0.005) == "platt"
    assert chosen(rows, 0.05) == "isotonic"
    assert chosen(rows, 0.0001) == "platt"


def test_curve_serves_the_budget_choice(scored):
    curve = score_curve(scored, "p", amount="TransactionAmt")
    t = budget_threshold(curve, "p", budget=0.05)
    one = scored.limit(1).select(F.lit(t).alias("threshold"))
    assert curve_at(curve, one, "p").first()["false_positive_rate"] <= 0.05
