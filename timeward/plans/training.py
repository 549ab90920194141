"""The training plan: fit on train, choose on validation, report on test once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.names import AMOUNT, CARD_SEEN, ID, LABEL, PRODUCT, SPLIT
from timeward.operators.calibration import Calibrator, choose_method, fit_calibrator, fold_losses
from timeward.operators.metrics import (
    budget_threshold,
    calibration_error,
    cheapest_threshold,
    cost_curve,
    curve_at,
    probability_losses,
    product_segments,
    ranking_metrics,
    reliability,
    score_curve,
    seen_segments,
)
from timeward.plans.models import TreeInputs, TreeModel, random_search
from timeward.session import materialize

RAW, PROBABILITY = "raw_score", "probability"


@dataclass(frozen=True)
class Trained:
    model: TreeModel
    calibrator: Calibrator
    threshold: float
    history: list[dict]
    metrics: DataFrame
    segments: DataFrame
    test: DataFrame


def train(
    frame: DataFrame,
    inputs: TreeInputs,
    *,
    settings: Sequence[Mapping[str, object]],
    seen: str = CARD_SEEN,
    folds: int = 5,
    **fixed: object,
) -> Trained:
    """``frame`` holds all splits with their ``split`` column.

    Scores are written once and read back, so that the many metrics do not re-run the model.
    """
    part = lambda name: frame.where(F.col(SPLIT) == name)
    model, history = random_search(
        part("train"), part("val"), inputs, settings=settings, **fixed
    )
    keep = [c for c in (ID, LABEL, AMOUNT, PRODUCT, seen) if c in frame.columns]
    val = materialize(model.score(part("val")).select(*keep, RAW), "val-scores")
    test = materialize(model.score(part("test")).select(*keep, RAW), "test-scores")

    losses = choose_method(fold_losses(val, RAW, folds=folds))
    method = losses.where("chosen").first()["method"]
    calibrator = fit_calibrator(val, RAW, method)
    val = materialize(calibrator.apply(val, RAW, PROBABILITY), "val-probabilities")
    test = materialize(calibrator.apply(test, RAW, PROBABILITY), "test-probabilities")

    threshold = budget_threshold(score_curve(val, PROBABILITY), PROBABILITY)
    metrics = metric_rows(val, test, threshold, model, seen=seen)
    segments = product_segments(test, PROBABILITY) if PRODUCT in test.columns else None
    return Trained(model, calibrator, threshold, history, metrics, segments, test)


def metric_rows(
    val: DataFrame, test: DataFrame, threshold: float, model: TreeModel | None, *, seen: str = CARD_SEEN
) -> DataFrame:
    """(metric, value) for the headline, threshold, calibration and segment numbers.

    Each number is taken where it is defined; one that is not is absent, never zero.
    """
    cheapest = cheapest_threshold(cost_curve(val, PROBABILITY))
    at = lambda rows: curve_at(
        score_curve(rows, PROBABILITY, amount=AMOUNT),
        rows.limit(1).select(F.lit(threshold).alias("threshold")),
        PROBABILITY,
    )
    test_rank = ranking_metrics(test, PROBABILITY)
    blocks = [
        _named(ranking_metrics(val, PROBABILITY), {"pr_auc": "val_pr_auc"}),
        _named(test_rank, {"pr_auc": "test_pr_auc", "roc_auc": "test_roc_auc"}),
        _named(
            test_rank.select((F.col("positives") / F.col("rows")).alias("rate")),
            {"rate": "test_positive_rate"},
        ),
        _named(
            ranking_metrics(test, RAW),
            {"pr_auc": "uncalibrated_test_pr_auc", "roc_auc": "uncalibrated_test_roc_auc"},
        ),
        _named(
            at(val),
            {
                "threshold": "threshold",
                "false_positive_rate": "threshold_false_positive_rate",
                "true_positive_rate": "threshold_recall",
                "precision": "threshold_precision",
                "total_cost": "cost_at_budget_threshold",
            },
        ),
        _named(
            at(test),
            {
                "false_positive_rate": "test_threshold_false_positive_rate",
                "true_positive_rate": "test_threshold_recall",
                "precision": "test_threshold_precision",
            },
        ),
        _named(
            cheapest,
            {
                "threshold": "cost_minimising_threshold",
                "total_cost": "cost_at_cost_minimising_threshold",
            },
        ),
        _named(
            probability_losses(test, PROBABILITY),
            {"brier": "test_brier", "log_loss": "test_log_loss"},
        ),
        _named(
            calibration_error(reliability(test, PROBABILITY)),
            {"expected_calibration_error": "test_expected_calibration_error"},
        ),
    ]
    if seen in test.columns:
        by_seen = seen_segments(test, PROBABILITY, seen=seen)
        blocks += [
            by_seen.select(F.concat(F.lit("test_pr_auc_"), "segment").alias("metric"), F.col("pr_auc").alias("value")),
            by_seen.select(F.concat("segment", F.lit("_rows")).alias("metric"), F.col("rows").cast("double").alias("value")),
        ]
    if PRODUCT in test.columns:
        by_product = product_segments(test, PROBABILITY)
        name = lambda tail: F.concat(F.lit("product_"), "product", F.lit(tail))
        blocks += [
            by_product.select(F.concat(F.lit("test_pr_auc_product_"), "product").alias("metric"), F.col("pr_auc").alias("value")),
            by_product.select(name("_rows").alias("metric"), F.col("rows").cast("double").alias("value")),
            by_product.select(name("_positive_rate").alias("metric"), F.col("positive_rate").alias("value")),
        ]
    if model is not None:
        blocks.append(
            test.limit(1).select(F.lit("best_iteration").alias("metric"), F.lit(float(model.trees)).alias("value"))
        )
    out = blocks[0]
    for block in blocks[1:]:
        out = out.unionByName(block)
    return materialize(out.where(F.col("value").isNotNull()), "metrics")


def _named(found: DataFrame, names: Mapping[str, str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(new).alias("metric"), F.col(old).cast("double").alias("value"))
            for old, new in names.items()
        ]
    )
    return found.select(F.inline(pairs))
