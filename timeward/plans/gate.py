"""Promotion: predicates over a table of named metrics.

A metric that is absent is never read as zero; the predicate that needs it raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(Exception):
    """The gate cannot judge: a metric or a record is missing."""


@dataclass(frozen=True)
class GateLimits:
    """Fixed values."""

    baseline_pr_auc: float = 0.0635
    min_pr_auc_lift: float = 1.10
    min_unseen_ratio: float = 1.0
    max_calibration_error: float = 0.02
    false_positive_budget: float = 0.01
    max_false_positive_drift: float = 1.25
    min_dominant_lift: float = 5.0
    dominant_share: float = 0.50
    min_test_pr_auc: float = 0.50
    reference_test_pr_auc: float = 0.5237


_NEEDED = (
    "test_pr_auc",
    "test_pr_auc_unseen",
    "test_expected_calibration_error",
    "test_threshold_false_positive_rate",
)


def require_metrics(metrics: DataFrame, names: Sequence[str] = _NEEDED) -> None:
    """Raises when a needed metric is absent or NULL; reads only those rows."""
    found = metrics.where(F.col("metric").isin(list(names)) & F.col("value").isNotNull())
    have = {r["metric"] for r in found.select("metric").distinct().collect()}
    if absent := [n for n in names if n not in have]:
        raise GateError(f"metrics not measured: {absent}")


def gate_checks(
    metrics: DataFrame, dominant: DataFrame, limits: GateLimits = GateLimits()
) -> DataFrame:
    """(check, passed, observed, required) for all five predicates.

    ``metrics`` is (metric, value); ``dominant`` holds the dominant segment or nothing, and no
    dominant segment fails its check.
    """
    value = lambda n: F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n)
    wide = metrics.agg(*[value(n) for n in _NEEDED])
    lift = F.max(F.col("pr_auc") / F.nullif(F.col("positive_rate"), F.lit(0.0))).alias("_lift")
    wide = wide.crossJoin(F.broadcast(dominant.agg(lift)))  # one row

    def row(name: str, observed: Column, required: float, at_least: bool) -> Column:
        ok = observed >= F.lit(required) if at_least else observed <= F.lit(required)
        return F.struct(
            F.lit(name).alias("check"),
            F.coalesce(ok, F.lit(False)).alias("passed"),
            observed.alias("observed"),
            F.lit(float(required)).alias("required"),
        )

    budget = limits.false_positive_budget * limits.max_false_positive_drift
    rows = F.array(
        row("pr_auc_above_baseline", F.col("test_pr_auc"), limits.baseline_pr_auc * limits.min_pr_auc_lift, True),
        row("no_cold_entity_regression", F.col("test_pr_auc_unseen"), limits.baseline_pr_auc * limits.min_unseen_ratio, True),
        row("calibration_sane", F.col("test_expected_calibration_error"), limits.max_calibration_error, False),
        row("threshold_survives_out_of_sample", F.col("test_threshold_false_positive_rate"), budget, False),
        row("dominant_segment_not_regressed", F.col("_lift"), limits.min_dominant_lift, True),
    )
    return wide.select(F.inline(rows))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: promoted or not, and every failing check by name."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check"))))
    return checks.agg(F.bool_and("passed").alias("promoted"), F.array_join(failed, ", ").alias("failed"))


def require_passed(checks: DataFrame) -> None:
    found = verdict(checks).first()
    if not found["promoted"]:
        raise GateError(f"rejected: {found['failed']}")


def score_floor(metrics: DataFrame, limits: GateLimits = GateLimits()) -> DataFrame:
    """Is the test score above the floor, and how far from the reference run?"""
    score = F.max(F.when(F.col("metric") == "test_pr_auc", F.col("value")))
    return metrics.agg(score.alias("test_pr_auc")).select(
        "test_pr_auc",
        F.coalesce(F.col("test_pr_auc") >= F.lit(limits.min_test_pr_auc), F.lit(False)).alias("passed"),
        F.round(F.col("test_pr_auc") - F.lit(limits.reference_test_pr_auc), 4).alias("delta_to_reference"),
    )


def promotion_record(
    metrics: DataFrame, *, run: str, calibrator: str, code_version: str, fingerprint: str
) -> DataFrame:
    """One row to append to the promotions table."""
    value = lambda n: F.max(F.when(F.col("metric") == n, F.col("value")))
    return metrics.agg(value("test_pr_auc").alias("pr_auc"), value("threshold").alias("threshold")).select(
        F.lit(run).alias("run"),
        "pr_auc",
        "threshold",
        F.lit(calibrator).alias("calibrator"),
        F.lit(code_version).alias("code_version"),
        F.lit(fingerprint).alias("fingerprint"),
        F.current_timestamp().alias("promoted_at"),
    )


def latest_run(runs: DataFrame, *, run: str = "run", updated: str = "updated_at") -> DataFrame:
    """The most recently updated run, the larger name on a tie."""
    return runs.agg(F.max_by(run, F.struct(updated, run)).alias("run"))


def promoted_run(promotions: DataFrame, runs: DataFrame) -> DataFrame:
    """(promoted, newest, current): the promoted run should be the newest one."""
    promoted = promotions.agg(F.max_by("run", "promoted_at").alias("promoted"))
    newest = latest_run(runs).select(F.col("run").alias("newest"))
    return promoted.crossJoin(F.broadcast(newest)).select(  # one row
        "promoted", "newest", (F.col("promoted") == F.col("newest")).alias("current")
    )


def require_promoted(promotions: DataFrame, runs: DataFrame) -> str:
    found = promoted_run(promotions, runs).first()
    if found["promoted"] is None:
        raise GateError("no run has been promoted")
    if not found["current"]:
        raise GateError(f"promoted run {found['promoted']} is not the newest, {found['newest']}")
    return found["promoted"]
