"""Batch scoring of a new period, and the append-only log it leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.functions.derive import Derivation, apply_derivations
from timeward.names import ID
from timeward.operators.assemble import require_columns
from timeward.operators.calibration import Calibrator
from timeward.operators.decisions import with_action
from timeward.plans.models import TreeModel
from timeward.sources.sinks import replace_run

RAW, PROBABILITY = "raw_score", "calibrated_probability"


def score_rows(
    rows: DataFrame,
    model: TreeModel,
    calibrator: Calibrator,
    threshold: float,
    *,
    derivations: Sequence[Derivation] = (),
    maps: DataFrame | None = None,
    keep: Sequence[str] = (ID,),
) -> DataFrame:
    """Derive, check that every model feature is there, score, calibrate, decide.

    The raw score is kept for ranking, the probability carries the decision.
    """
    derived = apply_derivations(rows, derivations, maps)
    require_columns(derived, [*model.inputs.numeric, *model.inputs.categorical], "scoring rows")
    raw = model.score(derived, RAW)
    return with_action(calibrator.apply(raw, RAW, PROBABILITY), PROBABILITY, threshold).select(
        *keep, RAW, PROBABILITY, "action"
    )


def prediction_log(
    scored: DataFrame, *, run: str, model_run: str, threshold: float, code_version: str
) -> DataFrame:
    """One row per scored row, in the log's column order."""
    return scored.select(
        ID,
        F.current_timestamp().alias("scored_at"),
        F.lit(run).alias("run"),
        F.lit(model_run).alias("model_run"),
        RAW,
        PROBABILITY,
        F.lit(float(threshold)).alias("threshold"),
        "action",
        F.lit(code_version).alias("code_version"),
    )


def log_predictions(scored: DataFrame, path: str, **stamp) -> None:
    """Logs a run's rows; logging the same run again replaces them."""
    replace_run(prediction_log(scored, **stamp), path)
