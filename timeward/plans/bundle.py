"""A fitted model with all that scoring needs, in one folder per run: stored once, read back by path.

The folder holds the pipeline, the calibrator and the frequency maps in Spark's own formats, and a manifest
of one line: features, threshold, derivations, the contract's fingerprint, and the digests of the maps. The manifest
is written last. A folder without one is what an interrupted run left: it can't be read and may be written again, while a
complete one is never overwritten.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeward.contract.tables import map_lines, require_model_matches
from timeward.functions.derive import Derivation, require_maps
from timeward.operators.calibration import Calibrator, load_calibrator
from timeward.plans.gate import require_promoted
from timeward.plans.models import TreeInputs, TreeModel
from timeward.plans.scoring import score_rows
from timeward.session import materialize, path_exists

FORMAT = 2


class BundleError(Exception):
    """A stored model is absent, incomplete, or not what its manifest says."""


@dataclass(frozen=True)
class Bundle:
    run: str
    model: TreeModel
    calibrator: Calibrator
    threshold: float
    fingerprint: str
    code_version: str
    derivations: tuple[Derivation, ...] = ()
    maps: DataFrame | None = None

    @property
    def features(self) -> list[str]:
        return [*self.model.inputs.numeric, *self.model.inputs.categorical]

    def score(self, rows: DataFrame, *, keep: list[str]) -> DataFrame:
        """Raw score, probability and action of each row; an absent feature or map raises."""
        if self.maps is not None:
            require_maps(self.maps, self.derivations)
        return score_rows(
            rows, self.model, self.calibrator, self.threshold, derivations=self.derivations, maps=self.maps, keep=keep
        )


def _lines(maps: DataFrame | None) -> list[str]:
    """One line per mapped column."""
    return [] if maps is None else [r["line"] for r in map_lines(maps).orderBy("line").collect()]


def bundle_path(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/{run}"


def save_bundle(bundle: Bundle, root: str) -> str:
    """Stores the bundle under its run's name and returns the path."""
    spark, path = SparkSession.active(), bundle_path(root, bundle.run)
    if path_exists(spark, f"{path}/manifest/_SUCCESS"):
        raise BundleError(f"{path} holds a complete bundle, which is never overwritten")
    bundle.model.pipeline.write().overwrite().save(f"{path}/pipeline")
    bundle.calibrator.save(f"{path}/calibrator")
    if bundle.maps is not None:
        bundle.maps.select("column", "value", "count").write.mode("overwrite").parquet(f"{path}/maps")
    manifest = {
        "format": FORMAT,
        "run": bundle.run,
        "numeric": list(bundle.model.inputs.numeric),
        "categorical": list(bundle.model.inputs.categorical),
        "params": dict(bundle.model.params),
        "method": bundle.calibrator.method,
        "threshold": float(bundle.threshold),
        "fingerprint": bundle.fingerprint,
        "code_version": bundle.code_version,
        "derivations": [d.as_dict() for d in bundle.derivations],
        "has_maps": bundle.maps is not None,
        "maps": _lines(bundle.maps),
    }
    text = json.dumps(manifest, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """Fresh objects from a stored bundle, whose parts must be those of its manifest."""
    if not path_exists(spark, f"{path}/manifest/_SUCCESS"):
        raise BundleError(f"no complete bundle at {path}")
    stored = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if stored["format"] != FORMAT:
        raise BundleError(f"{path} has format {stored['format']}, this code reads {FORMAT}")
    inputs = TreeInputs(tuple(stored["numeric"]), tuple(stored["categorical"]))
    pipeline = PipelineModel.load(f"{path}/pipeline")
    size = 2 * len(inputs.numeric) + len(inputs.categorical)
    if pipeline.stages[-1].numFeatures != size:
        raise BundleError(f"the stored trees take {pipeline.stages[-1].numFeatures} values, the manifest names {size}")
    calibrator = load_calibrator(spark, stored["method"], f"{path}/calibrator")
    maps = spark.read.parquet(f"{path}/maps") if stored["has_maps"] else None
    if _lines(maps) != stored["maps"]:
        raise BundleError(f"the frequency maps at {path} are not those that were stored")
    derivations = tuple(
        Derivation(d["name"], d["tool"], tuple(d["inputs"]), d["params"]) for d in stored["derivations"]
    )
    return Bundle(
        stored["run"], TreeModel(inputs, pipeline, stored["params"]), calibrator, stored["threshold"],
        stored["fingerprint"], stored["code_version"], derivations, maps,
    )


def promoted_bundle(
    spark: SparkSession, root: str, promotions: DataFrame, runs: DataFrame, contract: DataFrame, fingerprint: str
) -> Bundle:
    """The stored bundle of the promoted run, proved against the promotions table and the contract of today.

    Raises unless the promoted run is the newest, its record and its bundle carry the contract's ``fingerprint``, and
    the model's features are exactly the admitted columns.
    """
    run = require_promoted(promotions, runs)
    bundle = load_bundle(spark, bundle_path(root, run))
    recorded = promotions.where(F.col("run") == run).agg(F.max_by("fingerprint", "promoted_at").alias("f")).first()["f"]
    if recorded != bundle.fingerprint:
        raise BundleError(f"run {run} was promoted with fingerprint {recorded}, its bundle has {bundle.fingerprint}")
    used = spark.createDataFrame([(c,) for c in bundle.features], "column string")
    require_model_matches(contract, used, fingerprint=bundle.fingerprint, expected=fingerprint)
    return bundle


def score_promoted(
    rows: DataFrame,
    root: str,
    promotions: DataFrame,
    runs: DataFrame,
    contract: DataFrame,
    fingerprint: str,
    *,
    keep: list[str],
) -> tuple[Bundle, DataFrame]:
    """A new period's rows scored by the promoted run, written once."""
    bundle = promoted_bundle(rows.sparkSession, root, promotions, runs, contract, fingerprint)
    return bundle, materialize(bundle.score(rows, keep=keep), "scored-period")
