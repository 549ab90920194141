"""Fitting, explaining and assembling metrics, on Spark ML pipelines."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product as cartesian

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.names import AMOUNT, FEATURES, ID, LABEL
from timeward.operators.calibration import reread
from timeward.operators.metrics import MetricError, positive_weight, ranking_metrics

BASELINE_COLUMNS = [AMOUNT, *FEATURES]

# Fixed values of the search.
SEARCH_SEED = 42
SEARCH_ITERATIONS = 10
SEARCH_SPACE: dict[str, list] = {
    "maxDepth": [5, 6, 7],
    "stepSize": [0.05],
    "subsamplingRate": [0.7, 0.8, 0.9],
    "featureSubsetStrategy": ["0.5", "0.6", "0.7"],
    "minInstancesPerNode": [80, 100, 120],
}


def _as_doubles(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


# ---- the baseline ----------------------------------------------------------------------------


def fit_baseline(
    train: DataFrame, columns: Sequence[str] = tuple(BASELINE_COLUMNS), label: str = LABEL
) -> PipelineModel:
    """Logistic regression with its scaling fitted inside, so that scoring replays it.

    No class weights: only the ranking is compared.
    """
    filled = [f"_f_{c}" for c in columns]
    stages = [
        Imputer(inputCols=list(columns), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="_x"),
        StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="_z", labelCol=label, rawPredictionCol="_raw", probabilityCol="_p",
            predictionCol="_class", maxIter=50, standardization=False,
        ),
    ]
    fitted = Pipeline(stages=stages).fit(_as_doubles(train, [*columns, label]))
    return PipelineModel([*fitted.stages[:-1], reread(fitted.stages[-1])])


def score_baseline(
    model: PipelineModel,
    rows: DataFrame,
    columns: Sequence[str] = tuple(BASELINE_COLUMNS),
    label: str = LABEL,
    *,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(kept columns, y_true, y_score)."""
    out = model.transform(_as_doubles(rows, list(columns)))
    return out.select(*keep, F.col(label).alias("y_true"), vector_to_array("_p")[1].alias("y_score"))


def baseline_metrics(scored: DataFrame) -> DataFrame:
    """One row: rows, positive rate, average precision, ROC-AUC. No rows or positives raise."""
    found = ranking_metrics(scored, "y_score", "y_true").select(
        "rows", (F.col("positives") / F.col("rows")).alias("positive_rate"), "pr_auc", "roc_auc"
    )
    row = found.first()
    if row is None or not row["rows"]:
        raise MetricError("no rows to score the baseline on")
    if not row["positive_rate"]:
        raise MetricError("no positive rows to score the baseline on")
    return found


# ---- boosted trees ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TreeInputs:
    """How columns reach the trees.

    Spark's trees take no missing values: numbers are filled and flagged, text levels of a small
    vocabulary are indexed with one extra level for missing and unseen. High-cardinality text
    belongs in a frequency encoding first.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()


def _tree_stages(inputs: TreeInputs) -> list:
    filled = [f"_f_{c}" for c in inputs.numeric]
    flags = [f"_missing_{c}" for c in inputs.numeric]
    codes = [f"_c_{c}" for c in inputs.categorical]
    stages: list = [Imputer(inputCols=list(inputs.numeric), outputCols=filled, strategy="mean")]
    if codes:
        stages.append(
            StringIndexer(
                inputCols=list(inputs.categorical), outputCols=codes,
                handleInvalid="keep", stringOrderType="alphabetAsc",
            )
        )
    stages.append(VectorAssembler(inputCols=[*filled, *flags, *codes], outputCol="_x"))
    return stages


def _flagged(rows: DataFrame, inputs: TreeInputs) -> DataFrame:
    out = _as_doubles(rows, inputs.numeric)
    return out.withColumns(
        {f"_missing_{c}": F.col(c).isNull().cast("double") for c in inputs.numeric}
    )


@dataclass(frozen=True)
class TreeModel:
    inputs: TreeInputs
    pipeline: PipelineModel
    params: Mapping[str, object]

    def score(self, rows: DataFrame, output: str = "raw_score") -> DataFrame:
        out = self.pipeline.transform(_flagged(rows, self.inputs))
        kept = [c for c in rows.columns if c != output]
        return out.select(*kept, vector_to_array("_p")[1].alias(output))

    @property
    def trees(self) -> int:
        return self.pipeline.stages[-1].getNumTrees

    def importances(self) -> dict[str, float]:
        names = [
            *self.inputs.numeric,
            *[f"missing {c}" for c in self.inputs.numeric],
            *self.inputs.categorical,
        ]
        return dict(zip(names, (float(v) for v in self.pipeline.stages[-1].featureImportances)))


# Rows that one task of a fit holds: binned, with their errors and weights, some 60 MB.
_FIT_ROWS = 100_000


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt over tasks of a fixed number of rows: a file's splits follow its compressed bytes, and would leave
    each task of a fit as many times more rows as the table has grown."""
    tasks = max(1, -(-rows.count() // _FIT_ROWS))
    return rows.repartition(tasks, ID) if ID in rows.columns else rows.repartition(tasks)


def fit_all_trees(
    train: DataFrame,
    val: DataFrame,
    inputs: TreeInputs,
    *,
    settings: Sequence[Mapping[str, object]],
    label: str = LABEL,
    seed: int = SEARCH_SEED,
    max_iter: int = 50,
    validation_tol: float = 0.01,
    **fixed: object,
) -> list[TreeModel]:
    """One model per setting: boosted trees with positives weighted by class balance and early stopping on ``val``.

    The rows are filled, assembled and dealt once for all of them. A fit passes over its rows several times before
    it has them binned, so they are kept on the executors, on disk where memory is short, until the last fit is done.
    """
    weight = positive_weight(train, label)
    both = train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True)))
    own = dict.fromkeys([*([ID] if ID in both.columns else []), *inputs.numeric, *inputs.categorical, label, "_val"])
    ready = _flagged(both.select(*own), inputs).withColumns(
        {
            label: F.col(label).cast("double"),
            "_weight": F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)),
        }
    )
    # Fill values and vocabularies come from the training rows alone.
    prepared = Pipeline(stages=_tree_stages(inputs)).fit(ready.where(~F.col("_val")))
    rows = prepared.transform(_dealt(ready)).select("_x", label, "_weight", "_val").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = []
        for chosen in settings:
            params = {"seed": seed, "maxIter": max_iter, "validationTol": validation_tol} | fixed
            params |= {{"max_iter": "maxIter", "validation_tol": "validationTol"}.get(k, k): v for k, v in chosen.items()}
            trees = GBTClassifier(
                featuresCol="_x", labelCol=label, weightCol="_weight", validationIndicatorCol="_val",
                predictionCol="_class", maxBins=64, **params,
            )
            trees.setRawPredictionCol("_raw").setProbabilityCol("_p")
            own_params = {k: v for k, v in (fixed | dict(chosen)).items() if k not in _FIT_ARGUMENTS}
            models.append(TreeModel(inputs, PipelineModel([*prepared.stages, trees.fit(rows)]), own_params))
        return models
    finally:
        rows.unpersist()


_FIT_ARGUMENTS = ("seed", "max_iter", "validation_tol")


def fit_trees(train: DataFrame, val: DataFrame, inputs: TreeInputs, **params: object) -> TreeModel:
    """The one model of :func:`fit_all_trees` with these parameters."""
    return fit_all_trees(train, val, inputs, settings=[{}], **params)[0]


def sampled_settings(
    space: Mapping[str, Sequence] = SEARCH_SPACE, n: int = SEARCH_ITERATIONS, seed: int = SEARCH_SEED
) -> list[dict]:
    """``n`` different points of the grid, or all of it when it is smaller."""
    grid = [dict(zip(space, values)) for values in cartesian(*space.values())]
    return random.Random(seed).sample(grid, min(n, len(grid)))


def random_search(
    train: DataFrame,
    val: DataFrame,
    inputs: TreeInputs,
    *,
    settings: Sequence[Mapping[str, object]],
    label: str = LABEL,
    **fixed: object,
) -> tuple[TreeModel, list[dict]]:
    """The model with the best average precision on ``val``, the first of equals, and the history
    of all of them; no model where none has a precision.

    Only one number per fit comes to the driver; each fit runs on the cluster.
    """
    models = fit_all_trees(train, val, inputs, settings=settings, label=label, **fixed)
    scores = [ranking_metrics(m.score(val), "raw_score", label).first()["pr_auc"] for m in models]
    history = [{"val_pr_auc": s, "trees": m.trees, **c} for c, m, s in zip(settings, models, scores)]
    best = best_setting(scores)
    return (None if best is None else models[best]), history


def best_setting(scores: Sequence[float | None]) -> int | None:
    """Place of the largest score, the first of equals; None where no setting has one."""
    ranked = [k for k, s in enumerate(scores) if s is not None]
    return max(ranked, key=lambda k: (scores[k], -k)) if ranked else None


# ---- explanations ----------------------------------------------------------------------------


def explained(
    rows: DataFrame, z: Column, weights: Sequence[float], intercept: float, columns: Sequence[str], *, id: str = ID
) -> DataFrame:
    """(id, y_score, base, parts) of a linear model over the standardised values ``z``, an array of doubles.

    Parts are ``weight x standardised value``, so base plus parts equals the log-odds exactly.
    """
    parts = F.zip_with(z, F.array(*[F.lit(float(w)) for w in weights]), lambda v, w: v * w)
    named = F.zip_with(
        F.array(*[F.lit(c) for c in columns]),
        F.zip_with(
            parts,
            F.array(*[F.col(c).cast("double") for c in columns]),
            lambda p, v: F.struct(p.alias("part"), v.alias("value")),
        ),
        lambda n, s: F.struct(n.alias("feature"), s["part"].alias("part"), s["value"].alias("value")),
    )
    base = F.lit(float(intercept))
    odds = F.aggregate("parts", base, lambda total, p: total + p["part"])
    return rows.select(id, base.alias("base"), named.alias("parts")).select(
        id, (F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))).alias("y_score"), "base", "parts"
    )


def contributions(
    model: PipelineModel,
    rows: DataFrame,
    columns: Sequence[str] = tuple(BASELINE_COLUMNS),
    *,
    id: str = ID,
) -> DataFrame:
    """As :func:`explained`, of a fitted baseline."""
    regression = model.stages[-1]
    scored = model.transform(_as_doubles(rows, list(columns)))
    return explained(scored, vector_to_array("_z"), list(regression.coefficients), regression.intercept, columns, id=id)


def global_attribution(explained: DataFrame, *, top: int = 25) -> DataFrame:
    """Features by mean absolute contribution, largest first."""
    return (
        explained.select(F.inline("parts"))
        .groupBy("feature")
        .agg(F.avg(F.abs("part")).alias("mean_abs"))
        .orderBy(F.col("mean_abs").desc(), "feature")
        .limit(top)
    )


def top_decisions(explained: DataFrame, *, rows: int = 5, drivers: int = 10, id: str = ID) -> DataFrame:
    """The most confident rows, each with its strongest contributions and the row's own values."""
    strongest = F.slice(
        F.array_sort(
            "parts",
            lambda a, b: F.when(F.abs(a["part"]) > F.abs(b["part"]), F.lit(-1))
            .when(F.abs(a["part"]) < F.abs(b["part"]), F.lit(1))
            .when(a["feature"] < b["feature"], F.lit(-1))
            .otherwise(F.lit(1)),
        ),
        1,
        drivers,
    )
    picked = explained.orderBy(F.col("y_score").desc(), id).limit(rows)
    return picked.select(id, "y_score", "base", F.posexplode(strongest).alias("place", "_d")).select(
        id, "y_score", "base", (F.col("place") + 1).alias("place"), "_d.feature", "_d.part", "_d.value"
    )
