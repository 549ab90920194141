"""Turning scores into probabilities, and choosing how."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeward.names import ID, LABEL
from timeward.operators.isotonic import apply_blocks, fit_blocks
from timeward.operators.metrics import probability_losses, ranking_metrics
from timeward.operators.ordered import hash_rank
from timeward.session import materialize, scratch_path

# The methods in order of preference, the folds, and the ranking a method may cost.
METHODS = ("isotonic", "platt")
FOLDS = 5
MAX_PR_AUC_LOSS = 0.005


def with_folds(
    rows: DataFrame, label: str = LABEL, *, key: str = ID, folds: int = FOLDS, seed: int = 0
) -> DataFrame:
    """Adds ``fold``: each class is dealt round-robin in seeded hash order."""
    ranked = hash_rank(rows, key, seed, by=[label])
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop(
        "rank", "group_rows"
    )


@dataclass(frozen=True)
class Calibrator:
    """``model`` is Spark's logistic model, or the written blocks of an isotonic fit."""

    method: str
    model: LogisticRegressionModel | DataFrame

    def apply(self, scored: DataFrame, score: str, output: str) -> DataFrame:
        if self.method == "isotonic":
            # Scores outside the fitted range take the nearest end.
            return apply_blocks(scored, self.model, score, output)
        plain = scored.withColumn("_score", F.col(score).cast("double"))
        vectors = VectorAssembler(inputCols=["_score"], outputCol="_x").transform(plain)
        out = self.model.transform(vectors)
        return out.withColumn(output, vector_to_array("_p")[1]).drop(
            "_score", "_x", "_raw", "_p", "_class"
        )

    def save(self, path: str) -> None:
        writer = self.model.write
        if self.method == "isotonic":
            writer.mode("overwrite").parquet(path)
        else:
            writer().overwrite().save(path)


def reread(model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model as it is stored. A fresh fit drags its training summary, and with that the session, into every
    task that applies it; a session that has observed anything can't be sent."""
    path = scratch_path(SparkSession.active(), "logistic")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def load_calibrator(spark: SparkSession, method: str, path: str) -> Calibrator:
    if method == "isotonic":
        return Calibrator(method, spark.read.parquet(path))
    return Calibrator(method, LogisticRegressionModel.load(path))


def grouped_scores(
    scored: DataFrame, score: str, label: str = LABEL, weight: str | None = None
) -> DataFrame:
    """One weighted record per distinct (score, label), which is all a calibrator needs."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return scored.groupBy(
        F.col(score).cast("double").alias("_score"), F.col(label).cast("double").alias("_y")
    ).agg(rows.cast("double").alias("_w"))


def fit_calibrator(
    scored: DataFrame, score: str, method: str, label: str = LABEL, *, weight: str | None = None
) -> Calibrator:
    points = grouped_scores(scored, score, label, weight)
    if method == "isotonic":
        return Calibrator(method, fit_blocks(points, "_score", "_y", "_w"))
    if method == "platt":
        points = points.persist()
        try:
            rows = points.agg(F.sum("_w").alias("n")).first()["n"]
            if not rows:
                raise ValueError("no rows to fit a calibrator on")
            fit = LogisticRegression(
                featuresCol="_x",
                labelCol="_y",
                weightCol="_w",
                rawPredictionCol="_raw",
                probabilityCol="_p",
                predictionCol="_class",
                # The same objective as a sum of losses plus half the squared weight.
                regParam=1.0 / rows,
                elasticNetParam=0.0,
                standardization=False,
                maxIter=200,
                tol=1e-9,
            )
            vectors = VectorAssembler(inputCols=["_score"], outputCol="_x").transform(points)
            return Calibrator(method, reread(fit.fit(vectors)))
        finally:
            points.unpersist()
    raise ValueError(f"unknown calibration method {method!r}, expected one of {METHODS}")


def fold_losses(
    scored: DataFrame,
    score: str,
    label: str = LABEL,
    *,
    key: str = ID,
    folds: int = FOLDS,
    seed: int = 0,
    methods: Sequence[str] = METHODS,
) -> DataFrame:
    """(fold, method, log_loss, pr_auc_loss), each measured on rows the fit did not see."""
    dealt = with_folds(scored.select(key, score, label), label, key=key, folds=folds, seed=seed)
    # Records per (fold, score, label), written once: every fit and every metric reads them.
    points = materialize(
        dealt.groupBy("fold", score, label).agg(F.count(F.lit(1)).alias("_rows")), "fold-points"
    )
    judged = points.select(
        "fold", F.lit("raw").alias("method"), label, "_rows", F.col(score).cast("double").alias("_p")
    )
    numbers = F.array(*[F.lit(k) for k in range(folds)])
    for method in methods:
        if method == "isotonic":
            # All folds in one pass: a record is a point of every fit but its own fold's.
            others = points.withColumn("fold", F.explode(F.array_except(numbers, F.array("fold"))))
            blocks = fit_blocks(others, score, label, "_rows", by=["fold"])
            fits = [apply_blocks(points, blocks, score, "_q", by=["fold"])]
        else:
            fits = [
                fit_calibrator(points.where(F.col("fold") != k), score, method, label, weight="_rows").apply(
                    points.where(F.col("fold") == k), score, "_q"
                )
                for k in range(folds)
            ]
        for out in fits:
            judged = judged.unionByName(
                out.select("fold", F.lit(method).alias("method"), label, "_rows", F.col("_q").alias("_p"))
            )
    groups = ["fold", "method"]
    ranked = ranking_metrics(judged, "_p", label, weight="_rows", by=groups).select(*groups, "pr_auc")
    raw = ranked.where("method = 'raw'").select("fold", F.col("pr_auc").alias("_raw"))
    fits = judged.where("method <> 'raw'")
    return (
        probability_losses(fits, "_p", label, weight="_rows", by=groups)
        .join(ranked, groups)
        .join(raw, "fold")
        .select("fold", "method", "log_loss", (F.col("_raw") - F.col("pr_auc")).alias("pr_auc_loss"))
    )


def choose_method(losses: DataFrame, *, budget: float = MAX_PR_AUC_LOSS) -> DataFrame:
    """One row per method with its means and whether it is chosen.

    Among methods that cost no more ranking than the budget the best log loss wins; if every
    method costs more, the one that costs least.
    """
    means = losses.groupBy("method").agg(
        F.avg("log_loss").alias("log_loss"), F.avg("pr_auc_loss").alias("pr_auc_loss")
    )
    affordable = F.col("pr_auc_loss") <= F.lit(budget)
    best = means.agg(
        F.coalesce(
            F.min_by(F.when(affordable, F.col("method")), F.when(affordable, F.col("log_loss"))),
            F.min_by("method", "pr_auc_loss"),
        ).alias("_best")
    )
    return means.crossJoin(F.broadcast(best)).select(  # one row
        "method",
        "log_loss",
        "pr_auc_loss",
        (~affordable).alias("disqualified"),
        (F.col("method") == F.col("_best")).alias("chosen"),
    )
