"""Fitted models and what is measured on them.

A fitted model has no SQL counterpart. Where a property of the result does, that is compared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from timeward.contract.tables import fingerprint, map_lines
from timeward.functions.derive import Derivation, apply_derivations, frequency_map
from timeward.names import AMOUNT, ID, LABEL, PRODUCT, SPLIT
from timeward.operators.calibration import choose_method, fit_calibrator, fold_losses
from timeward.operators.isotonic import apply_blocks, fit_blocks
from timeward.operators.metrics import noise_summary, ranking_metrics
from timeward.operators.ordered import seeded_hash
from timeward.operators.splits import split_table
from timeward.plans.bundle import Bundle, save_bundle, score_promoted
from timeward.plans.features import model_input
from timeward.plans.models import (
    BASELINE_COLUMNS,
    TreeInputs,
    baseline_metrics,
    contributions,
    fit_all_trees,
    fit_baseline,
    fit_trees,
    global_attribution,
    random_search,
    score_baseline,
    top_decisions,
)
from timeward.plans.scoring import log_predictions, score_rows
from timeward.plans.training import train
from timeward.registry import query, steady, steady_sql
from timeward.registry.adapters import scored, scored_sql, transactions
from timeward.registry.history import transaction_features
from timeward.registry.splitting import splits_cte
from timeward.session import materialize, scratch_path
from timeward.sources.sinks import read_log

P = "probability"
_INPUTS = TreeInputs(tuple(BASELINE_COLUMNS), (PRODUCT,))
_SMALL = {"max_iter": 4, "maxDepth": 3, "stepSize": 0.2}


def _frame(spark, folder):
    """Orders with the core features and their split, written once for the fits."""
    joined = transactions(spark, folder, "orders").select(
        ID, "TransactionDT", AMOUNT, LABEL, PRODUCT, "card1", "addr1", "D1", "D3", "DeviceInfo"
    )
    features = transaction_features(joined, c_columns=(), m_columns=())
    whole = model_input(joined, features, ())
    # A column that does carry signal, next to features that have none on this data.
    signal = F.expr(f"({ID} * 7919 % 1000) * 7 + 3000 * {LABEL}").cast("double")
    whole = whole.withColumn("signal", signal)
    return materialize(whole.join(split_table(joined), ID), "model-frame")


def _part(frame, name):
    return frame.where(F.col(SPLIT) == name)


@query(
    "k02_baseline_scores",
    "K1 K2 H11",
    f"""{splits_cte('orders')}
SELECT tx.TransactionID, tx.isFraud AS y_true, true AS is_probability FROM tx JOIN sp USING (TransactionID) WHERE split = 'val'""",
)
def baseline_scores(spark, folder):
    frame = _frame(spark, folder)
    model = fit_baseline(_part(frame, "train"))
    out = score_baseline(model, _part(frame, "val"), keep=[ID])
    return out.select(ID, "y_true", F.col("y_score").between(0.0, 1.0).alias("is_probability"))


@query(
    "k02_baseline_metrics",
    "K1 K2 D13 D14",
    f"""{splits_cte('orders')}
SELECT count(*) AS "rows", {steady_sql('avg(isFraud)', 6)} AS positive_rate, true AS ranked
FROM tx JOIN sp USING (TransactionID) WHERE split = 'val'""",
)
def baseline_metrics_query(spark, folder):
    frame = _frame(spark, folder)
    found = baseline_metrics(score_baseline(fit_baseline(_part(frame, "train")), _part(frame, "val")))
    return found.select(
        "rows",
        steady(F.col("positive_rate"), 6).alias("positive_rate"),
        (F.col("pr_auc") > 0).alias("ranked"),
    )


@query(
    "k03_boosted_trees",
    "K3 D7",
    f"""{splits_cte('orders')}
SELECT TransactionID, isFraud, true AS is_probability FROM tx JOIN sp USING (TransactionID) WHERE split = 'test'""",
)
def boosted_trees(spark, folder):
    frame = _frame(spark, folder)
    model = fit_trees(_part(frame, "train"), _part(frame, "val"), _INPUTS, **_SMALL)
    scores = model.score(_part(frame, "test"))
    return scores.select(ID, LABEL, F.col("raw_score").between(0.0, 1.0).alias("is_probability"))


@query("k04_random_search", "K4 K3")
def random_search_query(spark, folder):
    frame = _frame(spark, folder)
    settings = [{"maxDepth": 2}, {"maxDepth": 3}]
    _, history = random_search(
        _part(frame, "train"), _part(frame, "val"), _INPUTS, settings=settings, max_iter=3, stepSize=0.2
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(h["maxDepth"]).alias("max_depth"),
                F.lit(h["trees"]).alias("trees"),
                F.lit(h["val_pr_auc"]).alias("val_pr_auc"),
            )
            for h in history
        ]
    )
    return frame.limit(1).select(F.inline(rows))


@query("k08_calibrator_choice", "K8 K5 K6 K7")
def calibrator_choice(spark, folder):
    rows = materialize(scored(spark, folder, "orders"), "scores")
    return choose_method(fold_losses(rows, "score"))


# The best non-decreasing fit at x is the largest, over starts a <= x, of the smallest mean of any
# run from a to an end b >= x.
_ISOTONIC_SQL = f"""{scored_sql('orders')},
g AS (SELECT score, count(*) AS w, sum(isFraud) AS y, row_number() OVER (ORDER BY score) AS i FROM sc GROUP BY score),
c AS (SELECT i, score, sum(w) OVER o AS cw, sum(y) OVER o AS cy, w, y FROM g WINDOW o AS (ORDER BY i)),
runs AS (SELECT a.i AS a, b.i AS b, (b.cy - a.cy + a.y)::DOUBLE / (b.cw - a.cw + a.w) AS mean FROM c a JOIN c b ON b.i >= a.i),
low AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM runs),
fit AS (SELECT b AS i, max(least) AS q FROM low GROUP BY b)
SELECT sc.TransactionID, sc.score, {steady_sql('q', 6)} AS calibrated FROM sc JOIN g ON sc.score = g.score JOIN fit ON fit.i = g.i"""


@query("k06_isotonic_probabilities", "K6", _ISOTONIC_SQL)
def isotonic_probabilities(spark, folder):
    rows = scored(spark, folder, "orders")
    out = fit_calibrator(rows, "score", "isotonic").apply(rows, "score", "calibrated")
    return out.select(ID, "score", steady(F.col("calibrated"), 6).alias("calibrated"))


# Small ranges and no broadcast: the route that many distinct scores take.
_CUT = {"per_range": 64}
_MERGED = {"held_blocks": -1, "whole_below": 0}


@query("k06_isotonic_in_ranges", "K6", _ISOTONIC_SQL)
def isotonic_in_ranges(spark, folder):
    rows = scored(spark, folder, "orders").withColumn("_one", F.lit(1))
    blocks = fit_blocks(rows, "score", LABEL, "_one", **_CUT)
    out = apply_blocks(rows, blocks, "score", "calibrated", **_MERGED)
    return out.select(ID, "score", steady(F.col("calibrated"), 6).alias("calibrated"))


@query(
    "k06_isotonic_folds",
    "K6 K7",
    f"""{scored_sql('orders')}, tr AS (SELECT fold, score, isFraud, TransactionID FROM sc, range(5) f(fold) WHERE TransactionID % 5 <> fold),
g AS (SELECT fold, score, count(*) AS w, sum(isFraud) AS y, row_number() OVER (PARTITION BY fold ORDER BY score) AS i FROM tr GROUP BY fold, score),
c AS (SELECT fold, i, sum(w) OVER o AS cw, sum(y) OVER o AS cy, w, y FROM g WINDOW o AS (PARTITION BY fold ORDER BY i)),
runs AS (SELECT a.fold, a.i AS a, b.i AS b, (b.cy - a.cy + a.y)::DOUBLE / (b.cw - a.cw + a.w) AS mean
  FROM c a JOIN c b ON a.fold = b.fold AND b.i >= a.i),
low AS (SELECT fold, a, b, min(mean) OVER (PARTITION BY fold, a ORDER BY b DESC) AS least FROM runs),
fit AS (SELECT fold, b AS i, max(least) AS q FROM low GROUP BY fold, b)
SELECT CAST(tr.fold AS INT) AS fold, tr.TransactionID, {steady_sql('q', 6)} AS calibrated
FROM tr JOIN g ON tr.fold = g.fold AND tr.score = g.score JOIN fit ON fit.fold = g.fold AND fit.i = g.i""",
)
def isotonic_folds(spark, folder):
    """Five fits in one pass, each to the rows outside its fold."""
    folds = F.explode(F.array_except(F.array(*map(F.lit, range(5))), F.array((F.col(ID) % 5).cast("int"))))
    rows = scored(spark, folder, "orders").select(ID, LABEL, "score", F.lit(1).alias("_one"), folds.alias("fold"))
    blocks = fit_blocks(rows, "score", LABEL, "_one", by=["fold"])
    out = apply_blocks(rows, blocks, "score", "calibrated", by=["fold"])
    return out.select("fold", ID, steady(F.col("calibrated"), 6).alias("calibrated"))


@query("k05_platt_probabilities", "K5")
def platt_probabilities(spark, folder):
    rows = scored(spark, folder, "orders")
    out = fit_calibrator(rows, "score", "platt").apply(rows, "score", "calibrated")
    return out.select(ID, LABEL, "score", "calibrated")


@query(
    "k05_platt_keeps_the_base_rate",
    "K5",
    f"""{scored_sql('orders')}
SELECT count(*) AS "rows", {steady_sql('avg(isFraud)', 3)} AS mean_probability FROM sc""",
)
def platt_keeps_the_base_rate(spark, folder):
    """The intercept is not penalised, so the mean probability equals the positive rate."""
    rows = scored(spark, folder, "orders")
    out = fit_calibrator(rows, P, "platt").apply(rows, P, "calibrated")
    return out.agg(
        F.count(F.lit(1)).alias("rows"), steady(F.avg("calibrated"), 3).alias("mean_probability")
    )


@query("k09_training_metrics", "K9 K3 K8 D10 D12 D22 D23")
def training_metrics(spark, folder):
    inputs = TreeInputs((*BASELINE_COLUMNS, "signal"), (PRODUCT,))
    found = train(
        _frame(spark, folder), inputs, settings=[{}], folds=2, max_iter=8, maxDepth=4, stepSize=0.2
    )
    return found.metrics


@query(
    "k10_batch_scoring",
    "K10 M10 A15 B12 B14",
    f"""{splits_cte('orders')}
SELECT TransactionID, 'r1' AS run, 'm1' AS model_run, true AS decided, 'v1' AS code_version
FROM sp WHERE split = 'test'""",
)
def batch_scoring(spark, folder):
    frame = _frame(spark, folder)
    inputs = TreeInputs((*BASELINE_COLUMNS, "D3n"), (PRODUCT,))
    derivations = [Derivation("D3n", "days_since_to_start_day", ("D3",))]
    ready = apply_derivations(frame, derivations)
    model = fit_trees(_part(ready, "train"), _part(ready, "val"), inputs, **_SMALL)
    val = materialize(model.score(_part(ready, "val")), "val-scores")
    calibrator = fit_calibrator(val, "raw_score", "platt")
    out = score_rows(_part(frame, "test"), model, calibrator, 0.25, derivations=derivations)
    path = scratch_path(spark, "prediction-log")
    log_predictions(out, path, run="r1", model_run="m1", threshold=0.25, code_version="v1")
    decided = (F.col("action") == "block") == (F.col("calibrated_probability") > F.col("threshold"))
    return read_log(spark, path).select(ID, "run", "model_run", decided.alias("decided"), "code_version")


@query(
    "k10_stored_bundle",
    "K10 M9 M10 L10 B14 A15 H5",
    f"""{splits_cte('orders')}
SELECT TransactionID, 'run-2' AS model_run, 'scoring-1' AS run, true AS same_score, true AS same_probability,
  true AS same_action, count(*) OVER () AS logged FROM sp WHERE split = 'test'""",
)
def stored_bundle(spark, folder):
    """Fit, store, promote; then resolve the promoted run, read it by path, score, and log the run twice."""
    frame = _frame(spark, folder)
    derivations = (
        Derivation("D3n", "days_since_to_start_day", ("D3",)),
        Derivation("device_count", "frequency_encode", ("DeviceInfo",)),
    )
    maps = materialize(frequency_map(_part(frame, "train"), ["DeviceInfo"]), "fitted-maps")
    inputs = TreeInputs((*BASELINE_COLUMNS, "D3n", "device_count"), (PRODUCT,))
    ready = apply_derivations(frame, derivations, maps)
    model = fit_trees(_part(ready, "train"), _part(ready, "val"), inputs, **_SMALL)
    val = materialize(model.score(_part(ready, "val")), "val-scores")
    calibrator = fit_calibrator(val, "raw_score", "isotonic")
    contract = _contract_of(spark, inputs)
    stamp = fingerprint(contract, [r["line"] for r in map_lines(maps).collect()]).first()["fingerprint"]
    root = scratch_path(spark, "bundles")
    fitted = Bundle("run-2", model, calibrator, 0.25, stamp, "v1", derivations, maps)
    save_bundle(fitted, root)

    runs = frame.limit(1).select(F.lit("run-2").alias("run"), F.lit(2).alias("updated_at"))
    promotions = runs.select("run", F.lit(stamp).alias("fingerprint"), F.col("updated_at").alias("promoted_at"))
    keep = [ID]
    bundle, scores = score_promoted(_part(frame, "test"), root, promotions, runs, contract, stamp, keep=keep)
    log = scratch_path(spark, "prediction-log")
    for _ in range(2):
        log_predictions(
            scores, log, run="scoring-1", model_run=bundle.run, threshold=bundle.threshold, code_version=bundle.code_version
        )
    before = fitted.score(_part(frame, "test"), keep=keep).select(
        ID, *(F.col(c).alias(f"_{c}") for c in ("raw_score", "calibrated_probability", "action"))
    )
    logged = read_log(spark, log)
    total = logged.agg(F.count(F.lit(1)).alias("logged"))
    return logged.join(before, ID).crossJoin(F.broadcast(total)).select(  # one row
        ID,
        "model_run",
        "run",
        F.col("raw_score").eqNullSafe(F.col("_raw_score")).alias("same_score"),
        F.col("calibrated_probability").eqNullSafe(F.col("_calibrated_probability")).alias("same_probability"),
        (F.col("action") == F.col("_action")).alias("same_action"),
        "logged",
    )


def _contract_of(spark, inputs):
    """A contract that admits exactly these features; one row per column."""
    names = [*inputs.numeric, *inputs.categorical]
    rows = [(k, c, "request", "number" if c in inputs.numeric else "text", True, None) for k, c in enumerate(names, 1)]
    return spark.createDataFrame(
        rows, "position int, column string, source string, dtype string, admitted boolean, rejected_by string"
    )


def _explained(spark, folder):
    frame = _frame(spark, folder)
    model = fit_baseline(_part(frame, "train"))
    return contributions(model, _part(frame, "test"))


@query(
    "k11_contributions_add_up",
    "K11",
    f"""{splits_cte('orders')}
SELECT count(*) AS "rows", count(*) AS additive FROM sp WHERE split = 'test'""",
)
def contributions_add_up(spark, folder):
    explained = _explained(spark, folder)
    total = F.aggregate("parts", F.col("base"), lambda acc, p: acc + p["part"])
    odds = F.log(F.col("y_score") / (1 - F.col("y_score")))
    return explained.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(total - odds) < 1e-6).alias("additive")
    )


@query("k11_global_attribution", "K11 D27 F1")
def global_attribution_query(spark, folder):
    return global_attribution(_explained(spark, folder))


@query("k11_top_decisions", "K11 F2 F3")
def top_decisions_query(spark, folder):
    return top_decisions(_explained(spark, folder))


@query("k12_seed_noise", "K12 D26")
def seed_noise(spark, folder):
    frame = _frame(spark, folder)
    models = fit_all_trees(
        _part(frame, "train"), _part(frame, "val"), _INPUTS,
        settings=[{"seed": seed} for seed in (1, 2, 3)], subsamplingRate=0.7, **{**_SMALL, "max_iter": 3},
    )
    runs = None
    for model in models:
        found = ranking_metrics(model.score(_part(frame, "test")), "raw_score").select(
            "pr_auc", "roc_auc"
        )
        runs = found if runs is None else runs.unionByName(found)
    return noise_summary(runs, ["pr_auc", "roc_auc"])
