"""What the fitted parts compute, on inputs that SQL can follow value by value.

A fitted tree has no SQL counterpart, but everything around the fit has: metrics of given scores, the choice among
settings and calibrators, the parts of a linear score, and a logistic fit, which Newton's method reaches in SQL, too.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from timeward.names import AMOUNT, ID, LABEL, PRODUCT
from timeward.operators.calibration import choose_method, fit_calibrator
from timeward.operators.metrics import budget_threshold, probability_losses, ranking_metrics, score_curve
from timeward.plans.models import (
    BASELINE_COLUMNS,
    _as_doubles,
    baseline_metrics,
    best_setting,
    explained,
    fit_baseline,
    global_attribution,
    sampled_settings,
    top_decisions,
)
from timeward.plans.training import PROBABILITY, RAW, metric_rows
from timeward.registry import query, steady, steady_sql
from timeward.registry.adapters import scored, scored_sql
from timeward.registry.evaluation import _AP, _AT, _GRID, _ROC, curve_cte
from timeward.registry.modelling import _frame, _part
from timeward.session import materialize

P = "probability"


# ---- K1, K2: the baseline --------------------------------------------------------------------


@query(
    "k01_baseline_is_stationary",
    "K1",
    f"SELECT unnest({[*BASELINE_COLUMNS, 'intercept']!r}) AS feature, true AS stationary, (SELECT count(*) FROM orders) > 0 AS fitted",
)
def baseline_is_stationary(spark, folder):
    """At the fitted weights no feature correlates with the residuals: only the optimum has that."""
    train = _part(_frame(spark, folder), "train")
    model = fit_baseline(train)
    out = model.transform(_as_doubles(train, [*BASELINE_COLUMNS, LABEL]))
    residual = vector_to_array("_p")[1] - F.col(LABEL)
    pulls = [F.avg(residual * vector_to_array("_z")[k]).alias(f"_{k}") for k in range(len(BASELINE_COLUMNS))]
    pulls.append(F.avg(residual).alias(f"_{len(BASELINE_COLUMNS)}"))
    names = [*BASELINE_COLUMNS, "intercept"]
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), (F.abs(F.col(f"_{k}")) < 1e-4).alias("stationary")) for k, n in enumerate(names)])
    fitted = any(abs(w) > 0 for w in model.stages[-1].coefficients)
    return out.agg(*pulls).select(F.inline(rows)).withColumn("fitted", F.lit(fitted))


@query(
    "k02_metrics_of_given_scores",
    "K2 D13 D14",
    f"""{scored_sql('orders')}, {curve_cte()}
SELECT CAST(max(all_pos + all_neg) AS BIGINT) AS "rows", {steady_sql('max(all_pos) / max(all_pos + all_neg)::DOUBLE', 6)} AS positive_rate,
  {steady_sql(_AP, 6)} AS pr_auc, {steady_sql(_ROC, 6)} AS roc_auc FROM cv""",
)
def metrics_of_given_scores(spark, folder):
    rows = scored(spark, folder, "orders").select(F.col(LABEL).alias("y_true"), F.col(P).alias("y_score"))
    found = baseline_metrics(rows)
    return found.withColumns({c: steady(F.col(c), 6) for c in ("positive_rate", "pr_auc", "roc_auc")})


# ---- K4: the choice among settings -----------------------------------------------------------

_SETTINGS = 10


@query(
    "k04_choice_among_settings",
    "K4",
    f"""{scored_sql('orders')}, st AS (SELECT *, TransactionID % {_SETTINGS} AS setting FROM sc), {curve_cte('setting', 'st')},
aps AS (SELECT setting, {_AP} AS ap FROM cv GROUP BY setting)
SELECT CAST(setting AS INT) AS setting, {steady_sql('ap', 6)} AS val_pr_auc,
  setting = (SELECT setting FROM aps ORDER BY ap DESC, setting LIMIT 1) AS chosen FROM aps""",
)
def choice_among_settings(spark, folder):
    """Ten sampled settings, each with the precision of a tenth of the scores as its result."""
    settings = sampled_settings(n=_SETTINGS)
    rows = scored(spark, folder, "orders").withColumn("setting", (F.col(ID) % len(settings)).cast("int"))
    found = ranking_metrics(rows, P, by=["setting"]).select("setting", "pr_auc").collect()
    scores = [dict(map(tuple, found)).get(k) for k in range(len(settings))]
    made = [(k, s, k == best_setting(scores)) for k, s in enumerate(scores)]
    shown = spark.createDataFrame(made, "setting int, val_pr_auc double, chosen boolean")
    return shown.withColumn("val_pr_auc", steady(F.col("val_pr_auc"), 6))


# ---- K5: Platt's fit -------------------------------------------------------------------------


def _newton(steps: int) -> str:
    """CTEs of a logistic fit to grouped points ``(s, w, y)``: log loss plus half the squared weight."""
    parts = ["n0 AS (SELECT ln(sum(y) / (sum(w) - sum(y))) AS a, 0.0::DOUBLE AS b FROM pt)"]
    for k in range(steps):
        parts.append(f"""q{k} AS (SELECT a, b, s, w, y, 1 / (1 + exp(-(a + b * s))) AS p FROM pt CROSS JOIN n{k}),
h{k} AS (SELECT any_value(a) AS a, any_value(b) AS b, sum(w * p - y) AS ga, sum((w * p - y) * s) + any_value(b) AS gb,
  sum(w * p * (1 - p)) AS haa, sum(w * p * (1 - p) * s) AS hab, sum(w * p * (1 - p) * s * s) + 1 AS hbb FROM q{k}),
n{k + 1} AS (SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
  b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM h{k})""")
    return ",\n".join(parts)


@query(
    "k05_platt_against_newton",
    "K5",
    f"""{scored_sql('orders')}, pt AS (SELECT probability AS s, count(*)::DOUBLE AS w, sum(isFraud)::DOUBLE AS y FROM sc GROUP BY probability),
{_newton(12)}
SELECT TransactionID, {steady_sql('1 / (1 + exp(-(a + b * probability)))', 4)} AS calibrated FROM sc CROSS JOIN n12""",
)
def platt_against_newton(spark, folder):
    rows = scored(spark, folder, "orders")
    out = fit_calibrator(rows, P, "platt").apply(rows, P, "calibrated")
    return out.select(ID, steady(F.col("calibrated"), 4).alias("calibrated"))


# ---- K8: the choice of a calibrator ----------------------------------------------------------

_FOLD_SQL = """SELECT TransactionID % 5 AS fold, 'isotonic' AS method, probability AS p, isFraud AS y FROM sc
UNION ALL SELECT TransactionID % 5, 'platt', probability * 0.5 + 0.2, isFraud FROM sc"""
_LOSS = "avg(-(y * ln(greatest(p, 1e-15)) + (1 - y) * ln(greatest(1 - p, 1e-15))))"


def _choice_sql(budget: float) -> str:
    return f"""{scored_sql('orders')}, fo AS ({_FOLD_SQL}),
ls AS (SELECT fold, method, {_LOSS} AS log_loss, avg(p) * (CASE method WHEN 'platt' THEN 0.01::DOUBLE ELSE 0.02::DOUBLE END) AS pr_auc_loss
  FROM fo GROUP BY fold, method),
mn AS (SELECT method, avg(log_loss) AS log_loss, avg(pr_auc_loss) AS pr_auc_loss FROM ls GROUP BY method),
pick AS (SELECT coalesce((SELECT method FROM mn WHERE pr_auc_loss <= {budget}::DOUBLE ORDER BY log_loss LIMIT 1),
  (SELECT method FROM mn ORDER BY pr_auc_loss LIMIT 1)) AS best)
SELECT {budget}::DOUBLE AS budget, method, {steady_sql('log_loss', 6)} AS log_loss, {steady_sql('pr_auc_loss', 6)} AS pr_auc_loss,
  pr_auc_loss > {budget}::DOUBLE AS disqualified, method = best AS chosen FROM mn CROSS JOIN pick"""


_BUDGETS = (0.0, 0.0065, 0.5)


@query(
    "k08_choice_over_losses",
    "K8",
    "\nUNION ALL ".join(f"SELECT * FROM ({_choice_sql(b)})" for b in _BUDGETS),
)
def choice_over_losses(spark, folder):
    """Two transforms stand for the methods; the budget decides which of them may win."""
    rows = scored(spark, folder, "orders")
    method = lambda name, p: rows.select((F.col(ID) % 5).alias("fold"), F.lit(name).alias("method"), p.alias("p"), LABEL)
    both = method("isotonic", F.col(P)).unionByName(method("platt", F.col(P) * 0.5 + 0.2))
    groups = ["fold", "method"]
    ranked = both.groupBy(*groups).agg((F.avg("p") * F.when(F.col("method") == "platt", 0.01).otherwise(0.02)).alias("pr_auc_loss"))
    losses = materialize(probability_losses(both, "p", by=groups).join(ranked, groups), "losses")
    found = None
    for budget in _BUDGETS:
        one = choose_method(losses, budget=budget).withColumn("budget", F.lit(budget))
        found = one if found is None else found.unionByName(one)
    return found.withColumns({c: steady(F.col(c), 6) for c in ("log_loss", "pr_auc_loss")})


# ---- K9: the metrics of a training run -------------------------------------------------------


def _metric_sql() -> str:
    rows = "(SELECT TransactionID % 2 = 0 AS val, TransactionID % 3 = 0 AS seen, * FROM sc)"
    raw = curve_cte("val", "sp", score="score").replace("g AS (", "rg AS (", 1).replace("FROM g ", "FROM rg ", 1).replace("cv AS (", "rv AS (", 1)
    seen = curve_cte("seen", "ts").replace("g AS (", "ng AS (", 1).replace("FROM g ", "FROM ng ", 1).replace("cv AS (", "nv AS (", 1)
    product = curve_cte("ProductCD", "(SELECT * FROM ts WHERE ProductCD IS NOT NULL)").replace("g AS (", "pg AS (", 1).replace("FROM g ", "FROM pg ", 1).replace("cv AS (", "pv AS (", 1)
    at = _AT.replace("FROM sc", "FROM {rows}")
    named = {
        "val_pr_auc": f"SELECT {_AP} FROM cv WHERE val",
        "test_pr_auc": f"SELECT {_AP} FROM cv WHERE NOT val",
        "test_roc_auc": f"SELECT {_ROC} FROM cv WHERE NOT val",
        "test_positive_rate": "SELECT avg(isFraud) FROM ts",
        "uncalibrated_test_pr_auc": f"SELECT {_AP} FROM rv WHERE NOT val",
        "uncalibrated_test_roc_auc": f"SELECT {_ROC} FROM rv WHERE NOT val",
        "threshold": "SELECT threshold FROM pick",
        "threshold_false_positive_rate": "SELECT false_positive_rate FROM av",
        "threshold_recall": "SELECT true_positive_rate FROM av",
        "threshold_precision": 'SELECT "precision" FROM av',
        "cost_at_budget_threshold": "SELECT total_cost FROM av",
        "test_threshold_false_positive_rate": "SELECT false_positive_rate FROM atest",
        "test_threshold_recall": "SELECT true_positive_rate FROM atest",
        "test_threshold_precision": 'SELECT "precision" FROM atest',
        "cost_minimising_threshold": "SELECT threshold FROM cheap",
        "cost_at_cost_minimising_threshold": "SELECT total_cost FROM cheap",
        "test_brier": "SELECT avg((probability - isFraud) * (probability - isFraud)) FROM ts",
        "test_log_loss": "SELECT avg(-(isFraud * ln(least(greatest(probability, 1e-15), 1 - 1e-15)) + (1 - isFraud) * ln(1 - least(greatest(probability, 1e-15), 1 - 1e-15)))) FROM ts",
        "test_expected_calibration_error": "SELECT sum(n * abs(mp - obs)) / sum(n) FROM relb",
    }
    each = [f"SELECT '{n}' AS metric, ({text})::DOUBLE AS value" for n, text in named.items()]
    word = "CASE WHEN seen THEN 'seen' ELSE 'unseen' END"
    each += [
        f"SELECT 'test_pr_auc_' || {word}, {_AP} FROM nv GROUP BY seen HAVING max(all_pos) > 0",
        f"SELECT {word} || '_rows', max(all_pos + all_neg) FROM nv GROUP BY seen HAVING max(all_pos) > 0",
        "SELECT 'test_pr_auc_product_' || product, ap FROM seg",
        "SELECT 'product_' || product || '_rows', n FROM seg",
        "SELECT 'product_' || product || '_positive_rate', rate FROM seg",
    ]
    union = "\nUNION ALL ".join(each)
    return f"""{scored_sql('orders')}, sp AS {rows}, vl AS (SELECT * FROM sp WHERE val), ts AS (SELECT * FROM sp WHERE NOT val),
{curve_cte('val', 'sp')}, {raw}, {seen}, {product},
seg AS (SELECT ProductCD AS product, max(all_pos + all_neg) AS n, {_AP} AS ap, max(all_pos) / max(all_pos + all_neg)::DOUBLE AS rate
  FROM pv GROUP BY ProductCD HAVING max(all_pos + all_neg) >= 500 AND max(all_pos) >= 20),
pick AS (SELECT min(probability) FILTER (cum_neg / all_neg::DOUBLE <= 0.01::DOUBLE) AS threshold FROM cv WHERE val),
av AS ({at.format(rows='vl', grid='pick')}), atest AS ({at.format(rows='ts', grid='pick')}),
{_GRID.replace('FROM sc', 'FROM vl')},
cheap AS (SELECT * FROM ({at.format(rows='vl', grid='grid')}) ORDER BY total_cost, threshold LIMIT 1),
relb AS (SELECT least(floor(probability * 10), 9) AS bin, avg(probability) AS mp, avg(isFraud) AS obs, count(*) AS n FROM ts GROUP BY 1)
SELECT metric, {steady_sql('value', 5)} AS value FROM ({union}) WHERE value IS NOT NULL"""


@query("k09_metrics_of_given_scores", "K9 D10 D12 D16 D22 D23", _metric_sql())
def metrics_of_a_run(spark, folder):
    """All metrics of a training run, of scores that are given instead of fitted."""
    rows = scored(spark, folder, "orders").withColumns({RAW: F.col("score"), "seen": F.col(ID) % 3 == 0})
    rows = rows.select(ID, LABEL, AMOUNT, PRODUCT, RAW, F.col(P).alias(PROBABILITY), "seen")
    val, test = rows.where(F.col(ID) % 2 == 0), rows.where(F.col(ID) % 2 == 1)
    threshold = budget_threshold(score_curve(val, PROBABILITY), PROBABILITY)
    found = metric_rows(val, test, threshold, None, seen="seen")
    return found.withColumn("value", steady(F.col("value"), 5))


# ---- K11: parts of a linear score ------------------------------------------------------------

_LINEAR = {"TransactionAmt": (150_000.0, 80_000.0, 0.7), "card1": (700.0, 400.0, -0.4), "score": (5000.0, 3000.0, 0.25)}
_BASE = -1.5
_Z = {c: f"(coalesce(CAST({c} AS DOUBLE), 0.0::DOUBLE) - {m}::DOUBLE) / {s}::DOUBLE" for c, (m, s, _) in _LINEAR.items()}
_PARTS_SQL = f"""{scored_sql('orders')}, rw AS (SELECT *, {_BASE}::DOUBLE + {' + '.join(f'{_LINEAR[c][2]}::DOUBLE * ({z})' for c, z in _Z.items())} AS odds FROM sc),
pt AS ({' UNION ALL '.join(f"SELECT TransactionID, odds, '{c}' AS feature, {_LINEAR[c][2]}::DOUBLE * ({z}) AS part, CAST({c} AS DOUBLE) AS value FROM rw" for c, z in _Z.items())})"""


def _linear(spark, folder):
    rows = scored(spark, folder, "orders")
    z = F.array(*[(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - m) / s for c, (m, s, _) in _LINEAR.items()])
    return explained(rows, z, [w for *_, w in _LINEAR.values()], _BASE, list(_LINEAR))


@query(
    "k11_parts_of_a_given_model",
    "K11",
    f"{_PARTS_SQL}\nSELECT TransactionID, feature, {steady_sql('part', 6)} AS part, value, {steady_sql('1 / (1 + exp(-odds))', 6)} AS y_score FROM pt",
)
def parts_of_a_given_model(spark, folder):
    out = _linear(spark, folder).select(ID, "y_score", F.inline("parts"))
    return out.withColumns({c: steady(F.col(c), 6) for c in ("part", "y_score")})


@query(
    "k11_attribution_of_a_given_model",
    "K11 D27 F1",
    f"{_PARTS_SQL}\nSELECT feature, {steady_sql('avg(abs(part))', 6)} AS mean_abs FROM pt GROUP BY feature ORDER BY avg(abs(part)) DESC, feature LIMIT 2",
)
def attribution_of_a_given_model(spark, folder):
    found = global_attribution(_linear(spark, folder), top=2)
    return found.withColumn("mean_abs", steady(F.col("mean_abs"), 6))


@query(
    "k11_decisions_of_a_given_model",
    "K11 F2 F3",
    f"""{_PARTS_SQL},
best AS (SELECT TransactionID FROM rw ORDER BY 1 / (1 + exp(-odds)) DESC, TransactionID LIMIT 5),
od AS (SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY abs(part) DESC, feature) AS place FROM pt JOIN best USING (TransactionID))
SELECT TransactionID, CAST(place AS INT) AS place, feature, {steady_sql('part', 6)} AS part, value FROM od WHERE place <= 2""",
)
def decisions_of_a_given_model(spark, folder):
    found = top_decisions(_linear(spark, folder), rows=5, drivers=2)
    return found.select(ID, "place", "feature", steady(F.col("part"), 6).alias("part"), "value")
