"""Ranking, threshold, calibration and segment metrics on a scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeward.names import AMOUNT, ID, PRODUCT
from timeward.operators.metrics import (
    budget_threshold_row,
    calibration_error,
    cheapest_threshold,
    class_balance,
    confusion,
    cost_curve,
    cost_grid,
    curve_at,
    dominant_segment,
    evaluate_thresholds,
    noise_summary,
    operating_cost,
    operating_point,
    precision_recall_points,
    probability_losses,
    ranking_from_curve,
    product_segments,
    ranking_metrics,
    reliability,
    roc_points,
    run_metrics,
    score_curve,
    score_histogram,
    score_summary,
    seen_segments,
)
from timeward.operators.ordered import running_totals
from timeward.registry import query, steady, steady_sql
from timeward.registry.adapters import scored, scored_sql

P = "probability"


def curve_cte(by: str = "", rows: str = "sc", score: str = P) -> str:
    """CTE ``cv``: per distinct score, highest first, with running and overall totals."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""g AS (SELECT {keys}{score}, count(*) FILTER (isFraud = 1) AS pos,
  count(*) FILTER (isFraud = 0) AS neg,
  coalesce(sum(TransactionAmt) FILTER (isFraud = 1), 0) AS lost FROM {rows} GROUP BY {keys}{score}),
cv AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(lost) OVER w AS cum_lost,
  sum(pos) OVER a AS all_pos, sum(neg) OVER a AS all_neg, sum(lost) OVER a AS all_lost
  FROM g WINDOW w AS ({part}ORDER BY {score} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  a AS ({part}ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


_AP = "sum(pos::DOUBLE / nullif(all_pos, 0) * cum_pos / (cum_pos + cum_neg))"
_ROC = "sum(neg * (cum_pos - pos / 2.0::DOUBLE)) / nullif(max(all_pos) * max(all_neg), 0)"


def _steady(df, *names, digits=6):
    return df.withColumns({n: steady(F.col(n), digits) for n in names})


for _source in ("events", "orders"):
    query(
        f"d13_ranking_{_source}",
        "D13 D14",
        f"""{scored_sql(_source)}, {curve_cte()}
SELECT CAST(max(all_pos + all_neg) AS BIGINT) AS "rows", CAST(max(all_pos) AS BIGINT) AS positives,
  {steady_sql(_AP, 6)} AS pr_auc, {steady_sql(_ROC, 6)} AS roc_auc FROM cv""",
    )(
        lambda spark, folder, s=_source: _steady(
            ranking_metrics(scored(spark, folder, s), P), "pr_auc", "roc_auc"
        )
    )


    # The route for curves beyond one task, forced by fixed cuts.
    query(
        f"d13_ranking_in_ranges_{_source}",
        "D13 D14",
        f"""{scored_sql(_source)}, {curve_cte()}
SELECT CAST(max(all_pos + all_neg) AS BIGINT) AS "rows", CAST(max(all_pos) AS BIGINT) AS positives,
  {steady_sql(_AP, 6)} AS pr_auc, {steady_sql(_ROC, 6)} AS roc_auc FROM cv""",
    )(
        lambda spark, folder, s=_source: _steady(
            ranking_from_curve(
                score_curve(scored(spark, folder, s), P, edges=[i / 16 for i in range(1, 16)])
            ),
            "pr_auc",
            "roc_auc",
        )
    )


@query(
    "d13_ranking_by_product",
    "D13 D14 D23",
    f"""{scored_sql('orders')}, {curve_cte('ProductCD')}
SELECT ProductCD, CAST(max(all_pos + all_neg) AS BIGINT) AS "rows", CAST(max(all_pos) AS BIGINT) AS positives,
  {steady_sql(_AP, 6)} AS pr_auc, {steady_sql(_ROC, 6)} AS roc_auc FROM cv GROUP BY ProductCD""",
)
def ranking_by_product(spark, folder):
    found = ranking_metrics(scored(spark, folder, "orders"), P, by=[PRODUCT])
    return _steady(found, "pr_auc", "roc_auc")


@query(
    "f08_scores_in_order",
    "F8",
    f"""{scored_sql('orders')}
SELECT score, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY score) AS BIGINT) AS cum_n,
  CAST(sum(count(*)) OVER () AS BIGINT) AS all_n FROM sc GROUP BY score""",
)
def scores_in_order(spark, folder):
    return running_totals(scored(spark, folder, "orders"), "score", {"n": F.count(F.lit(1))})


@query(
    "d07_class_balance",
    "D7",
    f"""{scored_sql('orders')}
SELECT count(*) AS "rows", count(*) FILTER (isFraud = 1) AS positives,
  {steady_sql('(count(*) - count(*) FILTER (isFraud = 1)) / nullif(count(*) FILTER (isFraud = 1), 0)::DOUBLE', 6)} AS positive_weight FROM sc""",
)
def class_balance_query(spark, folder):
    return _steady(class_balance(scored(spark, folder, "orders")), "positive_weight")


@query(
    "d08_confusion",
    "D8",
    f"""{scored_sql('orders')}
SELECT count(*) FILTER (probability >= 0.5::DOUBLE AND isFraud = 1) AS tp,
  count(*) FILTER (probability >= 0.5::DOUBLE AND isFraud = 0) AS fp,
  count(*) FILTER (probability < 0.5::DOUBLE AND isFraud = 1) AS fn,
  count(*) FILTER (probability < 0.5::DOUBLE AND isFraud = 0) AS tn FROM sc""",
)
def confusion_query(spark, folder):
    return confusion(scored(spark, folder, "orders"), P, 0.5)


@query(
    "d09_operating_cost",
    "D9",
    f"""{scored_sql('orders')}
SELECT {steady_sql('sum(TransactionAmt) FILTER (probability < 0.5::DOUBLE AND isFraud = 1) + 5.0::DOUBLE * count(*) FILTER (probability >= 0.5::DOUBLE AND isFraud = 0)', 3)} AS cost FROM sc""",
)
def operating_cost_query(spark, folder):
    return _steady(operating_cost(scored(spark, folder, "orders"), P, 0.5), "cost", digits=3)


_AT = """SELECT t.threshold,
  count(*) FILTER (b AND isFraud = 0) / nullif(count(*) FILTER (isFraud = 0), 0)::DOUBLE AS false_positive_rate,
  count(*) FILTER (b AND isFraud = 1) / nullif(count(*) FILTER (isFraud = 1), 0)::DOUBLE AS true_positive_rate,
  coalesce(count(*) FILTER (b AND isFraud = 1) / nullif(count(*) FILTER (b), 0)::DOUBLE, 0) AS "precision",
  count(*) FILTER (b) AS blocked, count(*) FILTER (b AND isFraud = 1) AS caught,
  count(*) FILTER (NOT b AND isFraud = 1) AS missed, count(*) FILTER (b AND isFraud = 0) AS false_alarms,
  coalesce(sum(TransactionAmt) FILTER (NOT b AND isFraud = 1), 0) + 5.0::DOUBLE * count(*) FILTER (b AND isFraud = 0) AS total_cost,
  coalesce(sum(TransactionAmt) FILTER (NOT b AND isFraud = 1), 0) AS amount_missed,
  coalesce(sum(TransactionAmt) FILTER (b AND isFraud = 1), 0) AS amount_caught
FROM (SELECT *, probability >= threshold AS b FROM sc CROSS JOIN {grid}) t GROUP BY t.threshold"""
_RATES = ("false_positive_rate", "true_positive_rate", "precision")
_SUMS = ("total_cost", "amount_missed", "amount_caught")


def _at_sql(grid: str) -> str:
    shown = [steady_sql(c, 6) + f' AS "{c}"' for c in _RATES]
    shown += [steady_sql(c, 2) + f" AS {c}" for c in _SUMS]
    return (
        f"SELECT threshold, {', '.join(shown)}, blocked, caught, missed, false_alarms"
        f" FROM ({_AT.format(grid=grid)})"
    )


def _shown_thresholds(df):
    return _steady(_steady(df, *_RATES), *_SUMS, digits=2)


@query(
    "d10_thresholds_evaluated",
    "D10 C12",
    f"{scored_sql('orders')}\n"
    + _at_sql("(SELECT unnest([0.1, 0.25, 0.4, 0.5, 0.9995, 1.1])::DOUBLE AS threshold)"),
)
def thresholds_evaluated(spark, folder):
    rows = scored(spark, folder, "orders")
    listed = F.array(*[F.lit(t) for t in (0.1, 0.25, 0.4, 0.5, 0.9995, 1.1)])
    thresholds = rows.limit(1).select(F.explode(listed).alias("threshold"))
    return _shown_thresholds(evaluate_thresholds(rows, thresholds, P))


_BUDGETS = (0.005, 0.01, 0.02, 0.05)


@query(
    "d11_budget_thresholds",
    "D11 F4",
    f"{scored_sql('orders')}, {curve_cte()}\n"
    + "\nUNION ALL ".join(
        f"SELECT {b}::DOUBLE AS budget, min(probability) FILTER (cum_neg / all_neg::DOUBLE <= {b}::DOUBLE) AS threshold FROM cv"
        for b in _BUDGETS
    ),
)
def budget_thresholds(spark, folder):
    curve = score_curve(scored(spark, folder, "orders"), P)
    rate = F.col("cum_neg") / F.col("all_neg")
    fits = [F.min(F.when(rate <= F.lit(b), F.col(P))).alias(f"_{i}") for i, b in enumerate(_BUDGETS)]
    pairs = F.array(
        *[
            F.struct(F.lit(b).alias("budget"), F.col(f"_{i}").alias("threshold"))
            for i, b in enumerate(_BUDGETS)
        ]
    )
    return curve.agg(*fits).select(F.inline(pairs))


@query(
    "d11_budget_choice_evaluated",
    "D11 D10",
    f"""{scored_sql('orders')}, {curve_cte()},
pick AS (SELECT min(probability) FILTER (cum_neg / all_neg::DOUBLE <= 0.01::DOUBLE) AS threshold FROM cv)
{_at_sql('pick')}""",
)
def budget_choice_evaluated(spark, folder):
    curve = score_curve(scored(spark, folder, "orders"), P, amount=AMOUNT)
    return _shown_thresholds(curve_at(curve, budget_threshold_row(curve, P), P))


_GRID = """grid AS (SELECT DISTINCT unnest(quantile_cont(probability,
  list_transform(range(200), lambda i: i / 199.0::DOUBLE))) AS threshold FROM sc)"""


@query(
    "d05_quantile_grid",
    "D5",
    f"""{scored_sql('orders')}, {_GRID}
SELECT DISTINCT {steady_sql('threshold', 6)} AS threshold FROM grid""",
)
def quantile_grid(spark, folder):
    return _steady(cost_grid(scored(spark, folder, "orders"), P), "threshold").distinct()


@query(
    "d12_cheapest_threshold",
    "D12 C12 F4",
    f"""{scored_sql('events')}, {_GRID}
SELECT {steady_sql('threshold', 6)} AS threshold, {steady_sql('total_cost', 2)} AS total_cost
FROM ({_AT.format(grid='grid')}) ORDER BY total_cost, threshold LIMIT 1""",
)
def cheapest_threshold_query(spark, folder):
    found = cheapest_threshold(cost_curve(scored(spark, folder, "events"), P))
    return _steady(_steady(found, "threshold"), "total_cost", digits=2)


@query(
    "d21_cost_curve",
    "D21 D9 C12",
    f"""{scored_sql('events')}, {_GRID}, both_ AS (SELECT threshold FROM grid UNION SELECT 0.123::DOUBLE UNION SELECT 0.456::DOUBLE)
SELECT {steady_sql('threshold', 6)} AS threshold, {steady_sql('total_cost', 2)} AS total_cost
FROM ({_AT.format(grid='both_')})""",
)
def cost_curve_query(spark, folder):
    found = cost_curve(scored(spark, folder, "events"), P, extra=[0.123, 0.456])
    return _steady(_steady(found, "threshold"), "total_cost", digits=2)


@query(
    "d15_probability_losses",
    "D15 H10",
    f"""{scored_sql('orders')}
SELECT {steady_sql('avg((probability - isFraud) * (probability - isFraud))', 6)} AS brier,
 {steady_sql('avg(-(isFraud * ln(q) + (1 - isFraud) * ln(1.0::DOUBLE - q)))', 6)} AS log_loss
FROM (SELECT *, least(greatest(probability, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE) AS q FROM sc)""",
)
def probability_losses_query(spark, folder):
    return _steady(probability_losses(scored(spark, folder, "orders"), P), "brier", "log_loss")


_BINS = """bins AS (SELECT CAST(i AS INT) AS bin, i / 10.0::DOUBLE AS lower, (i + 1) / 10.0::DOUBLE AS upper FROM range(10) r(i)),
rel AS (SELECT b.bin, any_value(b.lower) AS lower, any_value(b.upper) AS upper,
  coalesce(avg(sc.p), 0) AS mean_predicted, coalesce(avg(sc.isFraud), 0) AS observed_rate, count(sc.p) AS n
  FROM bins b LEFT JOIN (SELECT *, probability * 0.8::DOUBLE AS p FROM sc) sc ON sc.p >= b.lower AND sc.p < b.upper GROUP BY b.bin)"""


def _squeezed(spark, folder):
    """Probabilities below 0.8, which leaves the top bins empty."""
    rows = scored(spark, folder, "orders")
    return rows.withColumn(P, F.col(P) * F.lit(0.8))


@query(
    "d16_reliability",
    "D16",
    f"""{scored_sql('orders')}, {_BINS}
SELECT bin, {steady_sql('lower', 4)} AS lower, {steady_sql('upper', 4)} AS upper,
  {steady_sql('mean_predicted', 6)} AS mean_predicted, {steady_sql('observed_rate', 6)} AS observed_rate, n AS "rows" FROM rel""",
)
def reliability_query(spark, folder):
    found = reliability(_squeezed(spark, folder), P)
    return _steady(_steady(found, "mean_predicted", "observed_rate"), "lower", "upper", digits=4)


@query(
    "d17_calibration_error",
    "D17",
    f"""{scored_sql('orders')}, {_BINS}
SELECT {steady_sql('sum(n * abs(mean_predicted - observed_rate)) / sum(n)', 6)} AS expected_calibration_error FROM rel""",
)
def calibration_error_query(spark, folder):
    found = calibration_error(reliability(_squeezed(spark, folder), P))
    return _steady(found, "expected_calibration_error")


@query(
    "d18_precision_recall_points",
    "D18",
    f"""{scored_sql('orders')}, {curve_cte()}
SELECT probability AS threshold, {steady_sql('cum_pos::DOUBLE / (cum_pos + cum_neg)', 6)} AS "precision",
  {steady_sql('cum_pos::DOUBLE / all_pos', 6)} AS recall FROM cv""",
)
def precision_recall_query(spark, folder):
    points = precision_recall_points(score_curve(scored(spark, folder, "orders"), P), P)
    return _steady(points, "precision", "recall")


@query(
    "d18_operating_point",
    "D18",
    f"""{scored_sql('orders')}, {curve_cte()}
SELECT probability AS threshold, {steady_sql('cum_pos::DOUBLE / (cum_pos + cum_neg)', 6)} AS "precision",
  {steady_sql('cum_pos::DOUBLE / all_pos', 6)} AS recall FROM cv WHERE probability >= 0.3333::DOUBLE
ORDER BY probability LIMIT 1""",
)
def operating_point_query(spark, folder):
    points = precision_recall_points(score_curve(scored(spark, folder, "orders"), P), P)
    return _steady(operating_point(points, 0.3333), "precision", "recall")


@query(
    "d19_roc_points",
    "D19",
    f"""{scored_sql('orders')}, {curve_cte()},
nx AS (SELECT *, lead(pos) OVER o AS np, lead(neg) OVER o AS nn, row_number() OVER o AS rn FROM cv WINDOW o AS (ORDER BY probability DESC)),
kept AS (SELECT row_number() OVER (ORDER BY probability DESC) AS position, * FROM nx
  WHERE rn = 1 OR np IS NULL OR np <> pos OR nn <> neg),
pts AS (SELECT 0::BIGINT AS position, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 1.0::DOUBLE AS t
  UNION ALL SELECT position, cum_neg / all_neg::DOUBLE, cum_pos / all_pos::DOUBLE, probability FROM kept),
n AS (SELECT count(*) AS size FROM pts),
ix AS (SELECT DISTINCT CASE WHEN i = 199 THEN size - 1 ELSE CAST(floor(i * ((size - 1) / 199.0::DOUBLE)) AS BIGINT) END AS position
  FROM n CROSS JOIN range(200) r(i))
SELECT pts.position, {steady_sql('fpr', 6)} AS false_positive_rate, {steady_sql('tpr', 6)} AS true_positive_rate,
  least(greatest(t, 0.0::DOUBLE), 1.0::DOUBLE) AS threshold
FROM pts CROSS JOIN n WHERE size <= 200 OR position IN (SELECT position FROM ix)""",
)
def roc_points_query(spark, folder):
    found = roc_points(score_curve(scored(spark, folder, "orders"), P), P)
    return _steady(found, "false_positive_rate", "true_positive_rate")


@query(
    "d20_score_histogram",
    "D20",
    f"""{scored_sql('orders')}
SELECT CAST(isFraud AS INT) AS label, CAST(least(floor(probability * 50.0::DOUBLE), 49) AS INT) AS bin, count(*) AS "rows"
FROM sc GROUP BY ALL""",
)
def score_histogram_query(spark, folder):
    return score_histogram(scored(spark, folder, "orders"), P)


@query(
    "d22_seen_segments",
    "D22",
    f"""{scored_sql('orders')}, sg AS (SELECT *, CASE card1 % 3 WHEN 0 THEN 'seen' ELSE 'unseen' END AS segment FROM sc),
{curve_cte('segment', 'sg')}
SELECT segment, CAST(max(all_pos + all_neg) AS BIGINT) AS "rows", {steady_sql(_AP, 6)} AS pr_auc FROM cv
GROUP BY segment HAVING max(all_pos) > 0""",
)
def seen_segments_query(spark, folder):
    rows = scored(spark, folder, "orders").withColumn(
        "seen_in_train", F.expr("CASE card1 % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    )
    return _steady(seen_segments(rows, P), "pr_auc")


_SEGMENTS = f"""{curve_cte('ProductCD', '(SELECT * FROM sc WHERE ProductCD IS NOT NULL)')},
seg AS (SELECT ProductCD AS product, CAST(max(all_pos + all_neg) AS BIGINT) AS n, {_AP} AS pr_auc,
  max(all_pos) / max(all_pos + all_neg)::DOUBLE AS positive_rate FROM cv GROUP BY ProductCD
  HAVING max(all_pos + all_neg) >= 500 AND max(all_pos) >= 20)"""


@query(
    "d23_product_segments",
    "D23",
    f"""{scored_sql('orders')}, {_SEGMENTS}
SELECT product, n AS "rows", {steady_sql('pr_auc', 6)} AS pr_auc, {steady_sql('positive_rate', 6)} AS positive_rate FROM seg""",
)
def product_segments_query(spark, folder):
    return _steady(product_segments(scored(spark, folder, "orders"), P), "pr_auc", "positive_rate")


@query(
    "d24_dominant_segment",
    "D24",
    f"""{scored_sql('orders')}, {_SEGMENTS}
SELECT product, n AS "rows", {steady_sql('pr_auc', 6)} AS pr_auc, {steady_sql('positive_rate', 6)} AS positive_rate,
  {steady_sql('share', 6)} AS share
FROM (SELECT *, n / sum(n) OVER ()::DOUBLE AS share FROM seg) WHERE share >= 0.3 ORDER BY n DESC, product LIMIT 1""",
)
def dominant_segment_query(spark, folder):
    found = dominant_segment(product_segments(scored(spark, folder, "orders"), P), share=0.3)
    return _steady(found, "pr_auc", "positive_rate", "share")


@query(
    "d25_score_summary",
    "D25",
    f"""{scored_sql('orders')}
SELECT count(*) AS "rows", {steady_sql('avg(score)', 5)} AS mean_raw, {steady_sql('avg(probability)', 6)} AS mean_calibrated,
  {steady_sql('100.0 * avg(CASE WHEN probability > 0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0 END)', 5)} AS percent_above,
  {steady_sql('quantile_cont(score, 0.5)', 5)} AS median_raw FROM sc""",
)
def score_summary_query(spark, folder):
    found = score_summary(scored(spark, folder, "orders"), "score", P, 0.5)
    found = _steady(found, "mean_raw", "percent_above", "median_raw", digits=5)
    return _steady(found, "mean_calibrated")


@query(
    "b12_block_or_allow",
    "B12",
    f"""{scored_sql('orders')}
SELECT TransactionID, CASE WHEN probability > 0.5::DOUBLE THEN 'block' ELSE 'allow' END AS "action" FROM sc""",
)
def block_or_allow(spark, folder):
    from timeward.operators.decisions import with_action

    return with_action(scored(spark, folder, "orders"), P, 0.5).select(ID, "action")


@query(
    "b12_rows_tied_at_threshold",
    "B12 D8",
    f"""{scored_sql('orders')}, {curve_cte()},
pick AS (SELECT min(probability) FILTER (cum_neg / all_neg::DOUBLE <= 0.05::DOUBLE) AS threshold FROM cv)
SELECT threshold, count(*) FILTER (probability >= threshold) AS blocked_when_measured,
  count(*) FILTER (probability > threshold) AS blocked_when_scored,
  count(*) FILTER (probability = threshold) AS tied FROM sc CROSS JOIN pick GROUP BY threshold""",
)
def rows_tied_at_threshold(spark, folder):
    from timeward.operators.decisions import tied_rows

    rows = scored(spark, folder, "orders")
    return tied_rows(rows, P, budget_threshold_row(score_curve(rows, P), P, budget=0.05))


@query(
    "d26_noise_by_priority",
    "D26",
    f"""WITH runs AS (SELECT o_orderpriority, avg(o_totalprice) AS mean_price, CAST(max(o_orderkey) AS DOUBLE) AS top_key
  FROM orders GROUP BY o_orderpriority),
m AS (SELECT 'mean_price' AS metric, mean_price AS v FROM runs UNION ALL SELECT 'top_key', top_key FROM runs)
SELECT metric, count(*) AS runs, {steady_sql('avg(v)', 4)} AS "mean", {steady_sql('coalesce(stddev_samp(v), 0)', 4)} AS sd,
  {steady_sql('min(v)', 4)} AS low, {steady_sql('max(v)', 4)} AS high, {steady_sql('max(v) - min(v)', 4)} AS "range" FROM m GROUP BY metric""",
)
def noise_by_priority(spark, folder):
    from timeward.registry.adapters import table

    runs = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(F.avg("o_totalprice").alias("mean_price"), F.max("o_orderkey").alias("top_key"))
    )
    found = noise_summary(runs, ["mean_price", "top_key"])
    return _steady(found, "mean", "sd", "low", "high", "range", digits=4)


_KINDS = """kd AS (SELECT TransactionID % 5 AS run, 'raw' AS kind, score AS s, isFraud, TransactionAmt FROM sc
  UNION ALL SELECT TransactionID % 5, 'cal', round(probability * 20) / 20, isFraud, TransactionAmt FROM sc)"""


@query(
    "d26_noise_of_both_scores",
    "D26",
    f"""{scored_sql('orders')}, {_KINDS}, {curve_cte('run, kind', 'kd', 's')},
per AS (SELECT run, kind, {_AP} AS ap, {_ROC} AS roc, count(*)::DOUBLE AS n FROM cv GROUP BY run, kind),
m AS (SELECT kind || '_pr_auc' AS metric, ap AS v FROM per UNION ALL SELECT kind || '_roc_auc', roc FROM per
  UNION ALL SELECT 'distinct_calibrated', n FROM per WHERE kind = 'cal')
SELECT metric, count(*) AS runs, {steady_sql('avg(v)', 5)} AS "mean", {steady_sql('coalesce(stddev_samp(v), 0)', 5)} AS sd,
  {steady_sql('min(v)', 5)} AS low, {steady_sql('max(v)', 5)} AS high, {steady_sql('max(v) - min(v)', 5)} AS "range" FROM m GROUP BY metric""",
)
def noise_of_both_scores(spark, folder):
    """Five runs' rankings by raw scores and by calibrated ones, which a step function ties."""
    rows = scored(spark, folder, "orders").select(
        (F.col("TransactionID") % 5).alias("run"), "isFraud", "TransactionAmt", "score", (F.round(F.col(P) * 20) / 20).alias("calibrated")
    )
    runs = run_metrics(rows, "score", "calibrated", by=["run"])
    found = noise_summary(runs, ["raw_pr_auc", "raw_roc_auc", "cal_pr_auc", "cal_roc_auc", "distinct_calibrated"])
    return _steady(found, "mean", "sd", "low", "high", "range", digits=5)
