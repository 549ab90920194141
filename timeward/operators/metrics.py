"""Ranking, calibration and cost metrics from grouped scores.

Rows are reduced to one record per distinct score before anything is ordered, so ties are exact
and the ordered part works on records, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.functions.scalars import clipped
from timeward.names import AMOUNT, LABEL, PRODUCT
from timeward.operators.ordered import (
    accumulate,
    cut_points,
    exact_quantiles,
    quantiles_of,
    running_totals,
    totals_as_of,
    with_next,
)
from timeward.session import materialize

# The grid size, the flat cost of a blocked legitimate row, the allowed share of
# blocked legitimate rows, and the smallest segment worth a number.
COST_CANDIDATES = 200
FALSE_POSITIVE_COST = 5.0
FALSE_POSITIVE_BUDGET = 0.01
SEGMENT_MIN_ROWS = 500
SEGMENT_MIN_POSITIVES = 20
_CLIP = 1e-15


class MetricError(Exception):
    """The rows do not define the metric."""


def _fraud(label: str) -> Column:
    return F.col(label).cast("int") == 1


def score_curve(
    scored: DataFrame,
    score: str,
    label: str = LABEL,
    *,
    amount: str | None = None,
    weight: str | None = None,
    by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Per distinct score, highest first: ``pos``, ``neg`` (and ``lost``, the fraud amount) with
    running and overall totals. ``cum_pos``/``cum_neg`` count rows at or above the score.

    ``weight`` is the number of rows a record stands for.
    """
    if weight is None:
        sums = {"pos": F.count_if(_fraud(label)), "neg": F.count_if(~_fraud(label))}
    else:
        count = lambda which: F.coalesce(F.sum(F.when(which, F.col(weight))), F.lit(0))
        sums = {"pos": count(_fraud(label)), "neg": count(~_fraud(label))}
    if amount is not None:
        sums["lost"] = F.coalesce(
            F.sum(F.when(_fraud(label), F.col(amount).cast("double"))), F.lit(0.0)
        )
    return running_totals(scored, score, sums, by=by, descending=True, edges=edges)


def ranking_from_curve(curve: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Average precision and ROC-AUC, NULL where a class is absent."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    step = F.col("pos") / F.col("all_pos") * precision
    area = F.col("neg") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))
    return (
        curve.groupBy(*by)
        .agg(
            F.max(F.col("all_pos") + F.col("all_neg")).alias("rows"),
            F.max("all_pos").alias("positives"),
            F.sum(F.when(F.col("all_pos") > 0, step)).alias("pr_auc"),
            (F.sum(area) / F.nullif(F.max("all_pos") * F.max("all_neg"), F.lit(0))).alias("roc_auc"),
        )
    )


def ranking_metrics(
    scored: DataFrame,
    score: str,
    label: str = LABEL,
    *,
    weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    return ranking_from_curve(score_curve(scored, score, label, weight=weight, by=by), by=by)


def class_balance(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, positives and the weight of a positive; the weight is NULL without positives."""
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(_fraud(label)).alias("positives")
    ).withColumn(
        "positive_weight",
        (F.col("rows") - F.col("positives")) / F.nullif(F.col("positives"), F.lit(0)),
    )


def positive_weight(rows: DataFrame, label: str = LABEL) -> float:
    found = class_balance(rows, label).first()
    if not found["positives"]:
        raise MetricError("no positive rows; nothing to learn")
    return float(found["positive_weight"])


# ---- one threshold ---------------------------------------------------------------------------


def _confusion_columns(score: str, label: str, threshold: Column) -> dict[str, Column]:
    blocked = F.col(score) >= threshold
    return {
        "tp": F.count_if(blocked & _fraud(label)),
        "fp": F.count_if(blocked & ~_fraud(label)),
        "fn": F.count_if(~blocked & _fraud(label)),
        "tn": F.count_if(~blocked & ~_fraud(label)),
    }


def confusion(scored: DataFrame, score: str, threshold: float, label: str = LABEL) -> DataFrame:
    """True and false, positives and negatives; a row is blocked at or above the threshold."""
    columns = _confusion_columns(score, label, F.lit(float(threshold)))
    return scored.agg(*[c.alias(n) for n, c in columns.items()])


def operating_cost(
    scored: DataFrame,
    score: str,
    threshold: float,
    label: str = LABEL,
    amount: str = AMOUNT,
    *,
    flat: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """Missed fraud by its amount plus a flat charge per blocked legitimate row."""
    blocked = F.col(score) >= F.lit(float(threshold))
    missed = F.coalesce(F.sum(F.when(~blocked & _fraud(label), F.col(amount))), F.lit(0.0))
    return scored.agg((missed + F.count_if(blocked & ~_fraud(label)) * F.lit(flat)).alias("cost"))


def evaluate_thresholds(
    scored: DataFrame,
    thresholds: DataFrame,
    score: str,
    label: str = LABEL,
    amount: str = AMOUNT,
    *,
    flat: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """Rates, counts and costs at each ``threshold`` of a small table.

    The scored rows are read once; every threshold is looked up on the grouped curve.
    """
    return curve_at(score_curve(scored, score, label, amount=amount), thresholds, score, flat=flat)


def curve_at(
    curve: DataFrame,
    thresholds: DataFrame,
    score: str,
    *,
    flat: float = FALSE_POSITIVE_COST,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """As :func:`evaluate_thresholds`, from an existing curve: one merge of the two orders, for any number of thresholds.

    ``edges`` forces ranges; without them they follow from the counted records.
    """
    points = thresholds.select(F.col("threshold").cast("double").alias("threshold"))
    merged = totals_as_of(curve, points, score, ["pos", "neg", "lost"], descending=True, edges=edges)
    summed = merged.select(
        "threshold",
        F.col("cum_pos").alias("caught"),
        F.col("cum_neg").alias("false_alarms"),
        F.col("cum_lost").cast("double").alias("amount_caught"),
        "all_pos",
        "all_neg",
        "all_lost",
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    blocked = F.col("caught") + F.col("false_alarms")
    return summed.select(
        "threshold",
        ratio(F.col("false_alarms"), F.col("all_neg")).alias("false_positive_rate"),
        ratio(F.col("caught"), F.col("all_pos")).alias("true_positive_rate"),
        ratio(F.col("caught"), blocked).alias("precision"),
        blocked.alias("blocked"),
        "caught",
        (F.col("all_pos") - F.col("caught")).alias("missed"),
        "false_alarms",
        (F.col("all_lost") - F.col("amount_caught") + F.col("false_alarms") * F.lit(flat)).alias(
            "total_cost"
        ),
        (F.col("all_lost") - F.col("amount_caught")).alias("amount_missed"),
        "amount_caught",
    )


# ---- choosing a threshold --------------------------------------------------------------------


def budget_threshold_row(
    curve: DataFrame, score: str, *, budget: float = FALSE_POSITIVE_BUDGET
) -> DataFrame:
    """One row: the lowest score whose realised false-positive rate fits the budget.

    NULL when there is no legitimate row or no score fits.
    """
    rate = F.col("cum_neg") / F.nullif(F.col("all_neg"), F.lit(0))
    return curve.agg(F.min(F.when(rate <= F.lit(budget), F.col(score))).cast("double").alias("threshold"))


def budget_threshold(curve: DataFrame, score: str, *, budget: float = FALSE_POSITIVE_BUDGET) -> float:
    found = budget_threshold_row(curve, score, budget=budget).first()["threshold"]
    if found is None:
        raise MetricError(f"no threshold satisfies a false-positive budget of {budget}")
    return float(found)


def _grid_of(quantiles: DataFrame) -> DataFrame:
    return quantiles.select(F.col("value").alias("threshold")).distinct()


def _even(candidates: int) -> list[float]:
    return [i / (candidates - 1) for i in range(candidates)]


def cost_grid(scored: DataFrame, score: str, *, candidates: int = COST_CANDIDATES) -> DataFrame:
    """Distinct exact quantiles of the score on an even grid, as ``threshold``."""
    return _grid_of(exact_quantiles(scored, score, _even(candidates)))


def cost_grid_of(curve: DataFrame, score: str, *, candidates: int = COST_CANDIDATES) -> DataFrame:
    """The same grid from a curve, which already counts the rows of each score."""
    counted = curve.select(
        score,
        (F.col("pos") + F.col("neg")).alias("n"),
        (F.col("all_pos") + F.col("all_neg")).alias("all_n"),
        # The curve runs downwards, quantiles run upwards.
        (F.col("all_pos") + F.col("all_neg") - F.col("cum_pos") - F.col("cum_neg") + F.col("pos") + F.col("neg")).alias("cum_n"),
    )
    return _grid_of(quantiles_of(counted, score, _even(candidates)))


def cost_curve(
    scored: DataFrame,
    score: str,
    label: str = LABEL,
    amount: str = AMOUNT,
    *,
    extra: Sequence[float] = (),
    candidates: int = COST_CANDIDATES,
    flat: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """(threshold, total_cost) on the grid plus any ``extra`` thresholds.

    The scored rows are reduced to a curve once; the grid and the costs both come from it.
    """
    curve = materialize(score_curve(scored, score, label, amount=amount), "curve")
    grid = cost_grid_of(curve, score, candidates=candidates)
    if extra:
        points = F.explode(F.array(*[F.lit(float(t)) for t in extra])).alias("threshold")
        grid = grid.union(grid.limit(1).select(points)).distinct()
    return curve_at(curve, grid, score, flat=flat).select("threshold", "total_cost")


def cheapest_threshold(costs: DataFrame) -> DataFrame:
    """The cheapest threshold, the lowest one on a tie."""
    return costs.orderBy("total_cost", "threshold").limit(1)


# ---- probabilities ---------------------------------------------------------------------------


def probability_losses(
    scored: DataFrame,
    probability: str,
    label: str = LABEL,
    *,
    weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Brier score and log loss, per ``by`` group."""
    p, y = F.col(probability), _fraud(label).cast("double")
    q = clipped(p, _CLIP, 1 - _CLIP)
    loss = -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))
    w = F.lit(1.0) if weight is None else F.col(weight)
    mean = lambda c: F.sum(c * w) / F.sum(w)
    return scored.groupBy(*by).agg(
        mean((p - y) * (p - y)).alias("brier"), mean(loss).alias("log_loss")
    )


def reliability(
    scored: DataFrame, probability: str, label: str = LABEL, *, bins: int = 10
) -> DataFrame:
    """Mean prediction, observed rate and rows per fixed-width bin; an empty bin shows zeros."""
    edges = [i / bins for i in range(1, bins)]
    cutter = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="_p", outputCol="_bin"
    )
    filled = (
        cutter.transform(
            scored.select(F.col(probability).cast("double").alias("_p"), _fraud(label).alias("_y"))
        )
        .groupBy(F.col("_bin").cast("int").alias("bin"))
        .agg(
            F.avg("_p").alias("mean_predicted"),
            F.avg(F.col("_y").cast("double")).alias("observed_rate"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    every = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.col("bin") / F.lit(bins)).alias("lower"),
        ((F.col("bin") + 1) / F.lit(bins)).alias("upper"),
        F.coalesce("mean_predicted", F.lit(0.0)).alias("mean_predicted"),
        F.coalesce("observed_rate", F.lit(0.0)).alias("observed_rate"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def calibration_error(bins: DataFrame) -> DataFrame:
    """Row-weighted mean gap between predicted and observed; 0 for no rows."""
    gap = F.col("rows") * F.abs(F.col("mean_predicted") - F.col("observed_rate"))
    return bins.agg(
        F.when(F.sum("rows") > 0, F.sum(gap) / F.sum("rows"))
        .otherwise(F.lit(0.0))
        .alias("expected_calibration_error")
    )


# ---- curves as tables ------------------------------------------------------------------------


def precision_recall_points(curve: DataFrame, score: str) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    return curve.select(
        F.col(score).cast("double").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        (F.col("cum_pos") / F.col("all_pos")).alias("recall"),
    )


def operating_point(points: DataFrame, threshold: float) -> DataFrame:
    """The first point at or above the threshold, or the last one when it exceeds every score."""
    at = F.struct("threshold", "precision", "recall")
    return points.agg(
        F.coalesce(
            F.min(F.when(F.col("threshold") >= F.lit(float(threshold)), at)), F.max(at)
        ).alias("_p")
    ).select("_p.*")


def numbered(curve: DataFrame, score: str, edges: Sequence[float] | None = None) -> DataFrame:
    """Adds ``position`` (from 0, highest score first) and ``size``."""
    ones = curve.withColumn("_one", F.lit(1).cast("bigint"))
    placed = accumulate(ones, score, ["_one"], descending=True, edges=edges)
    return placed.withColumns(
        {"position": F.col("cum__one") - 1, "size": F.col("all__one")}
    ).drop("_one", "cum__one", "all__one")


def roc_points(
    curve: DataFrame, score: str, *, most: int = 200, edges: Sequence[float] | None = None
) -> DataFrame:
    """(position, false_positive_rate, true_positive_rate, threshold), at most ``most`` points.

    Only corners of the curve are kept, the origin leads, the picks are evenly spaced by position
    and thresholds are clipped to [0, 1]. ``edges`` forces ranges.
    """
    if edges is None:
        curve = materialize(curve, "curve")
        edges = cut_points(curve, score)
    placed = with_next(curve, score, ["pos", "neg"], "_next", descending=True, edges=edges)
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    corner = first | F.col("_next").isNull() | (F.struct("pos", "neg") != F.col("_next"))
    corners = placed.where(corner)
    kept = numbered(corners.select(score, "cum_pos", "cum_neg", "all_pos", "all_neg"), score, edges)
    origin = kept.where(F.col("position") == 0).select(
        F.lit(0).cast("bigint").alias("position"),
        (F.col("size") + 1).alias("size"),
        F.lit(0.0).alias("false_positive_rate"),
        F.lit(0.0).alias("true_positive_rate"),
        F.lit(1.0).alias("threshold"),
    )
    points = origin.unionByName(
        kept.select(
            (F.col("position") + 1).alias("position"),
            (F.col("size") + 1).alias("size"),
            (F.col("cum_neg") / F.col("all_neg")).alias("false_positive_rate"),
            (F.col("cum_pos") / F.col("all_pos")).alias("true_positive_rate"),
            clipped(F.col(score).cast("double"), 0.0, 1.0).alias("threshold"),
        )
    )
    step = (F.col("size") - 1) / F.lit(float(most - 1))
    nearest = F.floor(F.col("position") / step)
    picked = F.exists(
        F.sequence(nearest - 1, nearest + 2),
        lambda k: (k < most - 1) & (F.floor(k * step) == F.col("position")),
    )
    last = F.col("position") == F.col("size") - 1
    return points.where((F.col("size") <= most) | picked | last).drop("size")


def score_histogram(
    scored: DataFrame, probability: str, label: str = LABEL, *, bins: int = 50
) -> DataFrame:
    """Rows per class and fixed-width bin on [0, 1]; the last bin takes 1.0."""
    slot = F.least(F.floor(F.col(probability) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    return scored.groupBy(_fraud(label).cast("int").alias("label"), slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# ---- segments --------------------------------------------------------------------------------


def seen_segments(
    scored: DataFrame, score: str, label: str = LABEL, *, seen: str = "seen_in_train"
) -> DataFrame:
    """Average precision for rows on a seen entity and on an unseen one.

    A row without an entity counts as unseen. A segment without positives is left out.
    """
    segment = F.when(F.coalesce(F.col(seen), F.lit(False)), "seen").otherwise("unseen")
    found = ranking_metrics(scored.withColumn("segment", segment), score, label, by=["segment"])
    return found.where(F.col("positives") > 0).select("segment", "rows", "pr_auc")


def product_segments(
    scored: DataFrame,
    score: str,
    label: str = LABEL,
    *,
    product: str = PRODUCT,
    min_rows: int = SEGMENT_MIN_ROWS,
    min_positives: int = SEGMENT_MIN_POSITIVES,
) -> DataFrame:
    """Average precision, rows and positive rate per product with enough rows and positives."""
    known = scored.where(F.col(product).isNotNull())
    found = ranking_metrics(known, score, label, by=[product])
    return found.where((F.col("rows") >= min_rows) & (F.col("positives") >= min_positives)).select(
        F.col(product).cast("string").alias("product"),
        "rows",
        "pr_auc",
        (F.col("positives") / F.col("rows")).alias("positive_rate"),
    )


def dominant_segment(segments: DataFrame, *, share: float = 0.5) -> DataFrame:
    """The product with most rows, if it holds at least ``share`` of the reported rows."""
    total = segments.agg(F.sum("rows").alias("_total"))
    return (
        segments.orderBy(F.col("rows").desc(), "product")
        .limit(1)
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("share", F.col("rows") / F.col("_total"))
        .where(F.col("share") >= share)
        .drop("_total")
    )


def score_summary(scored: DataFrame, raw: str, calibrated: str, threshold: float) -> DataFrame:
    """Rows, mean and exact median raw score, mean probability, percent above the threshold."""
    middle = exact_quantiles(scored, raw, [0.5]).agg(F.max("value").alias("median_raw"))
    above = (F.col(calibrated) > F.lit(float(threshold))).cast("double")
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(raw).alias("mean_raw"),
        F.avg(calibrated).alias("mean_calibrated"),
        (F.avg(above) * F.lit(100.0)).alias("percent_above"),
    ).crossJoin(F.broadcast(middle))  # one row


def run_metrics(scored: DataFrame, raw: str, calibrated: str, label: str = LABEL, *, by: Sequence[str]) -> DataFrame:
    """One row per run (``by``): the ranking by raw and by calibrated scores, and how many calibrated values differ.

    Both kinds of score take one curve together; a calibrator that ties many scores shows in the last column.
    """
    by = list(by)
    kinds = F.array(
        *[F.struct(F.lit(k).alias("_kind"), F.col(c).cast("double").alias("_p")) for k, c in (("raw", raw), ("cal", calibrated))]
    )
    curve = score_curve(scored.select(*by, label, F.inline(kinds)), "_p", label, by=[*by, "_kind"])
    ranked = ranking_from_curve(curve, by=[*by, "_kind"])
    sizes = curve.groupBy(*[F.col(c).alias(f"_b_{c}") for c in by], F.col("_kind").alias("_b__kind")).agg(F.count("*").alias("_values"))
    match = [ranked[c].eqNullSafe(sizes[f"_b_{c}"]) for c in (*by, "_kind")]
    of = lambda kind, c: F.max(F.when(F.col("_kind") == kind, F.col(c)))
    return (
        ranked.join(sizes, match)
        .groupBy(*by)
        .agg(
            *[of(kind, c).alias(f"{kind}_{c}") for kind in ("raw", "cal") for c in ("pr_auc", "roc_auc")],
            of("cal", "_values").alias("distinct_calibrated"),
        )
    )


def noise_summary(runs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric over repeated fits: mean, sample sd (0 for one run), min, max and range."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    return (
        runs.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("metric")
        .agg(
            F.count("value").alias("runs"),
            F.avg("value").alias("mean"),
            F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("sd"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            (F.max("value") - F.min("value")).alias("range"),
        )
    )
