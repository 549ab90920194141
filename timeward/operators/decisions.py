"""Acting on a probability.

A threshold is chosen and measured with "at or above", and acted on with "above"; rows tied
exactly at it are the difference, so they can be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_action(scored: DataFrame, probability: str, threshold: float) -> DataFrame:
    blocked = F.col(probability) > F.lit(float(threshold))
    return scored.withColumn("action", F.when(blocked, "block").otherwise("allow"))


def tied_rows(scored: DataFrame, probability: str, threshold: DataFrame) -> DataFrame:
    """Rows blocked under either comparison, for the one row of ``threshold``."""
    placed = scored.crossJoin(F.broadcast(threshold))  # one row
    p, t = F.col(probability), F.col("threshold")
    return placed.groupBy("threshold").agg(
        F.count_if(p >= t).alias("blocked_when_measured"),
        F.count_if(p > t).alias("blocked_when_scored"),
        F.count_if(p == t).alias("tied"),
    )
