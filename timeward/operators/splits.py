"""Splits on the time axis and on entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.names import CARD, CARD_SEEN, CLIENT, ID, SPLIT, TIME
from timeward.operators.lookups import with_membership
from timeward.operators.ordered import exact_quantiles, hash_rank

# End of train, start and end of validation as shares of the time axis.
TRAIN_END, VAL_START, VAL_END = 0.75, 0.85, 0.90


def split_bounds(
    rows: DataFrame,
    *,
    time: str = TIME,
    train_end: float = TRAIN_END,
    val_start: float = VAL_START,
    val_end: float = VAL_END,
) -> DataFrame:
    """One row with the exact bounds. Approximate quantiles would move rows between runs."""
    found = exact_quantiles(rows, time, [train_end, val_start, val_end])
    pick = lambda i: F.max(F.when(F.col("fraction_index") == i, F.round("value", 6)))
    return found.agg(pick(0).alias("train_end"), pick(1).alias("val_start"), pick(2).alias("val_end"))


def assign_splits(
    rows: DataFrame, bounds: DataFrame, *, id: str = ID, time: str = TIME, card: str = CARD
) -> DataFrame:
    """(id, card, split). Rows of the embargo gap are absent."""
    placed = rows.select(id, time, card).crossJoin(F.broadcast(bounds))  # one row
    return (
        placed.where((F.col(time) <= F.col("train_end")) | (F.col(time) > F.col("val_start")))
        .withColumn(
            SPLIT,
            F.when(F.col(time) <= F.col("train_end"), "train")
            .when(F.col(time) <= F.col("val_end"), "val")
            .otherwise("test"),
        )
        .select(id, card, SPLIT)
    )


def split_table(
    rows: DataFrame, *, id: str = ID, time: str = TIME, card: str = CARD, bounds: DataFrame | None = None
) -> DataFrame:
    """The narrow split table: id, split, and whether the card also occurs in train."""
    if bounds is None:
        bounds = split_bounds(rows, time=time)
    assigned = assign_splits(rows, bounds, id=id, time=time, card=card)
    train = assigned.where(F.col(SPLIT) == "train")
    return with_membership(assigned, train, card, CARD_SEEN).select(id, SPLIT, CARD_SEEN)


def split_summary(splits: DataFrame) -> DataFrame:
    """Rows per split, rows on a card seen in train, and their share (0 for an empty split)."""
    return (
        splits.groupBy(SPLIT)
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(CARD_SEEN).alias("seen_rows"))
        .withColumn(
            "overlap",
            F.when(F.col("rows") > 0, F.col("seen_rows") / F.col("rows")).otherwise(F.lit(0.0)),
        )
    )


def rows_of_split(rows: DataFrame, splits: DataFrame, name: str, *, id: str = ID) -> DataFrame:
    """The rows of one split with their split columns."""
    return rows.join(splits.where(F.col(SPLIT) == name), id, "inner")


def with_seen_entity(
    holdout: DataFrame, train: DataFrame, *, column: str = CLIENT, flag: str = "seen_in_train"
) -> DataFrame:
    """True, False, or NULL for a row without an entity."""
    if column not in holdout.columns or column not in train.columns:
        raise KeyError(f"{column!r} is not in the frame; it comes from feature engineering")
    return with_membership(holdout, train, column, flag)


def entity_split(
    rows: DataFrame, *, column: str = CLIENT, frac: float = 0.7, seed: int = 0
) -> DataFrame:
    """Adds ``part`` so that ``train`` and ``holdout`` share no entity.

    The first ``floor(n * frac)`` entities in seeded hash order train; the others and rows
    without an entity are the holdout. Depends on the set of entities and the seed alone.
    """
    if not 0.0 < frac < 1.0:
        raise ValueError(f"frac must lie strictly between 0 and 1, got {frac}")
    entities = rows.where(F.col(column).isNotNull()).select(column).distinct()
    ranked = hash_rank(entities, column, seed)
    chosen = ranked.where(F.col("rank") <= F.floor(F.col("group_rows") * F.lit(frac)))
    flagged = with_membership(rows, chosen, column, "_train", missing=False)
    return flagged.withColumn("part", F.when(F.col("_train"), "train").otherwise("holdout")).drop(
        "_train"
    )
