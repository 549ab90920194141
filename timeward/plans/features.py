"""The feature table: velocity and client history per transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.functions.derive import Derivation, start_day
from timeward.functions.scalars import client_key
from timeward.names import (
    AMOUNT,
    C_COLUMNS,
    CARD,
    CLIENT,
    CLIENT_ADDRESS,
    CLIENT_ANCHOR,
    DAY_SECONDS,
    DEVICE,
    FEATURES,
    HOUR_SECONDS,
    ID,
    LABEL,
    M_COLUMNS,
    TIME,
)
from timeward.operators.assemble import AssemblyError, assemble_model_input
from timeward.operators.history import SLICE_ABOVE, Measure, add_history, find_hot


def client_aggregate_names(
    derivations: Sequence[Derivation] = (),
    c_columns: Sequence[str] = (),
    m_columns: Sequence[str] = (),
) -> list[str]:
    """Spreads of start days, then means of C columns, then means of M columns."""
    for d in derivations:
        if d.tool != "days_since_to_start_day":
            raise AssemblyError(f"{d.name}: {d.tool} has no spread over an entity's history")
    return [
        *[f"client_{d.name.lower()}_std_prior" for d in derivations],
        *[f"client_{c.lower()}_mean_prior" for c in (*c_columns, *m_columns)],
    ]


def client_aggregate_measures(
    derivations: Sequence[Derivation] = (),
    c_columns: Sequence[str] = (),
    m_columns: Sequence[str] = (),
) -> list[Measure]:
    """One measure per name of :func:`client_aggregate_names`, over all earlier rows."""
    expressions = [
        *[
            (
                "std",
                start_day(
                    d.inputs[0],
                    str(d.params.get("time_column", TIME)),
                    int(d.params.get("unit_seconds", DAY_SECONDS)),
                ),
            )
            for d in derivations
        ],
        *[("avg", F.col(c)) for c in c_columns],
        *[("avg", F.col(m).cast("bigint")) for m in m_columns],
    ]
    names = client_aggregate_names(derivations, c_columns, m_columns)
    return [
        Measure(name, kind, None, value)
        for name, (kind, value) in zip(names, expressions, strict=True)
    ]


def card_measures(hour: int = HOUR_SECONDS, day: int = DAY_SECONDS) -> list[Measure]:
    amount = F.col(AMOUNT)
    return [
        Measure("card_txn_count_1h", "count", hour),
        Measure("card_txn_count_24h", "count", day),
        Measure("card_txn_amt_avg_24h", "avg", day, amount),
        Measure("card_txn_amt_sum_24h", "sum", day, amount),
        Measure("_prev_card", "last"),
    ]


def client_measures(day: int = DAY_SECONDS) -> list[Measure]:
    return [
        Measure("client_txn_count_prior", "count"),
        Measure("client_txn_count_24h", "count", day),
        Measure("client_amt_avg_prior", "avg", None, F.col(AMOUNT)),
        Measure("_prev_client", "last"),
    ]


def transaction_features(
    joined: DataFrame,
    *,
    card: str = CARD,
    device: str = DEVICE,
    client: str = CLIENT,
    window_1h: int = HOUR_SECONDS,
    window_24h: int = DAY_SECONDS,
    derivations: Sequence[Derivation] = (),
    c_columns: Sequence[str] = tuple(C_COLUMNS),
    m_columns: Sequence[str] = tuple(M_COLUMNS),
    slice_above: int = SLICE_ABOVE,
) -> DataFrame:
    """One row per input row: the pass-through roles, the 12 core features and the aggregates."""
    inputs = {ID, TIME, AMOUNT, LABEL, card, device, CLIENT_ADDRESS, CLIENT_ANCHOR}
    inputs |= {i for d in derivations for i in d.inputs} | set(c_columns) | set(m_columns)
    rows = joined.select(*[c for c in joined.columns if c in inputs]).withColumn(
        client, client_key(card, CLIENT_ADDRESS, CLIENT_ANCHOR)
    )
    aggregates = client_aggregate_measures(derivations, c_columns, m_columns)

    hot = find_hot(rows, [card, device, client], slice_above, share_missing=[card])
    by_card = card_measures(window_1h, window_24h)
    by_device = [Measure("device_txn_count_24h", "count", window_24h)]
    by_client = [*client_measures(window_24h), *aggregates]
    base = rows
    rows = add_history(
        rows, card, TIME, by_card, hot=hot.get(card), base=base, share_missing_entity=True
    )
    rows = add_history(rows, device, TIME, by_device, hot=hot.get(device), base=base)
    rows = add_history(rows, client, TIME, by_client, hot=hot.get(client), base=base)

    derived = {
        "card_amt_deviation_24h": F.col(AMOUNT) - F.col("card_txn_amt_avg_24h"),
        "seconds_since_prev_txn_card": F.col(TIME) - F.col("_prev_card"),
        "client_amt_deviation_prior": F.col(AMOUNT) - F.col("client_amt_avg_prior"),
        "seconds_since_prev_txn_client": F.col(TIME) - F.col("_prev_client"),
    }
    return rows.withColumns(derived).select(
        ID, TIME, AMOUNT, card, device, client, LABEL, *FEATURES, *[m.name for m in aggregates]
    )


def model_input(joined: DataFrame, features: DataFrame, aggregate_names: Sequence[str]) -> DataFrame:
    """Joined rows plus the client key and every engineered column, one row per transaction."""
    return assemble_model_input(joined, features, [CLIENT, *FEATURES, *aggregate_names])


def point_in_time_checks(features: DataFrame, *, time: str = TIME, card: str = CARD) -> DataFrame:
    """One row of numbers that must agree if no feature looked at its own instant.

    ``null_gaps`` equals ``first_instant_rows``, the rows at their card's first instant, and
    ``idle_rows`` equals ``null_averages``.
    """
    first = features.groupBy(F.col(card).alias("_card")).agg(F.min(time).alias("_first"))
    flagged = features.join(first, F.col(card).eqNullSafe(F.col("_card")), "left")
    gap = F.col("seconds_since_prev_txn_card")
    return flagged.agg(
        F.count_if(gap == 0).alias("zero_gaps"),
        F.min(gap).alias("min_gap"),
        F.count_if(gap.isNull()).alias("null_gaps"),
        F.count_if(F.col(time) == F.col("_first")).alias("first_instant_rows"),
        F.count_if(F.col("card_txn_count_24h") == 0).alias("idle_rows"),
        F.count_if(F.col("card_txn_amt_avg_24h").isNull()).alias("null_averages"),
    )
