"""Windows over strictly earlier rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeward.functions.scalars import client_key
from timeward.names import (
    C_COLUMNS,
    CARD,
    CLIENT,
    DAY_SECONDS,
    DEVICE,
    HOUR_SECONDS,
    ID,
    M_COLUMNS,
    TIME,
)
from timeward.operators.history import (
    Measure,
    add_entity_total,
    add_history,
    find_hot,
)
from timeward.plans.features import (
    client_aggregate_measures,
    client_aggregate_names,
    point_in_time_checks,
    transaction_features,
)
from timeward.policy import Policy
from timeward.registry import query, steady, steady_double, steady_sql
from timeward.registry.adapters import CLIENT_SQL, transactions, tx_sql

_POLICY = Policy()
_SPREAD = _POLICY.spread_derivations()
AGGREGATES = client_aggregate_names(_SPREAD, C_COLUMNS, M_COLUMNS)

# Doubles compared with the oracle are rounded on both sides.
_FLOATS = {
    "card_txn_amt_avg_24h",
    "card_txn_amt_sum_24h",
    "card_amt_deviation_24h",
    "client_amt_avg_prior",
    "client_amt_deviation_prior",
    *AGGREGATES,
}


def _windows_sql(parts: dict[str, str]) -> str:
    return "WINDOW " + ",\n  ".join(
        f"{name} AS (PARTITION BY {key} ORDER BY TransactionDT RANGE BETWEEN {frame} PRECEDING AND 1 PRECEDING)"
        for name, (key, frame) in {
            "card_1h": ("card1", "3600"),
            "card_24h": ("card1", "86400"),
            "card_prior": ("card1", "UNBOUNDED"),
            "device_24h": ("DeviceInfo", "86400"),
            "client_24h": ("client_uid", "86400"),
            "client_prior": ("client_uid", "UNBOUNDED"),
        }.items()
        if name in parts
    )


def _guarded(entity: str, text: str) -> str:
    return f"CASE WHEN {entity} IS NULL THEN NULL ELSE {text} END"


_CORE = {
    "card_txn_count_1h": "count(*) OVER card_1h",
    "card_txn_count_24h": "count(*) OVER card_24h",
    "card_txn_amt_avg_24h": steady_sql("avg(TransactionAmt) OVER card_24h"),
    "card_txn_amt_sum_24h": steady_sql("sum(TransactionAmt) OVER card_24h"),
    "card_amt_deviation_24h": steady_sql("TransactionAmt - avg(TransactionAmt) OVER card_24h"),
    "seconds_since_prev_txn_card": "TransactionDT - max(TransactionDT) OVER card_prior",
    "device_txn_count_24h": _guarded("DeviceInfo", "count(*) OVER device_24h"),
    "client_txn_count_prior": _guarded("client_uid", "count(*) OVER client_prior"),
    "client_txn_count_24h": _guarded("client_uid", "count(*) OVER client_24h"),
    "client_amt_avg_prior": _guarded("client_uid", steady_sql("avg(TransactionAmt) OVER client_prior")),
    "client_amt_deviation_prior": _guarded(
        "client_uid", steady_sql("TransactionAmt - avg(TransactionAmt) OVER client_prior")
    ),
    "seconds_since_prev_txn_client": _guarded(
        "client_uid", "TransactionDT - max(TransactionDT) OVER client_prior"
    ),
}
_SPREAD_SQL = {
    f"client_{d.name.lower()}_std_prior": _guarded(
        "client_uid",
        steady_sql(f"stddev_samp(TransactionDT // 86400 - {d.inputs[0]}) OVER client_prior"),
    )
    for d in _SPREAD
}
_MEAN_C_SQL = {
    f"client_{c.lower()}_mean_prior": _guarded("client_uid", steady_sql(f"avg({c}) OVER client_prior"))
    for c in C_COLUMNS
}
_MEAN_M_SQL = {
    f"client_{m.lower()}_mean_prior": _guarded(
        "client_uid", steady_sql(f"avg(CAST({m} AS INT)) OVER client_prior")
    )
    for m in M_COLUMNS
}
_EVERYTHING = {**_CORE, **_SPREAD_SQL, **_MEAN_C_SQL, **_MEAN_M_SQL}
_ALL_WINDOWS = {"card_1h", "card_24h", "card_prior", "device_24h", "client_24h", "client_prior"}


def features_cte(tx: str = "tx") -> str:
    """CTEs ``wc`` and ``ft``: every engineered column."""
    body = ",\n  ".join(f"{t} AS {n}" for n, t in _EVERYTHING.items())
    return (
        f"wc AS (SELECT *, {CLIENT_SQL} AS client_uid FROM {tx}),\n"
        "ft AS (SELECT TransactionID, TransactionDT, TransactionAmt, card1, DeviceInfo, client_uid,"
        f" isFraud,\n  {body}\nFROM wc {_windows_sql(dict.fromkeys(_ALL_WINDOWS))})"
    )


def _windowed_sql(source: str, columns: dict[str, str]) -> str:
    used = {w for w in _ALL_WINDOWS if any(f"OVER {w}" in t for t in columns.values())}
    body = ",\n  ".join(f"{t} AS {n}" for n, t in columns.items())
    return (
        f"{tx_sql(source)},\nwc AS (SELECT *, {CLIENT_SQL} AS client_uid FROM tx)\n"
        f"SELECT TransactionID,\n  {body}\nFROM wc {_windows_sql(dict.fromkeys(used))}"
    )


def rounded(df: DataFrame) -> DataFrame:
    found = {c: steady_double(F.col(c)) for c in df.columns if c in _FLOATS}
    return df.withColumns(found) if found else df


def _clients(spark, folder, source):
    return transactions(spark, folder, source).withColumn(CLIENT, client_key())


def _by_entity(spark, folder, source, entity, measures, *, share=False):
    rows = _clients(spark, folder, source)
    hot = find_hot(rows, [entity], share_missing=[entity] if share else []).get(entity)
    return add_history(rows, entity, TIME, measures, hot=hot, share_missing_entity=share)


def _pick(names: list[str]) -> dict[str, str]:
    return {n: _EVERYTHING[n] for n in names}


def _register_pair(name, covers, columns, run):
    for source in ("events", "orders"):
        query(f"{name}_{source}", covers, _windowed_sql(source, _pick(columns)))(
            lambda spark, folder, source=source: rounded(
                run(spark, folder, source).select(ID, *columns)
            )
        )


_register_pair(
    "e01_card_count_1h",
    "E1",
    ["card_txn_count_1h"],
    lambda s, f, src: _by_entity(
        s, f, src, CARD, [Measure("card_txn_count_1h", "count", HOUR_SECONDS)], share=True
    ),
)
_register_pair(
    "e02_card_count_24h",
    "E2",
    ["card_txn_count_24h"],
    lambda s, f, src: _by_entity(
        s, f, src, CARD, [Measure("card_txn_count_24h", "count", DAY_SECONDS)], share=True
    ),
)
_register_pair(
    "e03_card_amount_24h",
    "E3 E4",
    ["card_txn_amt_avg_24h", "card_txn_amt_sum_24h", "card_amt_deviation_24h"],
    lambda s, f, src: _by_entity(
        s,
        f,
        src,
        CARD,
        [
            Measure("card_txn_amt_avg_24h", "avg", DAY_SECONDS, F.col("TransactionAmt")),
            Measure("card_txn_amt_sum_24h", "sum", DAY_SECONDS, F.col("TransactionAmt")),
        ],
        share=True,
    ).withColumn(
        "card_amt_deviation_24h", F.col("TransactionAmt") - F.col("card_txn_amt_avg_24h")
    ),
)
_register_pair(
    "e05_card_gap",
    "E5",
    ["seconds_since_prev_txn_card"],
    lambda s, f, src: _by_entity(
        s, f, src, CARD, [Measure("_prev", "last")], share=True
    ).withColumn("seconds_since_prev_txn_card", F.col(TIME) - F.col("_prev")),
)
_register_pair(
    "e06_device_count_24h",
    "E6",
    ["device_txn_count_24h"],
    lambda s, f, src: _by_entity(
        s, f, src, DEVICE, [Measure("device_txn_count_24h", "count", DAY_SECONDS)]
    ),
)
_register_pair(
    "e07_client_core",
    "E7 E8 E9 E10 H1 H2",
    [
        "client_txn_count_prior",
        "client_txn_count_24h",
        "client_amt_avg_prior",
        "client_amt_deviation_prior",
        "seconds_since_prev_txn_client",
    ],
    lambda s, f, src: _by_entity(
        s,
        f,
        src,
        CLIENT,
        [
            Measure("client_txn_count_prior", "count"),
            Measure("client_txn_count_24h", "count", DAY_SECONDS),
            Measure("client_amt_avg_prior", "avg", None, F.col("TransactionAmt")),
            Measure("_prev", "last"),
        ],
    ).withColumns(
        {
            "client_amt_deviation_prior": F.col("TransactionAmt") - F.col("client_amt_avg_prior"),
            "seconds_since_prev_txn_client": F.col(TIME) - F.col("_prev"),
        }
    ),
)
_register_pair(
    "e11_client_start_day_spread",
    "E11 H3",
    list(_SPREAD_SQL),
    lambda s, f, src: _by_entity(s, f, src, CLIENT, client_aggregate_measures(_SPREAD)),
)
_register_pair(
    "e12_client_c_means",
    "E12",
    list(_MEAN_C_SQL),
    lambda s, f, src: _by_entity(
        s, f, src, CLIENT, client_aggregate_measures((), C_COLUMNS)
    ),
)
_register_pair(
    "e13_client_m_means",
    "E13",
    list(_MEAN_M_SQL),
    lambda s, f, src: _by_entity(
        s, f, src, CLIENT, client_aggregate_measures((), (), M_COLUMNS)
    ),
)


def all_features(spark, folder, source, **kwargs):
    return transaction_features(
        transactions(spark, folder, source), derivations=_SPREAD, **kwargs
    )


for _source in ("events", "orders"):
    query(
        f"e14_transaction_features_{_source}",
        "E1 E2 E3 E4 E5 E6 E7 E8 E9 E10 E11 E12 E13 E14 E15",
        f"{tx_sql(_source)},\n{features_cte()}\nSELECT * FROM ft",
    )(lambda spark, folder, source=_source: rounded(all_features(spark, folder, source)))
    # Every entity takes the sliced route here, so the route for hot entities is checked on data
    # that has none.
    query(
        f"e14_transaction_features_sliced_{_source}",
        "E1 E2 E3 E4 E5 E6 E7 E8 E9 E10 E11 E12 E13 E14",
        f"{tx_sql(_source)},\n{features_cte()}\nSELECT * FROM ft",
    )(
        lambda spark, folder, source=_source: rounded(
            all_features(spark, folder, source, slice_above=0)
        )
    )

    query(
        f"e18_whole_history_{_source}",
        "E18",
        f"""{tx_sql(_source)},
wc AS (SELECT *, {CLIENT_SQL} AS client_uid FROM tx)
SELECT TransactionID,
  CASE WHEN client_uid IS NULL THEN NULL ELSE count(*) OVER w END AS client_txn_count_all,
  CASE WHEN client_uid IS NULL THEN NULL ELSE {steady_sql('avg(TransactionAmt) OVER w')} END
    AS client_amt_avg_all,
  CASE WHEN client_uid IS NULL THEN NULL ELSE {steady_sql('stddev_samp(C1) OVER w')} END AS client_c1_std_all
FROM wc WINDOW w AS (PARTITION BY client_uid ORDER BY TransactionDT
  RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    )(
        lambda spark, folder, source=_source: add_entity_total(
            _clients(spark, folder, source),
            CLIENT,
            {
                "client_txn_count_all": F.count(F.lit(1)),
                "client_amt_avg_all": steady(F.avg("TransactionAmt")),
                "client_c1_std_all": steady(F.stddev_samp("C1")),
            },
        ).select(ID, "client_txn_count_all", "client_amt_avg_all", "client_c1_std_all")
    )

    query(
        f"d28_point_in_time_checks_{_source}",
        "D28",
        f"""{tx_sql(_source)},
w AS (SELECT *, min(TransactionDT) OVER (PARTITION BY card1) AS f,
  TransactionDT - max(TransactionDT) OVER p AS gap, count(*) OVER d AS n, avg(TransactionAmt) OVER d AS a
  FROM tx WINDOW p AS (PARTITION BY card1 ORDER BY TransactionDT
      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    d AS (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING))
SELECT count(*) FILTER (gap = 0) AS zero_gaps, min(gap) AS min_gap,
  count(*) FILTER (gap IS NULL) AS null_gaps, count(*) FILTER (TransactionDT = f) AS first_instant_rows,
  count(*) FILTER (n = 0) AS idle_rows, count(*) FILTER (a IS NULL) AS null_averages FROM w""",
    )(lambda spark, folder, source=_source: point_in_time_checks(all_features(spark, folder, source)))


@query(
    "e06_missing_device_shared",
    "E6",
    f"""{tx_sql('events')}
SELECT TransactionID, count(*) OVER w AS device_rows FROM tx
WINDOW w AS (PARTITION BY DeviceInfo ORDER BY TransactionDT RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)""",
)
def missing_device_shared(spark, folder):
    """The unguarded variant: rows without a device share one frame, however many they are."""
    rows = transactions(spark, folder, "events").select(ID, TIME, DEVICE)
    measure = [Measure("device_rows", "count", DAY_SECONDS)]
    # The missing value is known to be the largest entity, so it is always sliced.
    hot = rows.where(F.col(DEVICE).isNull()).select(DEVICE).distinct()
    out = add_history(rows, DEVICE, TIME, measure, hot=hot, share_missing_entity=True)
    return out.select(ID, "device_rows")
