"""Views that give the given tables the roles of a transaction table.

``events`` has second granularity, ``orders`` has day granularity with many ties. The column
expressions are plain integer arithmetic, so Spark and the SQL oracle read the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SECONDS = "timestampdiff(SECOND, timestamp_ntz'1970-01-01', {c})"

# Base columns: e id, u entity, t second, dy day, amt amount, prod product, fr label, k small code.
_EVENT_BASE_SQL = """
  SELECT event_id AS e, user_id AS u, CAST(floor(epoch(ts)) AS BIGINT) AS t,
         CAST(floor(epoch(ts)) AS BIGINT) // 86400 AS dy, value AS amt, event_type AS prod,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS fr,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events"""

_ORDER_BASE_SQL = """
  SELECT o_orderkey AS e, o_custkey AS u, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS t,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) // 86400 AS dy, o_totalprice AS amt,
         o_orderstatus AS prod,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT) AS fr,
         (o_orderkey * 31 + o_custkey) % 100 AS k
  FROM orders"""

ROLE_COLUMNS: dict[str, str] = {
    "TransactionID": "e",
    "TransactionDT": "t",
    "TransactionAmt": "amt",
    "isFraud": "fr",
    "ProductCD": "prod",
    "card1": "u",
    "card4": "CASE u % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover' END",
    "card6": "CASE WHEN e % 3 = 0 THEN 'credit' ELSE 'debit' END",
    "addr1": "CASE WHEN e % 9 = 0 THEN NULL ELSE u % 25 END",
    "P_emaildomain": "CASE WHEN k % 6 = 0 THEN NULL ELSE concat('mail', CAST(k % 17 AS VARCHAR(9))) END",
    "DeviceInfo": "CASE WHEN e % 5 = 0 THEN concat('dev', CAST(k % 20 AS VARCHAR(9))) END",
    "D1": "CASE WHEN e % 11 = 0 THEN NULL ELSE dy - (u % 20 + (e % 2) * 3) END",
    "D2": "CASE WHEN e % 3 = 0 THEN NULL ELSE dy - (u % 20) - k % 7 END",
    "D3": "k % 30",
    "D5": "e % 13",
    "D10": "(k * 3) % 50",
    "D11": "CASE WHEN k % 4 = 0 THEN NULL ELSE k % 45 END",
    "D15": "CAST(k % 40 AS DOUBLE) + 0.5",
    **{f"C{i}": f"(e * {i + 2} + k) % {5 + i}" for i in range(1, 15)},
    **{
        f"M{i}": f"CASE WHEN (e + {i}) % 4 = 0 THEN NULL ELSE (k + {i}) % 2 = 0 END"
        for i in (1, 2, 3, 5, 6, 7, 8, 9)
    },
    "M4": "CASE k % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' END",
}

# A block of V columns whose missing pattern comes in families, as in real anonymised data.
V_EXPRESSIONS: dict[str, str] = {
    f"V{i}": f"CASE WHEN e % {2 + i % 5} = 0 THEN NULL ELSE CAST((k * {i} + e) % {10 + i % 7} AS DOUBLE) END"
    for i in range(1, 340)
}

# A whole-number score with ties, and the same as a probability.
_SCORE = "(e * 7919 % 1000) * 7 + 3000 * fr"
SCORED_COLUMNS: dict[str, str] = {
    "TransactionID": "e",
    "TransactionDT": "t",
    "TransactionAmt": "amt",
    "isFraud": "fr",
    "ProductCD": "prod",
    "card1": "u",
    "score": _SCORE,
    "probability": f"CAST({_SCORE} AS DOUBLE) / 10000",
}


def _select(columns: dict[str, str]) -> str:
    return ",\n    ".join(f"{text} AS {name}" for name, text in columns.items())


def _base(spark: SparkSession, folder: str, source: str) -> DataFrame:
    if source == "events":
        raw = table(spark, folder, "events")
        return raw.select(
            F.col("event_id").alias("e"),
            F.col("user_id").alias("u"),
            F.expr(_SECONDS.format(c="ts")).alias("t"),
            F.expr(f"{_SECONDS.format(c='ts')} div 86400").alias("dy"),
            F.col("value").alias("amt"),
            F.col("event_type").alias("prod"),
            (F.col("event_type") == "error").cast("bigint").alias("fr"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )
    raw = table(spark, folder, "orders")
    return raw.select(
        F.col("o_orderkey").alias("e"),
        F.col("o_custkey").alias("u"),
        F.expr(_SECONDS.format(c="o_orderdate")).alias("t"),
        F.expr(f"{_SECONDS.format(c='o_orderdate')} div 86400").alias("dy"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_orderstatus").alias("prod"),
        (F.col("o_orderpriority") == "1-URGENT").cast("bigint").alias("fr"),
        F.expr("(o_orderkey * 31 + o_custkey) % 100").alias("k"),
    )


# Rows of a wide view that one task makes.
_WIDE_ROWS = 25_000


def _build(spark: SparkSession, folder: str, source: str, columns: dict[str, str]) -> DataFrame:
    return _base(spark, folder, source).select(
        *[F.expr(text).alias(name) for name, text in columns.items()]
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Narrow rows dealt by id over tasks of a fixed number of rows: a file's splits follow its narrow bytes, and
    would leave hundreds of columns of millions of rows to one task. Counting reads footers only."""
    return rows.repartition(max(1, -(-rows.count() // _WIDE_ROWS)), "e")


def transactions(spark: SparkSession, folder: str, source: str = "events") -> DataFrame:
    return _build(spark, folder, source, ROLE_COLUMNS)


def wide_transactions(spark: SparkSession, folder: str, source: str = "events") -> DataFrame:
    """Transactions with the full V block."""
    columns = {**ROLE_COLUMNS, **V_EXPRESSIONS}
    return _spread(_base(spark, folder, source)).select(*[F.expr(text).alias(name) for name, text in columns.items()])


def scored(spark: SparkSession, folder: str, source: str = "events") -> DataFrame:
    return _build(spark, folder, source, SCORED_COLUMNS)


def identity(spark: SparkSession, folder: str) -> DataFrame:
    """A sparse side table for ``orders``: one row per order that has a returned line."""
    lines = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return lines.groupBy(F.col("l_orderkey").alias("TransactionID")).agg(
        F.count(F.lit(1)).alias("id_01"),
        F.max("l_linenumber").cast("double").alias("id_13"),
        F.min("l_linestatus").alias("DeviceType"),
    )


def _bases(source: str) -> str:
    return _EVENT_BASE_SQL if source == "events" else _ORDER_BASE_SQL


def tx_sql(source: str = "events") -> str:
    """CTEs ``base`` and ``tx``; append further CTEs after a comma."""
    return f"WITH base AS ({_bases(source)}),\ntx AS (SELECT {_select(ROLE_COLUMNS)} FROM base)"


def wide_sql(source: str = "events") -> str:
    return (
        f"WITH base AS ({_bases(source)}),\n"
        f"tx AS (SELECT {_select({**ROLE_COLUMNS, **V_EXPRESSIONS})} FROM base)"
    )


def scored_sql(source: str = "events") -> str:
    return f"WITH base AS ({_bases(source)}),\nsc AS (SELECT {_select(SCORED_COLUMNS)} FROM base)"


IDENTITY_SQL = """idt AS (SELECT l_orderkey AS TransactionID, count(*) AS id_01,
  CAST(max(l_linenumber) AS DOUBLE) AS id_13, min(l_linestatus) AS DeviceType
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)"""

CLIENT_SQL = """CASE WHEN addr1 IS NULL OR D1 IS NULL THEN NULL ELSE
  concat(card1, '_', addr1, '_', TransactionDT // 86400 - D1) END"""
