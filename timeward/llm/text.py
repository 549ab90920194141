"""Small helpers that the corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters between words: \x20 and \x09-\x0D. Python's bytes.split() cuts at exactly these.
BLANKS = " \t\n\x0b\f\r"

# A batch of rows sent to Python holds at most this many rows; texts can be long.
BATCH_ROWS = "256"


def settle(spark: SparkSession) -> SparkSession:
    """Bounds what one batch between the JVM and Python holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def arrow_column(function: Callable, kind: str) -> Callable[..., Column]:
    """An Arrow-batched column function. Marked non-deterministic so that the optimizer never
    copies it into a filter and evaluates it twice."""
    return F.arrow_udf(function, kind).asNondeterministic()


def as_bytes(texts) -> list[bytes]:
    """UTF-8 of a batch of texts; null becomes empty."""
    import pyarrow as pa

    return [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def blank_less(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(divisor))


def fresh(rows: DataFrame, stem: str) -> str:
    """A column name that ``rows`` doesn't have."""
    taken = {c.lower() for c in rows.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def some_labelled(
    labels: DataFrame, label: str, allowed: Column, per_class: int
) -> DataFrame:
    """At most ``per_class`` labelled ids of either class, in the order of a hash of the id.

    Returns ``id, label``; at most twice ``per_class`` rows, so that it can be broadcast. An id that
    is labelled more than once takes its smallest label.
    """
    seen = (
        labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    picked = [seen.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return picked[0].unionByName(picked[1])
