"""Where results go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeward.functions.derive import Derivation, apply_derivations
from timeward.names import ID

# A run's folder is a digest of its name, so that any name makes a folder and no type is guessed from it.
_RUN_FOLDER = "_run_folder"


def write_full(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replaces the table; features and splits are rebuilt whole, never patched."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, *, key: str = ID, buckets: int, path: str | None = None) -> DataFrame:
    """Replaces a catalog table bucketed and sorted by its key.

    Joined rows, features, model input and splits share one key. Stored with the same number of
    buckets they join without a shuffle, which for rows of hundreds of columns is most of the cost.
    """
    # Rows of one bucket go to one task first, so that a bucket is one file.
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_run(df: DataFrame, path: str, *, key: str = "run") -> None:
    """Writes the rows of each run in ``df`` in place of what the log holds of that run; other runs stay.

    A retried run leaves its rows once. Only the folders of the runs at hand are replaced.
    """
    rows = df.withColumn(_RUN_FOLDER, F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_RUN_FOLDER).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows; columns added by a later append are NULL in earlier rows."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(_RUN_FOLDER)


def export_audit_frame(
    model_input: DataFrame,
    path: str,
    derivations: Sequence[Derivation] = (),
    maps: DataFrame | None = None,
) -> DataFrame:
    """Model input plus derived columns as parquet; returns rows, columns and derived added."""
    frame = apply_derivations(model_input, derivations, maps)
    frame.write.mode("overwrite").parquet(path)
    written = model_input.sparkSession.read.parquet(path)
    return written.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(written.columns)).alias("columns"),
        F.lit(len(written.columns) - len(model_input.columns)).alias("derived"),
    )


def write_submission(scored: DataFrame, path: str, score: str, *, id: str = ID, name: str = "isFraud") -> None:
    scored.select(id, F.col(score).alias(name)).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str, **provenance: str) -> None:
    """Metric rows with their provenance as JSON lines."""
    tags = {k: F.lit(v) for k, v in provenance.items()}
    (metrics.withColumns(tags) if tags else metrics).write.mode("append").json(path)
