"""A corpus from raw documents to training sequences: five stages, each one operator.

Each stage takes (spark, docs, folder) and returns a DataFrame; it is written as Parquet to the
shared folder and read again as the next stage's documents. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeward.llm import mixing, near_copies, outliers, packing, secret_scan, simhash
from timeward.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base or lie far outside their group go."""
    return outliers.with_verdict(docs, stats="_stats", out="_kept").where("_kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies one document stays: by SimHash tiles, as op10 links them, and by 5-word shingles
    from a similarity of 0.8 on."""
    return near_copies.one_of_each(docs, radius=simhash.RADIUS)


def secret_scans(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Small sources are repeated towards the target weights; every document stays. Each file holds a stretch of the
    permutation: a source's blocks in the order of pass and place."""
    mixed = mixing.mixed(docs)
    order = ["source", "mix_pass", "mix_place", F.xxhash64("doc_id"), "doc_id"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of a power of two of ids, one row each."""
    return packing.pack(docs).select(
        "doc_id", "lang", "source", "start", "length", "bucket", "ids", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("packing", pack),
]

# Neither 64-bit XXH nor the tokenizer has a counterpart in SQL; tests/llm holds each stage, and the
# whole, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Applies the stages to the documents in ``folder``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, folder), name)
    return docs
