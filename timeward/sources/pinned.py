"""Loading CSV into typed tables under a pinned schema, and proving it stayed pinned.

Whole numbers often arrive written with a decimal point. Read as integers they would silently
become NULL, so integer columns are read as doubles, every value is proven whole in one pass over
all columns, and only then are they cast back.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.functions.scalars import boolean_from_text, is_fractional
from timeward.names import DEVICE, ID, LABEL
from timeward.session import path_exists, scratch_path, swap_in
from timeward.sources.proof import Proof, proved_write


class LoadError(Exception):
    """The file and the pinned schema disagree."""


# The names a pinned type may go by.
_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


@dataclass(frozen=True)
class Pin:
    name: str
    type: str

    @property
    def spark_type(self) -> T.DataType:
        return _TYPES[self.type]


def pins_from_json(text: str) -> list[Pin]:
    """A pinned schema from its JSON list of ``{name, type, mode}``."""
    return [Pin(f["name"], f["type"].upper()) for f in json.loads(text)]


def pins_of(schema: T.StructType) -> list[Pin]:
    known = {"bigint": "INTEGER", "int": "INTEGER", "double": "FLOAT", "boolean": "BOOLEAN"}
    return [Pin(f.name, known.get(f.dataType.simpleString(), "STRING")) for f in schema.fields]


def transaction_pins() -> list[Pin]:
    """The pinned transaction schema: 394 columns, by rule. Names and types are fixed values."""
    out = [(ID, "INTEGER"), (LABEL, "INTEGER"), ("TransactionDT", "INTEGER")]
    out += [("TransactionAmt", "FLOAT"), ("ProductCD", "STRING")]
    out += [(f"card{i}", "STRING" if i in (4, 6) else "INTEGER") for i in range(1, 7)]
    out += [(c, "INTEGER") for c in ("addr1", "addr2", "dist1", "dist2")]
    out += [("P_emaildomain", "STRING"), ("R_emaildomain", "STRING")]
    out += [(f"C{i}", "INTEGER") for i in range(1, 15)]
    out += [(f"D{i}", "FLOAT" if i in (8, 9, 13, 14, 15) else "INTEGER") for i in range(1, 16)]
    out += [(f"M{i}", "STRING" if i == 4 else "BOOLEAN") for i in range(1, 10)]
    out += [(f"V{i}", "FLOAT") for i in range(1, 340)]
    return [Pin(*p) for p in out]


def identity_pins() -> list[Pin]:
    """The pinned identity schema: 41 columns. Names and types are fixed values."""
    text = {12, 15, 16, 23, 27, 28, 29, 30, 31, 33, 34}
    flag = {35, 36, 37, 38}
    out = [(ID, "INTEGER")]
    for i in range(1, 39):
        kind = "STRING" if i in text else "BOOLEAN" if i in flag else "FLOAT"
        out.append((f"id_{i:02d}", kind))
    return [Pin(*p) for p in [*out, ("DeviceType", "STRING"), (DEVICE, "STRING")]]


def scoring_pins(pins: Sequence[Pin], label: str = LABEL) -> list[Pin]:
    """The schema of a period that has no labels yet."""
    return [p for p in pins if p.name != label]


def integer_columns(pins: Sequence[Pin]) -> list[str]:
    return [p.name for p in pins if isinstance(p.spark_type, T.LongType)]


def staging_schema(pins: Sequence[Pin]) -> T.StructType:
    """Integers widened to doubles, booleans as text; everything else as pinned."""
    widened = {T.LongType: T.DoubleType(), T.BooleanType: T.StringType()}
    return T.StructType(
        [T.StructField(p.name, widened.get(type(p.spark_type), p.spark_type)) for p in pins]
    )


def read_staging(spark: SparkSession, path: str, pins: Sequence[Pin]) -> DataFrame:
    """The file by position, so header spelling does not matter; a malformed number raises."""
    return spark.read.csv(path, schema=staging_schema(pins), header=True, mode="FAILFAST")


def fractional_counts(staged: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """One row: per column, how many values a cast to integer would change. One scan for all."""
    if not columns:
        return None
    return staged.agg(*[F.count_if(is_fractional(c)).alias(c) for c in columns])


def require_whole(staged: DataFrame, columns: Sequence[str]) -> None:
    counts = fractional_counts(staged, columns)
    if counts is None:
        return
    _raise_fractions({c: n for c, n in counts.first().asDict().items() if n})


def _raise_fractions(found: dict[str, int]) -> None:
    if found:
        listed = ", ".join(f"{c} ({n})" for c, n in sorted(found.items()))
        raise LoadError(f"pinned as integers but holding fractions: {listed}")


def cast_back(staged: DataFrame, pins: Sequence[Pin]) -> DataFrame:
    """Every pinned column in order, in its pinned type."""
    return staged.select(*_pinned_columns(pins))


def _pinned_columns(pins: Sequence[Pin]) -> list[Column]:
    out = []
    for p in pins:
        if isinstance(p.spark_type, T.LongType):
            out.append(F.col(p.name).cast("bigint").alias(p.name))
        elif isinstance(p.spark_type, T.BooleanType):
            out.append(boolean_from_text(p.name).alias(p.name))
        else:
            out.append(F.col(p.name))
    return out


def stage_pinned(spark: SparkSession, source: str, pins: Sequence[Pin], path: str, label: str = LABEL) -> Proof:
    """Parses the source once: cast and written to ``path``, proven on the way.

    Raises when a column pinned as integer holds fractions, or a label is neither 0 nor 1; then nothing
    but the staged folder is left behind.
    """
    staged = read_staging(spark, source, pins)
    names = {p.name for p in pins}
    counts = {c: is_fractional(c) for c in integer_columns(pins)}
    labels = "invalid labels"
    if label in names:
        counts[labels] = _is_invalid(label)
    key = ID if ID in names else pins[0].name
    proof = proved_write(staged, path, key=key, counts=counts, out=_pinned_columns(pins))
    found = proof.found
    wrong = found.pop(labels, 0)
    _raise_fractions(found)
    if wrong:
        raise LoadError(f"{wrong} label(s) other than 0 and 1")
    return proof


def load_pinned(spark: SparkSession, path: str, pins: Sequence[Pin]) -> DataFrame:
    """Read, prove, cast: one parse, after which the typed table is read from the shared folder."""
    staged = scratch_path(spark, "staged")
    stage_pinned(spark, path, pins, staged)
    return spark.read.schema(T.StructType([T.StructField(p.name, p.spark_type) for p in pins])).parquet(staged)


def load_typed(spark: SparkSession, path: str, pins: Sequence[Pin]) -> DataFrame:
    """Straight into the pinned types, for files whose integers are written as integers."""
    booleans = {p.name for p in pins if isinstance(p.spark_type, T.BooleanType)}
    schema = T.StructType(
        [T.StructField(p.name, T.StringType() if p.name in booleans else p.spark_type) for p in pins]
    )
    read = spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")
    return read.withColumns({b: boolean_from_text(b) for b in booleans}) if booleans else read


def load_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Schema from the data: local development only, since it reads the file twice."""
    return spark.read.csv(path, header=True, inferSchema=True)


# ---- checks on the file ----------------------------------------------------------------------


def _first_of_each():
    """The first row of each file, as rows pass by: an aggregate would sort all lines of a file's first block."""

    def run(batches):
        seen = set()
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            new = [k for k, name in enumerate(files.dictionary.to_pylist()) if name not in seen]
            if new:
                seen.update(files.dictionary.take(pa.array(new)).to_pylist())
                yield batch.take(pa.array([pc.index(files.indices, pa.scalar(k, pa.int32())).as_py() for k in new]))

    return run


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of each file at ``path``."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    # One task reads a file from its start, and its first line is the first one read.
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header")).mapInArrow(
        _first_of_each(), "file string, header string"
    )


def _differs(header: Column, pins: Sequence[Pin]) -> Column:
    """Does a header line name anything else than the pins, position by position?"""
    columns = ", ".join([f"c{k} string" for k in range(len(pins))] + ["other string"])
    # A line of more or fewer names than pins is kept whole, in ``other``.
    reading = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "columnNameOfCorruptRecord": "other"}
    parsed = F.from_csv(header, columns, reading)
    same = parsed["other"].isNull()
    for k, p in enumerate(pins):
        same &= F.coalesce(F.translate(parsed[f"c{k}"], "-", "_") == p.name, F.lit(False))
    return ~same


def header_mismatches(header: Sequence[str], pins: Sequence[Pin]) -> list[str]:
    """Up to five positions whose names differ once ``-`` reads as ``_``."""
    if len(header) != len(pins):
        return [f"{len(header)} columns against {len(pins)} pinned"]
    wrong = [
        f"{i}: {h} is not {p.name}"
        for i, (h, p) in enumerate(zip(header, pins))
        if h.replace("-", "_") != p.name
    ]
    return wrong[:5]


def require_header(spark: SparkSession, path: str, pins: Sequence[Pin]) -> None:
    """Raises if any file at ``path`` has another header than the pins name, position by position.

    Every file's header is compared in the job; the counts and one wrong header come back.
    """
    wrong = F.when(_differs(F.col("header"), pins), F.col("header"))
    found = header_lines(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.count(wrong).alias("wrong"), F.min(wrong).alias("header")
    ).first()
    if not found["files"]:
        raise LoadError(f"{path} is empty")
    if found["wrong"]:
        header = [name.strip() for name in next(csv.reader([found["header"]], skipinitialspace=True), [])]
        raise LoadError(f"{path}: in {found['wrong']} of {found['files']} file(s), {'; '.join(header_mismatches(header, pins))}")


def _is_invalid(label: str) -> Column:
    value = F.col(label).try_cast("double")
    return F.col(label).isNotNull() & ~F.coalesce(value.isin(0.0, 1.0), F.lit(False))


def validation_scan(
    rows: DataFrame, required: Sequence[str], label: str | None = None
) -> DataFrame:
    """One row: the row count, rows whose label is neither 0 nor 1, required columns absent."""
    absent = ",".join(sorted(c for c in required if c not in rows.columns))
    wrong = F.lit(0).cast("bigint")
    if label is not None and label in rows.columns:
        wrong = F.count_if(_is_invalid(label))
    return rows.agg(F.count(F.lit(1)).alias("rows"), wrong.alias("invalid_labels")).withColumn(
        "missing_columns", F.lit(absent)
    )


def invalid_labels(rows: DataFrame, label: str) -> DataFrame:
    """(label, rows) for every value other than 0 and 1."""
    return (
        rows.where(_is_invalid(label))
        .groupBy(F.col(label).cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def require_valid(rows: DataFrame, required: Sequence[str], label: str | None = None) -> int:
    """The row count, or an error when a column is absent or a label is invalid."""
    found = validation_scan(rows, required, label).first()
    if found["missing_columns"]:
        raise LoadError(f"required column(s) absent: {found['missing_columns']}")
    if found["invalid_labels"]:
        # A few of them for the message.
        shown = [r["label"] for r in invalid_labels(rows, label).orderBy("label").limit(5).collect()]
        raise LoadError(f"{found['invalid_labels']} label(s) other than 0 and 1, e.g. {', '.join(shown)}")
    return found["rows"]


# ---- is a load needed? -----------------------------------------------------------------------


def source_fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when a source file is added, removed, resized or rewritten.

    Only the listing is read, not the contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # An order-free sum, so that any number of files is combined map-side.
    tagged = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(tagged).alias("tag"))
    text = F.concat_ws("|", "files", "bytes", "tag")
    return found.select(F.substring(F.sha2(text, 256), 1, 63).alias("f")).first()["f"]


def schema_matches(schema: T.StructType, pins: Sequence[Pin]) -> bool:
    live = {f.name: f.dataType for f in schema.fields}
    return all(p.name in live and live[p.name] == p.spark_type for p in pins)


def record_load(spark: SparkSession, manifest: str, fingerprint: str, rows: int) -> None:
    stamped = spark.range(1).select(
        F.lit(fingerprint).alias("fingerprint"), F.lit(rows).cast("bigint").alias("rows"), F.current_timestamp().alias("loaded_at")
    )
    stamped.write.mode("append").parquet(manifest)


def is_current(
    spark: SparkSession,
    target: str,
    manifest: str,
    fingerprint: str,
    pins: Sequence[Pin],
    expected_rows: int | None = None,
) -> bool:
    """Does the target exist with the pinned types, the same source, and the expected rows?

    Those are the rows of the last load where none are given: the source is the same, so it has no others.
    """
    if not (path_exists(spark, target) and path_exists(spark, manifest)):
        return False
    live = spark.read.parquet(target)
    if not schema_matches(live.schema, pins):
        return False
    last = spark.read.parquet(manifest).agg(F.max_by(F.struct("fingerprint", "rows"), "loaded_at").alias("l")).first()["l"]
    if last is None or last["fingerprint"] != fingerprint:
        return False
    return live.count() == (last["rows"] if expected_rows is None else expected_rows)


def refresh(
    spark: SparkSession, source: str, target: str, manifest: str, pins: Sequence[Pin]
) -> DataFrame:
    """Loads the source unless the target is already current; returns the load summary.

    A current target costs a listing and a count from footers, a load one parse. The old target stays until
    the new one is proven.
    """
    fingerprint = source_fingerprint(spark, source)
    status = "current"
    if not is_current(spark, target, manifest, fingerprint, pins):
        status = "loaded"
        staged = f"{target.rstrip('/')}-staged-{fingerprint[:16]}"
        proof = stage_pinned(spark, source, pins, staged)
        swap_in(spark, staged, target)
        record_load(spark, manifest, fingerprint, proof.rows)
    spark.catalog.refreshByPath(target)
    table = spark.read.parquet(target)
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(status).alias("status"),
        "rows",
        F.lit(len(table.columns)).alias("columns"),
        F.lit(fingerprint).alias("fingerprint"),
    )
