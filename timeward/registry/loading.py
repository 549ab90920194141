"""Loading and writing: each query sends a whole table through a file and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeward.functions.derive import Derivation
from timeward.names import ID, LABEL
from timeward.registry import query
from timeward.registry.adapters import (
    ROLE_COLUMNS,
    scored,
    scored_sql,
    table,
    transactions,
    tx_sql,
)
from timeward.session import scratch_path
from timeward.sources.pinned import (
    Pin,
    cast_back,
    fractional_counts,
    integer_columns,
    invalid_labels,
    load_inferred,
    load_pinned,
    load_typed,
    pins_from_json,
    pins_of,
    read_staging,
    refresh,
    require_header,
    scoring_pins,
    validation_scan,
)
from timeward.sources.sinks import (
    append_log,
    export_audit_frame,
    read_log,
    write_full,
    write_metrics,
    write_submission,
)


def _as_csv(df, name: str) -> str:
    """The table as CSV with whole numbers written as ``1.0``, as such files often are."""
    path = scratch_path(df.sparkSession, name)
    whole = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("bigint", "int")}
    df.select(
        *[F.col(c).cast("double").alias(c) if c in whole else F.col(c) for c in df.columns]
    ).write.option("header", True).csv(path)
    return path


_LINE_PINS = [
    Pin("l_orderkey", "INTEGER"),
    Pin("l_partkey", "INTEGER"),
    Pin("l_linenumber", "INTEGER"),
    Pin("l_quantity", "INTEGER"),
    Pin("l_extendedprice", "FLOAT"),
    Pin("l_discount", "INTEGER"),
    Pin("l_returnflag", "STRING"),
]
_LINE_COLUMNS = [p.name for p in _LINE_PINS]


def _labelled_csv(spark, folder):
    path = scratch_path(spark, "scan")
    rows = transactions(spark, folder).select(ID, F.col("D5").alias(LABEL))
    rows.write.option("header", True).csv(path)
    return spark.read.csv(path, header=True)


@query(
    "a01_validation_scan",
    "A1",
    f"""{tx_sql()}
SELECT count(*) AS "rows", count(*) FILTER (D5 NOT IN (0, 1)) AS invalid_labels, 'gone' AS missing_columns FROM tx""",
)
def validation_scan_query(spark, folder):
    return validation_scan(_labelled_csv(spark, folder), [ID, LABEL, "gone"], LABEL)


@query(
    "a01_invalid_labels",
    "A1",
    f"""{tx_sql()}
SELECT CAST(D5 AS VARCHAR) AS label, count(*) AS "rows" FROM tx WHERE D5 NOT IN (0, 1) GROUP BY D5""",
)
def invalid_labels_query(spark, folder):
    return invalid_labels(_labelled_csv(spark, folder), LABEL)


@query(
    "a02_identity_scan",
    "A2",
    f"""{tx_sql()}
SELECT count(*) AS "rows", 0 AS invalid_labels, '' AS missing_columns FROM tx""",
)
def identity_scan(spark, folder):
    path = scratch_path(spark, "identity-scan")
    transactions(spark, folder).select(ID, "DeviceInfo").write.option("header", True).csv(path)
    return validation_scan(spark.read.csv(path, header=True), [ID, "DeviceInfo"])


@query(
    "a05_fractional_counts",
    "A5 A4 H7",
    """SELECT count(*) FILTER (l_orderkey <> trunc(l_orderkey)) AS l_orderkey,
  count(*) FILTER (l_partkey <> trunc(l_partkey)) AS l_partkey,
  count(*) FILTER (l_linenumber <> trunc(l_linenumber)) AS l_linenumber,
  count(*) FILTER (l_quantity <> trunc(l_quantity)) AS l_quantity,
  count(*) FILTER (l_discount <> trunc(l_discount)) AS l_discount FROM lineitem""",
)
def fractional_counts_query(spark, folder):
    path = _as_csv(table(spark, folder, "lineitem").select(*_LINE_COLUMNS), "lines")
    return fractional_counts(read_staging(spark, path, _LINE_PINS), integer_columns(_LINE_PINS))


@query(
    "a06_pinned_load",
    "A3 A4 A5 A6 A12 H8",
    f"{tx_sql()}\nSELECT * FROM tx",
)
def pinned_load(spark, folder):
    rows = transactions(spark, folder)
    pins = pins_of(rows.schema)
    return load_pinned(spark, _as_csv(rows, "pinned"), pins)


@query(
    "a03_pins_from_json",
    "A3 A6",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""",
)
def pins_from_json_query(spark, folder):
    pins = pins_from_json(
        """[{"name": "o_orderkey", "type": "INTEGER", "mode": "NULLABLE"},
            {"name": "o_custkey", "type": "INT64", "mode": "NULLABLE"},
            {"name": "o_orderstatus", "type": "STRING", "mode": "NULLABLE"},
            {"name": "o_totalprice", "type": "FLOAT", "mode": "NULLABLE"}]"""
    )
    rows = table(spark, folder, "orders").select(*[p.name for p in pins])
    return cast_back(read_staging(spark, _as_csv(rows, "orders"), pins), pins)


@query(
    "a08_positional_header",
    "A8 A9",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""",
)
def positional_header(spark, folder):
    """The file spells its header with dashes and has no label column."""
    pins = scoring_pins(
        [
            Pin("l_orderkey", "INTEGER"),
            Pin("isFraud", "INTEGER"),
            Pin("l_partkey", "INTEGER"),
            Pin("l_linenumber", "INTEGER"),
            Pin("l_quantity", "FLOAT"),
            Pin("l_returnflag", "STRING"),
        ]
    )
    lines = table(spark, folder, "lineitem").select(
        *[F.col(p.name).alias(p.name.replace("_", "-")) for p in pins]
    )
    path = scratch_path(spark, "dashes")
    lines.write.option("header", True).csv(path)
    require_header(spark, path, pins)
    return load_pinned(spark, path, pins)


@query(
    "a10_typed_load",
    "A10",
    "SELECT doc_id, quality, toxic FROM labels",
)
def typed_load(spark, folder):
    path = scratch_path(spark, "labels")
    table(spark, folder, "labels").write.option("header", True).csv(path)
    return load_typed(
        spark, path, [Pin("doc_id", "INTEGER"), Pin("quality", "INTEGER"), Pin("toxic", "INTEGER")]
    )


@query(
    "a11_inferred_load",
    "A11",
    "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
)
def inferred_load(spark, folder):
    path = scratch_path(spark, "part")
    parts = table(spark, folder, "part")
    parts.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice").write.option(
        "header", True
    ).csv(path)
    return load_inferred(spark, path)


@query(
    "a13_idempotent_load",
    "A13 A14 A20",
    """SELECT 1 AS step, 'loaded' AS status, count(*) AS "rows", 3 AS "columns" FROM orders
UNION ALL SELECT 2, 'current', count(*), 3 FROM orders
UNION ALL SELECT 3, 'loaded', count(*), 3 FROM orders""",
)
def idempotent_load(spark, folder):
    """The first load runs, the second finds it current, a retyped column makes it stale."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    source = _as_csv(rows, "source")
    target, manifest = scratch_path(spark, "target"), scratch_path(spark, "manifest")
    pins = [Pin("o_orderkey", "INTEGER"), Pin("o_custkey", "INTEGER"), Pin("o_totalprice", "FLOAT")]
    retyped = [pins[0], Pin("o_custkey", "FLOAT"), pins[2]]
    out = None
    for step, wanted in enumerate([pins, pins, retyped], start=1):
        found = refresh(spark, source, target, manifest, wanted).first()
        row = spark.read.parquet(manifest).limit(1).select(
            F.lit(step).alias("step"),
            F.lit(found["status"]).alias("status"),
            F.lit(found["rows"]).alias("rows"),
            F.lit(found["columns"]).alias("columns"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "a14_full_refresh",
    "A14",
    'SELECT event_type, count(*) AS "rows" FROM events GROUP BY event_type',
)
def full_refresh(spark, folder):
    path = scratch_path(spark, "refresh")
    events = table(spark, folder, "events").select("event_id", "event_type")
    write_full(events, path, partition_by=["event_type"])
    again = write_full(events, path, partition_by=["event_type"])
    return again.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a15_append_with_new_column",
    "A15 M10",
    f"""{scored_sql()}
SELECT TransactionID, probability, 'r1' AS run, CAST(NULL AS BIGINT) AS score FROM sc
UNION ALL SELECT TransactionID, probability, 'r2', score FROM sc""",
)
def append_with_new_column(spark, folder):
    path = scratch_path(spark, "log")
    rows = scored(spark, folder)
    append_log(rows.select(ID, "probability", F.lit("r1").alias("run")), path)
    append_log(rows.select(ID, "probability", F.lit("r2").alias("run"), "score"), path)
    return read_log(spark, path).select(ID, "probability", "run", "score")


@query(
    "a16_audit_frame",
    "A16 D30",
    f"""{tx_sql()}
SELECT count(*) AS "rows", {len(ROLE_COLUMNS) + 2} AS "columns", 2 AS derived FROM tx""",
)
def audit_frame(spark, folder):
    declared = [
        Derivation("D1n", "days_since_to_start_day", ("D1",)),
        Derivation("M4_is_M0", "one_hot", ("M4",), {"level": "M0"}),
    ]
    return export_audit_frame(transactions(spark, folder), scratch_path(spark, "audit"), declared)


@query(
    "a18_submission",
    "A18",
    f"{scored_sql('orders')}\nSELECT TransactionID, probability AS isFraud FROM sc",
)
def submission(spark, folder):
    path = scratch_path(spark, "submission")
    write_submission(scored(spark, folder, "orders"), path, "probability")
    return load_typed(spark, path, [Pin(ID, "INTEGER"), Pin(LABEL, "FLOAT")])


@query(
    "a19_metrics_as_json",
    "A19",
    """SELECT o_orderpriority, count(*) AS "rows", 'run-1' AS run FROM orders GROUP BY o_orderpriority""",
)
def metrics_as_json(spark, folder):
    path = scratch_path(spark, "metrics")
    counts = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows")
    )
    write_metrics(counts, path, run="run-1")
    return spark.read.schema("o_orderpriority string, rows bigint, run string").json(path)
