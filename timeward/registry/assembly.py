"""Projections, joins, unions and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.functions.derive import (
    Derivation,
    apply_derivations,
    frequency_map,
    frequency_summary,
)
from timeward.functions.scalars import boolean_from_text, client_key, positive_probability
from timeward.names import CLIENT, FEATURES, ID, LABEL, TIME, V_COLUMNS
from timeward.operators.assemble import (
    align_to,
    assemble_model_input,
    column_kinds,
    contract_view,
    drop_roles,
    join_identity,
    join_scoring_identity,
    prepare_types,
    scoring_history,
    shape_of,
    vocabulary,
)
from timeward.operators.lookups import left_attach, names_in_both, names_missing_from, with_lookup
from timeward.plans.features import transaction_features
from timeward.policy import DEFAULT_DERIVATIONS, Policy
from timeward.registry import query
from timeward.registry.adapters import (
    CLIENT_SQL,
    IDENTITY_SQL,
    ROLE_COLUMNS,
    V_EXPRESSIONS,
    identity,
    scored,
    scored_sql,
    table,
    transactions,
    tx_sql,
    wide_sql,
    wide_transactions,
)
from timeward.registry.history import AGGREGATES, features_cte, rounded

_NULLS_SQL = " + ".join(f"(CASE WHEN tx.{v} IS NULL THEN 1 ELSE 0 END)" for v in V_EXPRESSIONS)


@query(
    "d01_null_count_full_block",
    "D1",
    f"{wide_sql()}\nSELECT TransactionID, CAST({_NULLS_SQL} AS INT) AS null_count_V_block FROM tx",
)
def null_count_full_block(spark, folder):
    from timeward.functions.scalars import missing_count

    return wide_transactions(spark, folder).select(
        ID, missing_count(V_COLUMNS).alias("null_count_V_block")
    )


_ORDER_COLUMNS = ", ".join(f"tx.{c}" for c in ROLE_COLUMNS)
_JOINED_ORDERS = f"""{wide_sql('orders')},
{IDENTITY_SQL},
jn AS (SELECT {_ORDER_COLUMNS}, idt.id_01, idt.id_13, idt.DeviceType,
  CAST({_NULLS_SQL} AS INT) AS null_count_V_block
FROM tx LEFT JOIN idt ON tx.TransactionID = idt.TransactionID)"""


def _joined_orders(spark, folder):
    rows = wide_transactions(spark, folder, "orders").select(*ROLE_COLUMNS, *V_COLUMNS)
    return join_identity(rows, identity(spark, folder), block=V_COLUMNS).drop(*V_COLUMNS)


query("c01_left_join_identity", "C1 B1 D1 A20", f"{_JOINED_ORDERS}\nSELECT * FROM jn")(_joined_orders)


@query(
    "c01_documents_with_labels",
    "C1",
    """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def documents_with_labels(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return left_attach(docs, table(spark, folder, "labels"), "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )


@query(
    "c02_scoring_join_without_label",
    "C2",
    f"""{wide_sql('orders')},
{IDENTITY_SQL}
SELECT tx.TransactionID, tx.TransactionDT, tx.TransactionAmt, idt.id_01, idt.id_13, idt.DeviceType,
  CAST({_NULLS_SQL} AS INT) AS null_count_V_block, CAST(NULL AS BIGINT) AS isFraud
FROM tx LEFT JOIN idt USING (TransactionID)""",
)
def scoring_join_without_label(spark, folder):
    rows = wide_transactions(spark, folder, "orders").select(ID, TIME, "TransactionAmt", *V_COLUMNS)
    return join_scoring_identity(rows, identity(spark, folder), block=V_COLUMNS).drop(*V_COLUMNS)


_FEATURE_LIST = ", ".join(f"ft.{c}" for c in [CLIENT, *FEATURES, *AGGREGATES])


@query(
    "c03_model_input",
    "C3 B2 E14",
    f"""{tx_sql()},
{features_cte()}
SELECT tx.*, {_FEATURE_LIST} FROM tx JOIN ft ON tx.TransactionID = ft.TransactionID""",
)
def model_input_query(spark, folder):
    from timeward.registry.history import all_features

    joined = transactions(spark, folder)
    features = all_features(spark, folder, "events")
    return rounded(assemble_model_input(joined, features, [CLIENT, *FEATURES, *AGGREGATES]))


@query(
    "b03_features_without_roles",
    "B3",
    f"{tx_sql()}\nSELECT * EXCLUDE (TransactionID, TransactionDT, isFraud) FROM tx",
)
def features_without_roles(spark, folder):
    return drop_roles(transactions(spark, folder))


_PREPARED = ", ".join(
    {
        "TransactionAmt": "CAST(CAST(TransactionAmt AS REAL) AS DOUBLE) AS TransactionAmt",
        "D15": "CAST(D15 AS DOUBLE) AS D15",
    }.get(c, f"CAST(CAST({c} AS INT) AS DOUBLE) AS {c}" if c[0] == "M" and c != "M4" else c)
    for c in ROLE_COLUMNS
    if c not in ("TransactionID", "TransactionDT", "isFraud")
)


@query(
    "b08_types_for_the_learner",
    "B8 B13",
    f"""{tx_sql('orders')}, {IDENTITY_SQL}
SELECT TransactionID, {_PREPARED}, CAST(id_13 AS VARCHAR) AS id_13
FROM tx LEFT JOIN idt USING (TransactionID)""",
)
def types_for_the_learner(spark, folder):
    joined = left_attach(
        transactions(spark, folder, "orders"),
        identity(spark, folder).select(ID, "id_13"),
        ID,
    )
    prepared = prepare_types(joined, keep=[ID]).drop(TIME, LABEL)
    # Shown as doubles: the comparison has no single-precision type.
    return prepared.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.FloatType)
            else F.col(f.name)
            for f in prepared.schema.fields
        ]
    )


def _halves(spark, folder):
    """Rows up to a fixed instant near the middle of the events table, and the later ones."""
    rows = transactions(spark, folder)
    cut = 1_705_276_800  # 2024-01-15
    return rows.where(F.col(TIME) <= cut), rows.where(F.col(TIME) > cut)


_HALVES_SQL = """tr AS (SELECT * FROM tx WHERE TransactionDT <= 1705276800),
la AS (SELECT * FROM tx WHERE TransactionDT > 1705276800)"""


@query(
    "b09_align_to_training",
    "B9 A12 H9",
    f"""{tx_sql()}, {_HALVES_SQL}
SELECT TransactionID, TransactionAmt,
  CASE WHEN ProductCD IN (SELECT ProductCD FROM tr WHERE ProductCD IS NOT NULL AND card1 % 3 = 0)
    THEN ProductCD END AS ProductCD,
  CASE WHEN DeviceInfo IN (SELECT DeviceInfo FROM tr WHERE DeviceInfo IS NOT NULL AND card1 % 3 = 0)
    THEN DeviceInfo END AS DeviceInfo,
  CASE WHEN C1 % 3 = 0 THEN true WHEN C1 % 3 = 1 THEN false END AS M1,
  CASE WHEN C2 % 2 = 0 THEN CAST(C2 AS DOUBLE) END AS D2,
  CAST(NULL AS BIGINT) AS D9
FROM la""",
)
def align_to_training(spark, folder):
    train, later = _halves(spark, folder)
    reference = T.StructType.fromDDL(
        "TransactionAmt double, ProductCD string, DeviceInfo string, M1 boolean, D2 double, D9 bigint"
    )
    texts = later.select(
        ID,
        "TransactionAmt",
        "ProductCD",
        "DeviceInfo",
        F.expr("CASE C1 % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'False' ELSE 'maybe' END").alias("M1"),
        F.expr("CASE WHEN C2 % 2 = 0 THEN cast(C2 AS string) ELSE 'x' END").alias("D2"),
        F.lit("dropped").alias("extra"),
    )
    # A training sample that does not hold every level, so that unseen ones appear.
    seen = vocabulary(train.where("card1 % 3 = 0"), ["ProductCD", "DeviceInfo"])
    return align_to(texts, reference, levels=seen, carry=[ID])


_UNION_SQL = f"""{tx_sql()}, {_HALVES_SQL},
hist AS (SELECT TransactionID, TransactionDT, TransactionAmt, card1, DeviceInfo, addr1, D1, isFraud, 'train' AS origin FROM tr
UNION ALL SELECT TransactionID, TransactionDT, TransactionAmt, card1, DeviceInfo, addr1, D1, CAST(NULL AS BIGINT), 'test' FROM la)"""


def _union(spark, folder):
    train, later = _halves(spark, folder)
    columns = [ID, TIME, "TransactionAmt", "card1", "DeviceInfo", "addr1", "D1", LABEL]
    scoring = later.drop(LABEL).withColumn("extra", F.lit(1))
    return scoring_history(train.select(*columns), scoring)


query("g01_scoring_history", "G1 B10 B11", f"{_UNION_SQL}\nSELECT * FROM hist")(_union)


@query(
    "e17_features_over_union",
    "E17 C5",
    f"""{tx_sql()}, {_HALVES_SQL},
hist AS (SELECT *, 'train' AS origin FROM tr UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS isFraud), 'test' FROM la),
{features_cte('hist')}
SELECT la.TransactionID, {_FEATURE_LIST} FROM ft JOIN la ON ft.TransactionID = la.TransactionID""",
)
def features_over_union(spark, folder):
    train, later = _halves(spark, folder)
    history = scoring_history(train, later.drop(LABEL).withColumn("extra", F.lit(1)))
    features = transaction_features(history, derivations=Policy().spread_derivations())
    # Rows are picked after the windows, so a scoring row sees the training period.
    return rounded(assemble_model_input(later.select(ID), features, [CLIENT, *FEATURES, *AGGREGATES]))


# ---- derived columns -------------------------------------------------------------------------

_ROW_LOCAL = [
    d
    for d in DEFAULT_DERIVATIONS
    if d.tool != "frequency_encode" and d.inputs[0] in ROLE_COLUMNS
]
_ROW_LOCAL_SQL = ",\n  ".join(
    f"CAST(TransactionDT // 86400 - {d.inputs[0]} AS DOUBLE) AS {d.name}"
    if d.tool == "days_since_to_start_day"
    else f"CAST(CASE WHEN {d.inputs[0]} IS NULL THEN NULL WHEN {d.inputs[0]} = '{d.params['level']}'"
    f" THEN 1 ELSE 0 END AS TINYINT) AS {d.name}"
    for d in _ROW_LOCAL
)


@query(
    "h03_row_local_derivations",
    "H3 H4 I1",
    f"{tx_sql()}\nSELECT TransactionID,\n  {_ROW_LOCAL_SQL}\nFROM tx",
)
def row_local_derivations(spark, folder):
    out = apply_derivations(transactions(spark, folder), _ROW_LOCAL)
    return out.select(ID, *[d.name for d in _ROW_LOCAL])


@query(
    "i01_chained_derivations",
    "I1 H4",
    f"""{tx_sql()}
SELECT TransactionID, CAST(TransactionDT // 86400 - D3 AS DOUBLE) AS D3n,
  CAST(TransactionDT // 86400 - CAST(TransactionDT // 86400 - D3 AS DOUBLE) AS DOUBLE) AS back FROM tx""",
)
def chained_derivations(spark, folder):
    steps = [
        Derivation("D3n", "days_since_to_start_day", ("D3",)),
        Derivation("back", "days_since_to_start_day", ("D3n",)),
    ]
    return apply_derivations(transactions(spark, folder), steps).select(ID, "D3n", "back")


_MAPPED = ["addr1", "P_emaildomain", "DeviceInfo"]
_COUNTS_SQL = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS val, count(*) AS cnt FROM tr"
    f" WHERE {c} IS NOT NULL GROUP BY ALL"
    for c in _MAPPED
)


@query(
    "d06_frequency_map",
    "D6",
    f"""{tx_sql()}, {_HALVES_SQL}, counts AS ({_COUNTS_SQL})
SELECT col AS "column", val AS "value", cnt AS "count" FROM counts WHERE cnt >= 2""",
)
def frequency_map_query(spark, folder):
    return frequency_map(_halves(spark, folder)[0], _MAPPED)


@query(
    "d06_frequency_summary",
    "D6 H17",
    f"""{tx_sql()}, {_HALVES_SQL}, counts AS ({_COUNTS_SQL})
SELECT col AS "column", count(*) AS levels_seen, count(*) FILTER (cnt >= 40) AS levels_kept,
  round(coalesce(sum(cnt) FILTER (cnt >= 40), 0)::DOUBLE / (SELECT count(*) FROM tr), 4) AS coverage
FROM counts GROUP BY col""",
)
def frequency_summary_query(spark, folder):
    return frequency_summary(_halves(spark, folder)[0], _MAPPED, min_count=40)


@query(
    "h05_frequency_encode",
    "H5 C10",
    f"""{tx_sql()}, {_HALVES_SQL}, counts AS ({_COUNTS_SQL}), kept AS (SELECT * FROM counts WHERE cnt >= 2)
SELECT la.TransactionID, {', '.join(f'm{i}.cnt AS {c}_freq' for i, c in enumerate(_MAPPED))}
FROM la {' '.join(f"LEFT JOIN kept m{i} ON m{i}.col = '{c}' AND m{i}.val = CAST(la.{c} AS VARCHAR)" for i, c in enumerate(_MAPPED))}""",
)
def frequency_encode_query(spark, folder):
    train, later = _halves(spark, folder)
    declared = [Derivation(f"{c}_freq", "frequency_encode", (c,)) for c in _MAPPED]
    out = apply_derivations(later, declared, frequency_map(train, _MAPPED))
    return out.select(ID, *[d.name for d in declared])


@query(
    "c10_dictionary_lookup",
    "C10",
    """SELECT o.o_orderkey, c.c_nationkey AS nation FROM orders o LEFT JOIN
(SELECT * FROM customer WHERE c_acctbal > 5000) c ON o.o_custkey = c.c_custkey""",
)
def dictionary_lookup(spark, folder):
    rich = table(spark, folder, "customer").where("c_acctbal > 5000")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return with_lookup(orders, rich, F.col("o_custkey"), "c_custkey", "c_nationkey", "nation").select(
        "o_orderkey", "nation"
    )


@query(
    "h01_client_key",
    "H1 H2",
    f"{tx_sql()}\nSELECT TransactionID, {CLIENT_SQL} AS client_uid FROM tx",
)
def client_key_query(spark, folder):
    return transactions(spark, folder).select(ID, client_key().alias(CLIENT))


@query(
    "a12_boolean_text",
    "A12 H9",
    """SELECT l_linestatus, l_returnflag, CASE WHEN l_returnflag = 'R' THEN NULL
  ELSE lower(CASE l_linestatus WHEN 'O' THEN 'T' ELSE 'FALSE' END) IN ('t') END AS parsed, count(*) AS n
FROM lineitem GROUP BY ALL""",
)
def boolean_text(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "text",
        F.expr("CASE WHEN l_returnflag = 'R' THEN 'N' WHEN l_linestatus = 'O' THEN 'T' ELSE 'FALSE' END"),
    )
    return (
        lines.select("l_linestatus", "l_returnflag", boolean_from_text("text").alias("parsed"))
        .groupBy("l_linestatus", "l_returnflag", "parsed")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "h11_probability_of_label",
    "H11",
    f"{scored_sql()}\nSELECT TransactionID, probability AS y_score FROM sc",
)
def probability_of_label(spark, folder):
    rows = scored(spark, folder)
    pairs = F.array(
        F.struct(F.lit(0).alias("label"), (F.lit(1.0) - F.col("probability")).alias("prob")),
        F.struct(F.lit(1).alias("label"), F.col("probability").alias("prob")),
    )
    return rows.select(ID, positive_probability(pairs).alias("y_score"))


@query(
    "b04_contract_projection",
    "B4",
    f"""{tx_sql()}
SELECT TransactionID, isFraud, TransactionAmt, CAST(TransactionDT // 86400 - D15 AS DOUBLE) AS D15n,
  ProductCD, C3 FROM tx""",
)
def contract_projection(spark, folder):
    frame = apply_derivations(
        transactions(spark, folder), [Derivation("D15n", "days_since_to_start_day", ("D15",))]
    )
    return contract_view(frame, ["D15n", "ProductCD", "C3"], carry=[ID, LABEL, "TransactionAmt"])


@query(
    "d30_shape_report",
    "D30 A20",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {t}) AS \"rows\", "
        f"(SELECT CAST(count(*) AS INT) FROM (DESCRIBE {t})) AS \"columns\""
        for t in ("orders", "lineitem", "events", "documents", "pages")
    ),
)
def shape_report(spark, folder):
    names = ("orders", "lineitem", "events", "documents", "pages")
    first, *rest = [shape_of(table(spark, folder, n), n) for n in names]
    for other in rest:
        first = first.unionByName(other)
    return first


@query(
    "g02_customers_without_orders",
    "G2",
    "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
)
def customers_without_orders(spark, folder):
    finished = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    return names_missing_from(
        table(spark, folder, "customer"),
        finished.select(F.col("o_custkey").alias("c_custkey")),
        "c_custkey",
    )


@query(
    "g03_documents_labelled_in_both",
    "G3",
    "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels",
)
def documents_labelled(spark, folder):
    return names_in_both(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@query(
    "h15_column_profile",
    "H15 L1",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS dtype, count({c}) AS present, count(*) - count({c}) AS missing"
        f" FROM tx"
        for c, k in {
            "TransactionID": "int", "TransactionAmt": "float", "ProductCD": "str", "M1": "bool",
            "D15": "float", "DeviceInfo": "str", "addr1": "int",
        }.items()
    ).join([tx_sql() + "\n", ""]),
)
def column_profile(spark, folder):
    names = [ID, "TransactionAmt", "ProductCD", "M1", "D15", "DeviceInfo", "addr1"]
    rows = transactions(spark, folder).select(*names)
    kinds = column_kinds(rows)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(c).isNull().alias("_m")
            )
            for c in names
        ]
    )
    return (
        rows.select(F.inline(cells))
        .groupBy("column", "dtype")
        .agg(F.count_if(~F.col("_m")).alias("present"), F.count_if("_m").alias("missing"))
    )
