"""Audits, the contract they lead to, and the promotion gate.

The contract queries run on verdicts that the audits compute from the whole tables.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from timeward.contract.document import from_document, intact, to_document
from timeward.contract.tables import (
    PRECEDENCE,
    admitted,
    blacklist_rejections,
    build_contract,
    catalog,
    declared_columns,
    fingerprint,
    freshness,
    integrity,
    lineage,
    map_digest,
    map_lines,
    model_problems,
    overridden,
    override_rows,
    read_fragments,
    rejected,
    rejections_of,
    schema_rows,
    summary,
    undeclared,
)
from timeward.functions.derive import Derivation, apply_derivations, frequency_map
from timeward.functions.scalars import short_digest
from timeward.names import AMOUNT, ID, LABEL, PRODUCT, TIME, V_COLUMNS
from timeward.operators.metrics import (
    budget_threshold_row,
    calibration_error,
    curve_at,
    dominant_segment,
    product_segments,
    ranking_metrics,
    reliability,
    score_curve,
    seen_segments,
)
from timeward.plans.audits import (
    counted_cells,
    distribution_shift,
    distribution_shift_of,
    distinct_values,
    missing_families,
    redundancy,
    segment_qualification,
    shift_rejections,
    time_consistency,
    time_consistency_of,
    time_rejections,
    to_fragments,
)
from timeward.plans.gate import (
    gate_checks,
    latest_run,
    promoted_run,
    promotion_record,
    score_floor,
    verdict,
)
from timeward.policy import ADMIT, REJECT, Policy, Ruling
from timeward.registry import query, steady, steady_sql
from timeward.registry.adapters import (
    scored,
    scored_sql,
    table,
    transactions,
    tx_sql,
    wide_sql,
    wide_transactions,
)
from timeward.registry.evaluation import _AP, _SEGMENTS, curve_cte
from timeward.session import materialize, scratch_path
from timeward.sources.sinks import append_log

P = "probability"
# Every number that a model may read.
AUDITED = ["TransactionAmt", *(f"C{i}" for i in range(1, 15)), *(f"D{i}" for i in (1, 2, 3, 5, 10, 11, 15)), "card1", "addr1", *V_COLUMNS]
_WINDOWS = {"train": (0.0, 0.17), "holdout": (0.83, 1.0)}
_MARGIN = 0.004


def _orders(spark, folder):
    return wide_transactions(spark, folder, "orders").select(ID, TIME, LABEL, PRODUCT, *AUDITED)


# ---- audits ----------------------------------------------------------------------------------

_CELLS = f"""{wide_sql('orders')},
axis AS (SELECT min(TransactionDT) AS lo, max(TransactionDT) AS hi FROM tx),
placed AS (SELECT tx.*, (TransactionDT - lo) / (hi - lo)::DOUBLE AS share FROM tx CROSS JOIN axis),
win AS (SELECT *, CASE WHEN share >= 0.0::DOUBLE AND share <= 0.17::DOUBLE THEN 'train'
  WHEN share >= 0.83::DOUBLE AND share <= 1.0::DOUBLE THEN 'holdout' END AS win FROM placed),
cells AS MATERIALIZED (
  SELECT * FROM (SELECT win, isFraud, ProductCD, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in AUDITED)} FROM win WHERE win IS NOT NULL)
  UNPIVOT (v FOR col IN ({', '.join(AUDITED)})))"""


def _auc_cte(name: str, keys: str, where: str) -> str:
    return f"""{name}_g AS (SELECT {keys}, v, count(*) FILTER (isFraud = 1) AS p, count(*) FILTER (isFraud = 0) AS n
  FROM cells WHERE {where} GROUP BY {keys}, v),
{name} AS (SELECT {keys}, sum(n * (cp - p / 2.0::DOUBLE)) / nullif(sum(p) * sum(n), 0) AS auc, CAST(sum(p) + sum(n) AS BIGINT) AS rws
  FROM (SELECT *, sum(p) OVER (PARTITION BY {keys} ORDER BY v DESC) AS cp FROM {name}_g) GROUP BY {keys})"""


_TIME = f"""{_CELLS},
{_auc_cte('wa', 'col, win', 'win IS NOT NULL')},
tc0 AS (SELECT col, max(auc) FILTER (win = 'train') AS a, max(auc) FILTER (win = 'holdout') AS b FROM wa GROUP BY col),
tc AS (SELECT *, sign(a - 0.5) * (b - a) AS delta,
  coalesce((a - 0.5) * (b - 0.5) < 0 AND abs(a - 0.5) > {_MARGIN} AND abs(b - 0.5) > {_MARGIN}, false) AS inverted FROM tc0)"""

_SHIFT = f"""ed AS (SELECT col, list_sort(list_distinct(quantile_cont(v, list_transform(range(11), lambda i: i / 10.0::DOUBLE)))) AS e
  FROM cells WHERE win = 'train' GROUP BY col),
bn AS (SELECT c.col, len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: x < v)) AS bin, any_value(len(e)) AS ne,
  count(*) FILTER (win = 'train') AS early, count(*) FILTER (win = 'holdout') AS late
  FROM cells c JOIN ed ON ed.col = c.col WHERE win IS NOT NULL GROUP BY ALL),
pq AS (SELECT *, greatest(early / sum(early) OVER (PARTITION BY col)::DOUBLE, 1e-6::DOUBLE) AS p,
  greatest(late / sum(late) OVER (PARTITION BY col)::DOUBLE, 1e-6::DOUBLE) AS q FROM bn),
sh AS (SELECT col, CASE WHEN max(ne) > 1 THEN sum((q - p) * ln(q / p)) END AS psi, max(ne) <= 1 AS degenerate FROM pq GROUP BY col)"""


@query(
    "n01_time_consistency",
    "N1",
    f"""{_TIME}
SELECT col AS "column", {steady_sql('a', 6)} AS auc_train, {steady_sql('b', 6)} AS auc_holdout,
  {steady_sql('delta', 6)} AS delta, inverted FROM tc""",
)
def time_consistency_query(spark, folder):
    found = time_consistency(_orders(spark, folder), AUDITED, margin=_MARGIN)
    return found.withColumns({c: steady(F.col(c), 6) for c in ("auc_train", "auc_holdout", "delta")})


@query(
    "n02_distribution_shift",
    "N2",
    f"""{_CELLS}, {_SHIFT}
SELECT col AS "column", {steady_sql('psi', 6)} AS psi, degenerate FROM sh""",
)
def distribution_shift_query(spark, folder):
    found = distribution_shift(_orders(spark, folder), AUDITED)
    return found.withColumn("psi", steady(F.col("psi"), 6))


_BLOCK = list(V_COLUMNS)
_PATTERNS = f"""{wide_sql()},
cells AS MATERIALIZED (
  SELECT * FROM (SELECT TransactionID AS id, {', '.join(_BLOCK)} FROM tx) UNPIVOT INCLUDE NULLS (v FOR col IN ({', '.join(_BLOCK)}))),
pt AS (SELECT col, string_agg(CASE WHEN v IS NULL THEN '1' ELSE '0' END, '' ORDER BY id) AS s, count(DISTINCT v) AS levels
  FROM cells GROUP BY col),
fam AS (SELECT col, min(col) OVER (PARTITION BY s) AS family, levels FROM pt)"""


@query(
    "n03_missing_families",
    "N3 L14",
    f'{_PATTERNS}\nSELECT col AS "column", family FROM fam',
)
def missing_families_query(spark, folder):
    rows = wide_transactions(spark, folder).select(ID, *_BLOCK)
    return missing_families(rows, _BLOCK)


@query(
    "n03_redundancy",
    "N3",
    f"""{_PATTERNS},
rp AS (SELECT *, first_value(col) OVER (PARTITION BY family ORDER BY levels DESC, col) AS rep FROM fam),
cr AS (SELECT rp.col, corr(a.v, b.v) AS c FROM rp JOIN cells a ON a.col = rp.col JOIN cells b ON b.col = rp.rep AND a.id = b.id
  WHERE rp.col <> rp.rep AND a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY rp.col)
SELECT family, rp.col AS "column", rep AS representative, {steady_sql('c', 6)} AS correlation,
  coalesce(abs(c) >= 0.5::DOUBLE, false) AS redundant FROM rp LEFT JOIN cr ON rp.col = cr.col""",
)
def redundancy_query(spark, folder):
    rows = materialize(wide_transactions(spark, folder).select(ID, *_BLOCK), "wide")
    groups: dict[str, list[str]] = {}
    # One row per column of the block.
    for r in missing_families(rows, _BLOCK).collect():
        groups.setdefault(r["family"], []).append(r["column"])
    found = redundancy(rows, groups, least=0.5)
    return found.withColumn("correlation", steady(F.col("correlation"), 6))


@query(
    "n03_distinct_values",
    "N3",
    f"{_PATTERNS}\nSELECT col AS \"column\", levels FROM fam",
)
def distinct_values_query(spark, folder):
    return distinct_values(wide_transactions(spark, folder), _BLOCK)


# The score separates well, so pooled power is high; the others stay near chance.
_SEG_CELLS = f"""{scored_sql('orders')},
cells AS (SELECT 'score' AS col, CAST(score AS DOUBLE) AS v, isFraud, ProductCD FROM sc
  UNION ALL SELECT 'TransactionAmt', TransactionAmt, isFraud, ProductCD FROM sc
  UNION ALL SELECT 'mixed', CASE WHEN ProductCD = 'F' THEN score::DOUBLE ELSE card1 % 7 END, isFraud, ProductCD FROM sc)"""


@query(
    "n04_segment_qualification",
    "N4",
    f"""{_SEG_CELLS},
{_auc_cte('pl', 'col', 'true')},
{_auc_cte('sg', 'col, ProductCD', 'ProductCD IS NOT NULL')}
SELECT sg.col AS "column", ProductCD AS segment, sg.rws AS "rows", {steady_sql('greatest(pl.auc, 1 - pl.auc)', 6)} AS pooled,
  {steady_sql('greatest(sg.auc, 1 - sg.auc)', 6)} AS within,
  coalesce(greatest(pl.auc, 1 - pl.auc) >= 0.6::DOUBLE AND greatest(pl.auc, 1 - pl.auc) - greatest(sg.auc, 1 - sg.auc) > 0.08::DOUBLE, false) AS hollow
FROM sg JOIN pl ON sg.col = pl.col""",
)
def segment_qualification_query(spark, folder):
    rows = scored(spark, folder, "orders").withColumn(
        "mixed", F.expr("CASE WHEN ProductCD = 'F' THEN cast(score AS double) ELSE card1 % 7 END")
    )
    found = segment_qualification(rows, ["score", "TransactionAmt", "mixed"])
    return found.withColumns({c: steady(F.col(c), 6) for c in ("pooled", "within")})


# ---- the contract ----------------------------------------------------------------------------

_POLICY = Policy(
    derivations=(Derivation("D3n", "days_since_to_start_day", ("D3",)),),
    rulings=(
        Ruling("D11", REJECT, "counter is being retired"),
        Ruling("D2", ADMIT, "a start day is meant to move", date(2999, 12, 31)),
    ),
)
_DERIVED = ["D3n"]
_RETRIEVED = ["C1", "C2", "C5"]
_THRESHOLD = 0.5
_DECLARED_COLUMNS = [PRODUCT, *AUDITED, "D3n"]
_KINDS = {"ProductCD": "str", "TransactionAmt": "float", "D15": "float", "D3n": "float", **dict.fromkeys(V_COLUMNS, "float")}


def _declared_values() -> str:
    rows = []
    for i, c in enumerate(_DECLARED_COLUMNS):
        source = "derived" if c in _DERIVED else "retrieved" if c in _RETRIEVED else "request"
        rows.append(f"({i}, '{c}', '{source}', '{_KINDS.get(c, 'int')}')")
    return ", ".join(rows)


# The audits give the verdicts; the declaration itself is schema, hence literal on this side.
_CONTRACT = f"""{_TIME}, {_SHIFT},
dc AS (SELECT * FROM (VALUES {_declared_values()}) t(position, col, source, dtype)),
rj AS (SELECT 0 AS pr, 'time_consistency' AS chk, col, delta AS val FROM tc WHERE inverted
  UNION ALL SELECT 1, 'distribution_shift', col, psi FROM sh WHERE psi > {_THRESHOLD}
  UNION ALL SELECT 4, 'admission_rules', 'D11', NULL),
fr AS (SELECT * FROM rj QUALIFY row_number() OVER (PARTITION BY col ORDER BY pr) = 1),
ct AS (SELECT position, dc.col AS "column", source, dtype, fr.col IS NULL OR dc.col = 'D2' AS admitted,
  coalesce(chk, '') AS rejected_by, val AS rejected_value, CASE WHEN fr.col IS NULL THEN '' ELSE 'column' END AS rejected_unit,
  CASE WHEN fr.col IS NOT NULL AND dc.col = 'D2' THEN 'override' ELSE '' END AS admitted_by,
  CASE WHEN fr.col IS NOT NULL AND dc.col = 'D2' THEN 'a start day is meant to move' ELSE '' END AS override_reason,
  CASE WHEN fr.col IS NOT NULL AND dc.col = 'D2' THEN '2999-12-31' ELSE '' END AS override_expires
  FROM dc LEFT JOIN fr ON fr.col = dc.col)"""


# Verdicts by application and folder: a dozen queries ask for the same ones.
_JUDGED: dict = {}


def _verdicts(spark, folder):
    key = (spark.sparkContext.applicationId, folder)
    if key not in _JUDGED:
        _JUDGED[key] = _judged(spark, folder)
    return _JUDGED[key]


def _judged(spark, folder):
    rows = _orders(spark, folder)
    # One store for both audits.
    store = counted_cells(rows, AUDITED, **_WINDOWS)
    found = time_rejections(time_consistency_of(store, margin=_MARGIN)).unionByName(
        shift_rejections(distribution_shift_of(store), threshold=_THRESHOLD)
    )
    # A few rows per audit; written once because several checks read them.
    return materialize(found, "verdicts")


def _contract(spark, folder):
    rows = apply_derivations(_orders(spark, folder), _POLICY.derivations)
    declared = declared_columns(schema_rows(spark, rows.schema), retrieved=_RETRIEVED, derived=_DERIVED)
    rejections = _verdicts(spark, folder).unionByName(blacklist_rejections(spark, _POLICY))
    return build_contract(declared, rejections, override_rows(spark, _POLICY))


_SHOWN = f"""SELECT position, "column", source, dtype, admitted, rejected_by, {steady_sql('rejected_value', 6)} AS rejected_value,
  rejected_unit, admitted_by, override_reason, override_expires FROM ct"""


def _shown(contract):
    return contract.withColumn("rejected_value", steady(F.col("rejected_value"), 6))


query("l04_contract_merge", "L1 L3 L4 L11 L14 C11", f"{_CONTRACT}\n{_SHOWN}")(
    lambda spark, folder: _shown(_contract(spark, folder))
)
query("l05_training_features", "L5", f"{_CONTRACT}\n{_SHOWN} WHERE admitted")(
    lambda spark, folder: _shown(admitted(_contract(spark, folder)))
)
query(
    "l05_request_fields", "L5", f"{_CONTRACT}\n{_SHOWN} WHERE admitted AND source = 'request'"
)(lambda spark, folder: _shown(admitted(_contract(spark, folder), "request")))
query(
    "l05_retrieved_fields", "L5", f"{_CONTRACT}\n{_SHOWN} WHERE admitted AND source = 'retrieved'"
)(lambda spark, folder: _shown(admitted(_contract(spark, folder), "retrieved")))
query("l05_rejections", "L5", f"{_CONTRACT}\n{_SHOWN} WHERE NOT admitted")(
    lambda spark, folder: _shown(rejected(_contract(spark, folder)))
)
query("l05_overrides", "L5", f"{_CONTRACT}\n{_SHOWN} WHERE admitted_by = 'override'")(
    lambda spark, folder: _shown(overridden(_contract(spark, folder)))
)


@query(
    "d29_contract_summary",
    "D29",
    f"""{_CONTRACT}
SELECT count(*) AS declared, count(*) FILTER (admitted) AS admitted, count(*) FILTER (NOT admitted) AS rejected,
  count(*) FILTER (admitted_by = 'override') AS overridden,
  count(*) FILTER (admitted AND source = 'request') AS request_fields,
  count(*) FILTER (admitted AND source = 'retrieved') AS retrieved_fields FROM ct""",
)
def contract_summary(spark, folder):
    return summary(_contract(spark, folder))


_FITTED = ["addr1", "P_emaildomain", "DeviceInfo"]


def _map_digest_sql() -> str:
    """Expects tx."""
    each = " UNION ALL ".join(f"SELECT '{c}' AS col, {c}::VARCHAR AS val FROM tx" for c in _FITTED)
    return f"""SELECT col, count(*) AS levels,
  sum(CAST('0x' || substr(sha256(col || '|' || val || '|' || cnt::VARCHAR), 1, 15) AS BIGINT))::VARCHAR AS digest
FROM (SELECT col, val, count(*) AS cnt FROM ({each}) WHERE val IS NOT NULL GROUP BY ALL HAVING count(*) >= 2) GROUP BY col"""


def _policy_lines_sql() -> str:
    quoted = (line.replace("'", "''") for line in _POLICY.lines())
    return ", ".join(f"('{line}')" for line in quoted)


@query(
    "l06_fingerprint",
    "L6 H12",
    f"""{_CONTRACT}, fitted AS ({_map_digest_sql()}), parts AS (
  SELECT 'column|' || lpad(position::VARCHAR, 6, '0') || '|' || "column" || '|' || source || '|' || dtype AS line FROM ct WHERE admitted
  UNION ALL SELECT 'map|' || col || '|' || levels || '|' || digest FROM fitted
  UNION ALL SELECT * FROM (VALUES {_policy_lines_sql()})
)
SELECT substring(sha256(string_agg(line, chr(10) ORDER BY line)), 1, 16) AS fingerprint FROM parts""",
)
def fingerprint_query(spark, folder):
    maps = frequency_map(transactions(spark, folder, "orders"), _FITTED)
    lines = [r["line"] for r in map_lines(maps).collect()]
    return fingerprint(_contract(spark, folder), [*_POLICY.lines(), *lines])


@query(
    "h12_document_digests",
    "H12",
    "SELECT doc_id, substring(sha256(text), 1, 16) AS digest FROM documents",
)
def document_digests(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", short_digest(F.col("text")).alias("digest"))


@query("l06_fitted_map_digest", "L6 D6", f"""{tx_sql()} {_map_digest_sql().replace("SELECT col, count(*) AS levels", 'SELECT col AS "column", count(*) AS levels', 1)}""")
def fitted_map_digest(spark, folder):
    return map_digest(frequency_map(transactions(spark, folder), _FITTED))


@query(
    "l07_document_round_trip",
    "L7 H13",
    f"{_CONTRACT}\n{_SHOWN}",
)
def document_round_trip(spark, folder):
    text = json.dumps(to_document(_contract(spark, folder), _POLICY))
    return _shown(from_document(spark, json.loads(text)))


@query(
    "l02_fragments_round_trip",
    "L2 H13",
    f"""{_CONTRACT}
SELECT pr AS precedence, chk AS "check", 'timeward' AS tool, col AS "column", {steady_sql('val', 6)} AS "value", 'column' AS unit
FROM rj WHERE pr < 4""",
)
def fragments_round_trip(spark, folder):
    """Verdicts written as JSON fragments, read back and flattened."""
    path = scratch_path(spark, "fragments")
    to_fragments(_verdicts(spark, folder), PRECEDENCE).write.json(path)
    lines = spark.read.text(path)
    # One file per fragment, as separate audits would leave them: a handful of rows.
    out = scratch_path(spark, "fragments-split")
    lines.repartition(len(PRECEDENCE), "value").write.option("maxRecordsPerFile", 1).text(out)
    found = rejections_of(read_fragments(spark, out))
    return found.withColumn("value", steady(F.col("value"), 6))


@query(
    "l08_freshness_by_load_day",
    "L8 H14",
    f"""SELECT event_id, {steady_sql("epoch(TIMESTAMP '2024-02-10 00:00:00' - date_trunc('second', ts)) / 86400.0::DOUBLE", 6)} AS age_days,
  epoch(TIMESTAMP '2024-02-10 00:00:00' - date_trunc('second', ts)) / 86400.0::DOUBLE <= 30 AS fresh FROM events""",
)
def freshness_by_load_day(spark, folder):
    """Each event read as the moment a contract was stamped."""
    age, fresh = freshness(
        F.col("ts").cast("timestamp"), F.lit("2024-02-10 00:00:00").cast("timestamp"), 30
    )
    return table(spark, folder, "events").select(
        "event_id", steady(age, 6).alias("age_days"), fresh.alias("fresh")
    )


@query(
    "l09_integrity",
    "L9 L7",
    f"""{_CONTRACT}, counted AS (SELECT count(*) FILTER (admitted) AS admitted FROM ct)
SELECT state, admitted, admitted >= 5 AS enough, state = 'as stored' AS intact FROM counted,
  (VALUES ('as stored'), ('column edited'), ('policy edited')) AS v(state)""",
)
def integrity_query(spark, folder):
    contract = materialize(_contract(spark, folder), "contract")
    stored = to_document(contract, _POLICY)
    first = {**stored["columns"][0], "dtype": "edited", "admitted": True}
    states = {
        "as stored": stored,
        "column edited": {**stored, "columns": [first, *stored["columns"][1:]]},
        "policy edited": {**stored, "policy": stored["policy"][1:]},
    }
    found = None
    for state, document in states.items():
        row = integrity(contract, 5, intact(spark, document)).withColumn("state", F.lit(state))
        found = row if found is None else found.unionByName(row)
    return found


_USED = ["TransactionAmt", "C1", "D11", "V999"]


@query(
    "l10_model_against_contract",
    "L10 G2 B14",
    f"""{_CONTRACT},
us AS (SELECT unnest({_USED!r}) AS c)
SELECT us.c AS "column", 'in the model, not in the contract' AS problem, coalesce(x.rejected_by, 'not declared') AS rejected_by
FROM us LEFT JOIN ct x ON x."column" = us.c WHERE us.c NOT IN (SELECT "column" FROM ct WHERE admitted)
UNION ALL SELECT "column", 'admitted but unused', '' FROM ct WHERE admitted AND "column" NOT IN (SELECT c FROM us)""",
)
def model_against_contract(spark, folder):
    contract = materialize(_contract(spark, folder), "contract")
    used = contract.limit(1).select(F.explode(F.array(*[F.lit(c) for c in _USED])).alias("column"))
    return model_problems(contract, used)


@query(
    "g02_rejections_not_declared",
    "G2 L4",
    f"{_CONTRACT}\nSELECT col AS \"column\" FROM rj EXCEPT SELECT col FROM dc WHERE position > 5",
)
def rejections_not_declared(spark, folder):
    """Against a declaration that lost its first columns."""
    rows = apply_derivations(_orders(spark, folder), _POLICY.derivations)
    declared = declared_columns(schema_rows(spark, rows.schema)).where(F.col("position") > 5)
    rejections = _verdicts(spark, folder).unionByName(blacklist_rejections(spark, _POLICY))
    return undeclared(rejections, declared)


@query(
    "l12_catalog",
    "L12",
    f"""{_CONTRACT}
SELECT "column", dtype, CASE WHEN admitted_by = 'override' THEN concat('admitted by override of ', rejected_by)
  WHEN admitted THEN concat('admitted, ', source) ELSE concat('rejected by ', rejected_by) END AS status FROM ct""",
)
def catalog_query(spark, folder):
    return catalog(_contract(spark, folder))


@query(
    "l12_lineage",
    "L12",
    f"""{_CONTRACT}
SELECT "column", CASE "column" WHEN 'D3n' THEN 'D3' ELSE "column" END AS "input" FROM ct WHERE admitted""",
)
def lineage_query(spark, folder):
    return lineage(_contract(spark, folder), {d.name: d.inputs for d in _POLICY.derivations})


# ---- the gate --------------------------------------------------------------------------------

_GATE_METRICS = f"""{scored_sql('orders')}, {curve_cte()},
pick AS (SELECT min(probability) FILTER (cum_neg / all_neg::DOUBLE <= 0.01::DOUBLE) AS t FROM cv),
apx AS (SELECT {_AP} AS ap FROM cv),
un AS (SELECT * FROM sc WHERE card1 % 3 <> 0),
{curve_cte(rows='un').replace('g AS (', 'ug AS (', 1).replace('FROM g ', 'FROM ug ', 1).replace('cv AS (', 'uv AS (', 1)},
uap AS (SELECT {_AP} AS ap FROM uv),
relb AS (SELECT least(floor(probability * 10), 9) AS bin, avg(probability) AS mp, avg(isFraud) AS obs, count(*) AS n FROM sc GROUP BY 1),
ece AS (SELECT sum(n * abs(mp - obs)) / sum(n) AS e FROM relb),
fpr AS (SELECT count(*) FILTER (isFraud = 0 AND probability >= t) / count(*) FILTER (isFraud = 0)::DOUBLE AS f FROM sc CROSS JOIN pick),
{_SEGMENTS.replace('g AS (SELECT ProductCD', 'sg AS (SELECT ProductCD', 1).replace('FROM g ', 'FROM sg ', 1).replace('cv AS (', 'sv AS (', 1).replace('FROM cv GROUP BY ProductCD', 'FROM sv GROUP BY ProductCD', 1)},
dom AS (SELECT * FROM (SELECT *, n / sum(n) OVER ()::DOUBLE AS share FROM seg) WHERE share >= 0.3 ORDER BY n DESC, product LIMIT 1),
ck AS (SELECT 'pr_auc_above_baseline' AS c, ap >= 0.0635::DOUBLE * 1.10::DOUBLE AS ok, ap AS obs, 0.0635::DOUBLE * 1.10::DOUBLE AS req FROM apx
 UNION ALL SELECT 'no_cold_entity_regression', ap >= 0.0635::DOUBLE, ap, 0.0635::DOUBLE FROM uap
 UNION ALL SELECT 'calibration_sane', e <= 0.02::DOUBLE, e, 0.02::DOUBLE FROM ece
 UNION ALL SELECT 'threshold_survives_out_of_sample', f <= 0.01::DOUBLE * 1.25::DOUBLE, f, 0.01::DOUBLE * 1.25::DOUBLE FROM fpr
 UNION ALL SELECT 'dominant_segment_not_regressed', coalesce(max(pr_auc / positive_rate) >= 5.0::DOUBLE, false), max(pr_auc / positive_rate), 5.0::DOUBLE FROM dom)"""


def _gate_inputs(spark, folder):
    rows = scored(spark, folder, "orders").withColumn("seen_in_train", F.col("card1") % 3 == 0)
    curve = score_curve(rows, P, amount=AMOUNT)
    at = curve_at(curve, budget_threshold_row(curve, P), P)
    wide = (
        ranking_metrics(rows, P)
        .select(F.col("pr_auc").alias("test_pr_auc"))
        .crossJoin(
            seen_segments(rows, P)
            .where("segment = 'unseen'")
            .agg(F.max("pr_auc").alias("test_pr_auc_unseen"))
        )
        .crossJoin(
            calibration_error(reliability(rows, P)).withColumnRenamed(
                "expected_calibration_error", "test_expected_calibration_error"
            )
        )
        .crossJoin(
            at.select(
                "threshold",
                F.col("false_positive_rate").alias("test_threshold_false_positive_rate"),
            )
        )
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in wide.columns]
    )
    metrics = materialize(wide.select(F.inline(pairs)), "gate-metrics")
    return metrics, dominant_segment(product_segments(rows, P), share=0.3)


@query(
    "m01_gate_checks",
    "M1 M2 M3 M4 M5",
    f"""{_GATE_METRICS}
SELECT c AS "check", ok AS passed, {steady_sql('obs', 6)} AS observed, {steady_sql('req', 6)} AS required FROM ck""",
)
def gate_checks_query(spark, folder):
    checks = gate_checks(*_gate_inputs(spark, folder))
    return checks.withColumns({c: steady(F.col(c), 6) for c in ("observed", "required")})


@query(
    "m07_verdict",
    "M7",
    f"""{_GATE_METRICS}
SELECT bool_and(ok) AS promoted, coalesce(string_agg(c, ', ' ORDER BY c) FILTER (NOT ok), '') AS failed FROM ck""",
)
def verdict_query(spark, folder):
    return verdict(gate_checks(*_gate_inputs(spark, folder)))


@query(
    "m06_score_floor",
    "M6 H17",
    f"""{_GATE_METRICS}
SELECT {steady_sql('ap', 6)} AS test_pr_auc, ap >= 0.50::DOUBLE AS passed, round(ap - 0.5237::DOUBLE, 4) AS delta_to_reference FROM apx""",
)
def score_floor_query(spark, folder):
    found = score_floor(_gate_inputs(spark, folder)[0])
    return found.withColumn("test_pr_auc", steady(F.col("test_pr_auc"), 6))


@query(
    "m08_promotion_record",
    "M8 A15",
    f"""{_GATE_METRICS}
SELECT 'run-2' AS run, {steady_sql('ap', 6)} AS pr_auc, t AS threshold, 'platt' AS calibrator, 'abc' AS code_version,
  'f00d' AS fingerprint FROM apx CROSS JOIN pick""",
)
def promotion_record_query(spark, folder):
    metrics, _ = _gate_inputs(spark, folder)
    path = scratch_path(spark, "promotions")
    append_log(
        promotion_record(metrics, run="run-2", calibrator="platt", code_version="abc", fingerprint="f00d"),
        path,
    )
    kept = spark.read.parquet(path).drop("promoted_at")
    return kept.withColumn("pr_auc", steady(F.col("pr_auc"), 6))


@query(
    "m09_promoted_is_newest",
    "M9 F5",
    """WITH pr AS (SELECT max_by(o_orderkey, (o_orderdate, o_orderkey)) AS promoted FROM orders WHERE o_orderpriority = '1-URGENT'),
nw AS (SELECT max_by(o_orderkey, (o_orderdate, o_orderkey)) AS newest FROM orders)
SELECT promoted, newest, promoted = newest AS "current" FROM pr CROSS JOIN nw""",
)
def promoted_is_newest(spark, folder):
    """Orders as runs: urgent ones were promoted. Compares the latest of each."""
    orders = table(spark, folder, "orders")
    runs = orders.select(F.col("o_orderkey").alias("run"), F.col("o_orderdate").alias("updated_at"))
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    promotions = urgent.select(
        F.col("o_orderkey").alias("run"),
        F.struct("o_orderdate", "o_orderkey").alias("promoted_at"),
    )
    return promoted_run(promotions, runs)


@query(
    "f05_latest_order_per_table",
    "F5",
    """SELECT max_by(o_orderkey, (o_orderdate, o_orderkey)) AS run FROM orders""",
)
def latest_order(spark, folder):
    orders = table(spark, folder, "orders")
    return latest_run(orders, run="o_orderkey", updated="o_orderdate")
