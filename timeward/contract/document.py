"""The contract as a JSON document: written once, committed, checked on every load."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from timeward.contract.tables import ContractError, fingerprint, map_lines, summary
from timeward.policy import Policy

_COLUMNS = (
    "position int, column string, source string, dtype string, admitted boolean,"
    " rejected_by string, rejected_value double, rejected_unit string, admitted_by string,"
    " override_reason string, override_expires string"
)


def to_document(
    contract: DataFrame,
    policy: Policy,
    *,
    fragments: Sequence[dict] = (),
    maps: DataFrame | None = None,
) -> dict:
    """One entry per column, policy line and fitted map comes to the driver, nothing per row."""
    rows = contract.orderBy("position").collect()
    fitted = [r["line"] for r in map_lines(maps).orderBy("line").collect()] if maps is not None else []
    return {
        "columns": [r.asDict() for r in rows],
        "created_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "fingerprint": fingerprint(contract, [*policy.lines(), *fitted]).first()["fingerprint"],
        "fragments": list(fragments),
        "maps": fitted,
        "policy": policy.lines(),
        "summary": summary(contract).first().asDict(),
        "version": policy.version,
    }


def from_document(spark: SparkSession, document: dict) -> DataFrame:
    """The contract table; raises if columns, policy or maps are not those that were stamped."""
    contract = _table(spark, document)
    if document.get("fingerprint") and not intact(spark, document):
        raise ContractError(f"the document was edited after it got fingerprint {document['fingerprint']}")
    return contract


def intact(spark: SparkSession, document: dict) -> bool:
    """Does the document still have the contents that its fingerprint was made from?"""
    lines = [*document.get("policy", ()), *document.get("maps", ())]
    return fingerprint(_table(spark, document), lines).first()["fingerprint"] == document.get("fingerprint")


def _table(spark: SparkSession, document: dict) -> DataFrame:
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(c[n] for n in names) for c in document["columns"]], _COLUMNS)
