"""Cells of wide rows are counted in batches, by tasks that hold a fixed number of rows."""

import math
from collections import Counter

import pytest

from tests.conftest import SMALL
from timeward.plans import audits
from timeward.registry import adapters

SCHEMA = "TransactionID long, TransactionDT long, isFraud int, ProductCD string, a double, b double"


def _rows():
    odd = [0.0, -0.0, math.nan, None, 1.5, math.inf]
    return [(i, i % 100, None if i % 31 == 0 else i % 3 % 2, "xyz"[i % 3] if i % 7 else None, odd[i % 6], float(i % 5)) for i in range(900)]


def _plain(rows, window):
    out = Counter()
    for r in rows:
        share = r[1] / 99
        name = "train" if share <= 0.17 else "holdout" if share >= 0.83 else None
        if window and name is None:
            continue
        for column, v in zip("ab", r[4:]):
            if v is not None:
                key = (column, "nan" if math.isnan(v) else v + 0.0)
                out[key + ((name, None) if window else (None, r[3])) + (r[2] or 0,)] += 1
    return out


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_store_equals_plain_counts(spark, batch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        docs = spark.createDataFrame(_rows(), SCHEMA)
        for asked in ({"train": (0.0, 0.17), "holdout": (0.83, 1.0)}, {"segment": "ProductCD"}):
            found = audits.counted_cells(docs, ["a", "b"], **asked).collect()
            got = {(r["column"], "nan" if math.isnan(r["value"]) else r["value"], r["window"], r["segment"], r["label"]): r["n"] for r in found}
            assert len(got) == len(found)
            assert got == _plain(_rows(), "train" in asked)
        levels = {r["column"]: r["levels"] for r in audits.distinct_values(docs, ["a", "b"]).collect()}
        assert levels == {"a": 4, "b": 5}
        assert audits.counted_cells(docs.limit(0), ["a", "b"], train=(0.0, 0.2), holdout=(0.8, 1.0)).count() == 0
    finally:
        spark.conf.set(name, before)


def test_wide_rows_are_spread_however_the_file_lies(spark, monkeypatch):
    monkeypatch.setattr(adapters, "_WIDE_ROWS", 100, raising=False)
    rows = adapters.wide_transactions(spark, SMALL, "orders")
    assert rows.rdd.getNumPartitions() >= rows.count() / 100
