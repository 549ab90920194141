"""Fitted models go to tasks without the session they were fitted in, whatever was done in it before."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare
from timeward.operators.calibration import fit_calibrator
from timeward.plans.models import fit_baseline, score_baseline


@pytest.fixture(scope="module")
def observed(spark):
    seen = Observation("seen")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    return spark


def _rows(spark):
    return spark.range(400).select(
        F.col("id").alias("TransactionID"), (F.col("id") % 37).cast("double").alias("s"), (F.col("id") % 5 == 0).cast("long").alias("isFraud")
    )


def test_logistic_fits_apply_after_an_observation(observed):
    rows = _rows(observed)
    platt = fit_calibrator(rows, "s", "platt")
    assert not platt.model.hasSummary
    assert platt.apply(rows, "s", "q").agg(F.avg("q")).first()[0] == pytest.approx(0.2, abs=1e-3)
    scored = score_baseline(fit_baseline(rows, ["s"]), rows, ["s"])
    assert scored.agg(F.avg("y_score")).first()[0] == pytest.approx(0.2, abs=1e-3)


def test_platt_query_equals_sql_after_an_observation(observed, duck):
    name = "k05_platt_against_newton"
    assert compare(entry.queries()[name](observed, SMALL), duck, entry.oracle_sql()[name]) == []
