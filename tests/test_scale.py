"""The physical plans, not just the results."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from timeward.names import CARD, ID, TIME
from timeward.operators import assemble, history, lookups, splits
from timeward.operators.history import Measure, add_history, find_hot
from timeward.operators.lookups import small_side, with_lookup, with_membership
from timeward.plans import features
from timeward.plans.features import transaction_features
from timeward.registry.adapters import transactions
from timeward.sources.sinks import write_bucketed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle_per_entity(spark):
    plan = plan_of(transaction_features(transactions(spark, SMALL)))
    assert plan.count("Exchange hashpartitioning") == 3
    assert len(re.findall(r"\+- Window ", plan)) == 3
    assert "Join" not in plan


def test_scan_reads_only_what_the_features_need(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = transactions(spark, SMALL).withColumns({f"V{i}": F.lit(1.0) for i in range(30)})
    wide.write.parquet(path)
    found = transaction_features(spark.read.parquet(path), c_columns=["C1"], m_columns=[])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(found)).group(1)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1", "addr1", "DeviceInfo", "D1", "C1",
    }


def test_split_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "splits")
    splits.split_table(transactions(spark, SMALL)).write.partitionBy("split").parquet(path)
    val = spark.read.parquet(path).where(F.col("split") == "val")
    assert "PartitionFilters: [isnotnull(split" in plan_of(val)


def test_no_cross_product_except_with_one_row(spark):
    plan = plan_of(splits.split_table(transactions(spark, SMALL)))
    assert "CartesianProduct" not in plan


def test_positional_windows_stay_out_of_features():
    banned = re.compile(r"\bF\.(lag|lead)\b|rowsBetween")
    for module in (history, features, assemble, splits, lookups):
        assert not banned.search(inspect.getsource(module)), module.__name__


def test_missing_probes_are_spread(spark):
    rows = spark.range(4000).select(F.col("id").alias(ID), F.when(F.col("id") < 0, F.lit("x")).alias("device"))
    members = spark.createDataFrame([("a",)], "device string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = with_membership(rows, members, "device", "hit")
        sizes = (
            found.groupBy(F.spark_partition_id())
            .agg(F.count(F.lit(1)).alias("count"), F.count("hit").alias("hits"))
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_rows_without_an_entity_are_spread_over_window_partitions(spark):
    rows = spark.range(4000).select(F.col("id").alias(ID), F.col("id").alias(TIME), F.when(F.col("id") < 0, F.lit("x")).alias("device"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = add_history(rows, "device", TIME, [Measure("n", "count", 100)])
        sizes = found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("c"), F.count("n").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["c"] for r in sizes) < 2000 and not any(r["n"] for r in sizes)


def test_a_hot_entity_is_cut_over_time(spark):
    """A third of all rows on one card: none of the sliced windows may see them all."""
    rows = spark.range(30_000).select(
        F.col("id").alias(ID),
        (F.col("id") * 200).alias(TIME),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias(CARD),
    )
    hot = find_hot(rows, [CARD], 1000)
    assert [r[CARD] for r in hot[CARD].collect()] == [-1]
    placed = history._place(
        rows.where(f"{CARD} = -1").select(F.col(CARD).alias("_entity"), F.col(TIME).alias("_t")), [86_400], 86_400
    )
    largest = placed.groupBy("_entity", "_b").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 86_400 / 600 + 2
    found = add_history(rows, CARD, TIME, [Measure("n", "count", 86_400)], hot=hot[CARD])
    top = found.where(f"{CARD} = -1").agg(F.max("n"), F.count("n")).first()
    assert tuple(top) == (144, 10_000)


def test_hot_probe_keys_are_split_by_adaptive_execution(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias(ID), F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("card")
        )
        members = spark.range(1000).select(F.col("id").alias("card"))
        found = with_membership(rows, members, "card", "hit")
        assert found.where("hit").count() == 40_000 + 334
        found.collect()
        assert "skew=true" in plan_of(found)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_broadcast_only_below_a_counted_bound(spark):
    table = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    rows = spark.range(1000).select(F.col("id").alias(ID))
    hinted = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(table, 100)) and not hinted(small_side(table, 99))
    assert "BroadcastHashJoin" in plan_of(with_lookup(rows, table, F.col(ID).cast("string"), "k", "v", "out"))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(1000).select(F.col("id").alias(ID), F.col("id").alias("a"))
    right = spark.range(1000).select(F.col("id").alias(ID), F.col("id").alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = write_bucketed(left, "bucketed_left", buckets=4, path=str(tmp_path / "l"))
        y = write_bucketed(right, "bucketed_right", buckets=4, path=str(tmp_path / "r"))
        joined = x.join(y, ID)
        assert joined.count() == 1000
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_left", "bucketed_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("word", ["localCheckpoint", "toPandas", "crossJoin(rows", ".rdd"])
def test_nothing_whole_goes_through_the_driver(word):
    from pathlib import Path

    root = Path(history.__file__).parent.parent
    assert not [p for p in root.rglob("*.py") if word in p.read_text()]
