import random
import re

import pytest
from pyspark.sql import functions as F

from timeward.names import DAY_SECONDS
from timeward.operators.history import Measure, Sliced, _suspects, add_history, find_hot
from timeward.registry import steady
from timeward.registry.history import rounded

def measures():
    return [
        Measure("n", "count", 100),
        Measure("n_long", "count", 1000),
        Measure("total", "sum", 1000, F.col("v")),
        Measure("mean", "avg", 1000, F.col("v")),
        Measure("n_all", "count"),
        Measure("mean_all", "avg", None, F.col("v")),
        Measure("sd_all", "std", None, F.col("v")),
        Measure("last", "last"),
        Measure("last_long", "last", 1000),
    ]


def brute_force(rows, share):
    out = {}
    for i, t, e, v in rows:
        if e is None and not share:
            out[i] = dict.fromkeys([m.name for m in measures()])
            continue
        earlier = [(u, w) for _, u, f, w in rows if f == e and u < t]
        one = {}
        for m in measures():
            inside = [(u, w) for u, w in earlier if m.frame is None or u >= t - m.frame]
            values = [w for _, w in inside if w is not None]
            if m.kind == "count":
                one[m.name] = len(inside)
            elif m.kind == "last":
                one[m.name] = max((u for u, _ in inside), default=None)
            elif m.kind == "sum":
                one[m.name] = float(sum(values)) if values else None
            elif m.kind == "avg":
                one[m.name] = sum(values) / len(values) if values else None
            else:
                mean = sum(values) / len(values) if values else 0
                one[m.name] = (
                    (sum((x - mean) ** 2 for x in values) / (len(values) - 1)) ** 0.5
                    if len(values) > 1
                    else None
                )
        out[i] = one
    return out


def skewed_rows(seed, n=240):
    """A third of all rows on one entity, some without one, many sharing an instant."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        roll = draw.random()
        entity = "hot" if roll < 0.34 else None if roll < 0.5 else f"e{draw.randrange(6)}"
        value = None if draw.random() < 0.1 else draw.randrange(1000) + 1e6
        rows.append((i, draw.randrange(4000), entity, value))
    return rows


@pytest.mark.parametrize("share", [False, True])
@pytest.mark.parametrize("above", [0, 40, 10_000])
def test_history_equals_self_join(spark, share, above):
    rows = skewed_rows(above + share)
    df = spark.createDataFrame(rows, "id long, t long, e string, v double")
    hot = find_hot(df, ["e"], above, share_missing=["e"] if share else []).get("e")
    assert (hot is None) == (above == 10_000)
    found = add_history(df, "e", "t", measures(), hot=hot, share_missing_entity=share)
    wanted = brute_force(rows, share)
    assert found.columns == ["id", "t", "e", "v", *[m.name for m in measures()]]
    got = {r["id"]: r for r in found.collect()}
    assert len(got) == len(rows)
    for i, expected in wanted.items():
        for name, value in expected.items():
            actual = got[i][name]
            if value is None or actual is None:
                assert actual is value, (i, name)
            else:
                assert actual == pytest.approx(value, rel=1e-9, abs=1e-6), (i, name)


def test_frames_that_do_not_divide_each_other(spark):
    rows = skewed_rows(7, 120)
    df = spark.createDataFrame(rows, "id long, t long, e string, v double")
    measures = [Measure("a", "count", 97), Measure("b", "count", 1009), Measure("c", "count")]
    hot = find_hot(df, ["e"], 0)["e"]
    got = {r["id"]: r for r in add_history(df, "e", "t", measures, hot=hot).collect()}
    for i, t, e, _ in rows:
        if e is None:
            assert got[i]["a"] is None
            continue
        earlier = [u for _, u, f, _ in rows if f == e and u < t]
        assert got[i]["a"] == sum(u >= t - 97 for u in earlier)
        assert got[i]["b"] == sum(u >= t - 1009 for u in earlier)
        assert got[i]["c"] == len(earlier)


@pytest.mark.parametrize("sliced", [False, True])
def test_documented_window_fixture(spark, sliced):
    rows = [(1, 100, "a", 10.0), (2, 100, "a", 20.0), (3, 160, "a", 30.0), (4, 200, None, 5.0),
            (5, 210, None, 6.0), (6, 90000, "a", 1.0)]
    df = spark.createDataFrame(rows, "id long, dt long, card string, amount double")
    measures = [
        Measure("n", "count", DAY_SECONDS),
        Measure("s", "sum", DAY_SECONDS, F.col("amount")),
        Measure("p", "last"),
    ]
    hot = find_hot(df, ["card"], 0)["card"] if sliced else None
    got = {r["id"]: (r["n"], r["s"], r["p"]) for r in
           add_history(df, "card", "dt", measures, hot=hot).collect()}
    assert got == {
        1: (0, None, None), 2: (0, None, None), 3: (2, 30.0, 100),
        4: (None, None, None), 5: (None, None, None), 6: (0, None, 160),
    }
    hot = find_hot(df, ["card"], 0, share_missing=["card"])["card"] if sliced else None
    shared = add_history(df, "card", "dt", measures, hot=hot, share_missing_entity=True)
    assert {r["id"]: r["n"] for r in shared.collect()}[5] == 1


@pytest.mark.parametrize("share", [False, True])
@pytest.mark.parametrize("listed", [False, True])
def test_runs_of_days_carry_their_totals(spark, share, listed):
    """Unbounded frames are cut into runs of days, of about ``slice_rows`` rows each."""
    draw = random.Random(5)
    rows = [
        (i, draw.randrange(40) * DAY_SECONDS + draw.randrange(3), draw.choice(["hot", "hot", "b", "c", None]), draw.randrange(99) + 1e6)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id long, t long, e string, v double")
    hot = df.select("e").distinct() if listed else Sliced.ALL
    found = add_history(df, "e", "t", measures(), hot=hot, share_missing_entity=share, slice_rows=7)
    got = {r["id"]: r for r in found.collect()}
    assert len(got) == len(rows)
    for i, expected in brute_force(rows, share).items():
        for name, value in expected.items():
            if value is None:
                assert got[i][name] is None, (i, name)
            else:
                assert got[i][name] == pytest.approx(value, rel=1e-9, abs=1e-6), (i, name)


def _shuffled(spark, df):
    """Bytes that were shuffled to make ``df``; no other job may run meanwhile."""
    store = spark.sparkContext._jsc.sc().statusStore()
    written = lambda: store.executorSummary("driver").totalShuffleWrite()
    before = written()
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return written() - before


def test_all_sliced_shuffles_few_records(spark):
    """No copy or carried total of a row's unbounded states, no row shuffled once more for the direct route."""
    rows = spark.range(20_000, numPartitions=2).select(
        "id", (F.col("id") % 900 * DAY_SECONDS).alias("t"), (F.col("id") % 3001).alias("e"),
        *[(F.hash("id", F.lit(k)) % 1000).cast("double").alias(f"v{k}") for k in range(20)],
    )
    wide = [Measure("n", "count", DAY_SECONDS), *[Measure(f"m{k}", "avg", None, F.col(f"v{k}")) for k in range(20)]]
    hot = find_hot(rows, ["e"], 0)["e"]
    assert _shuffled(spark, add_history(rows, "e", "t", wide, hot=hot)) < 9_000_000


def test_measures_are_checked():
    with pytest.raises(ValueError):
        Measure("x", "median")
    with pytest.raises(ValueError):
        Measure("x", "sum", 10)
    with pytest.raises(ValueError):
        Measure("x", "count", 0)


def test_times_must_be_whole_seconds(spark):
    rows = spark.createDataFrame([(1, 100.5, "a", 1.0), (2, 150.0, "a", 2.0)], "id long, t double, e string, v double")
    with pytest.raises(ValueError, match="whole seconds"):
        add_history(rows, "e", "t", measures())
    with pytest.raises(ValueError, match="whole seconds"):
        add_history(rows, "e", "t", measures(), hot=rows.select("e").distinct(), base=rows)


def _exactly(rows, columns, above, share=()):
    found = {}
    for c in columns:
        counted = rows.groupBy(c).count().where(F.col("count") > above).collect()
        values = {r[c] for r in counted if r[c] is not None or c in share}
        if values:
            found[c] = values
    return found


@pytest.mark.parametrize("above", [60, 100, 1000, 500_000])
def test_sketched_candidates_give_the_exact_hot_set(spark, above):
    """300,000 values, far more than a sketch tracks; some lie just above and just below each bound."""
    rows = spark.range(900_000, numPartitions=13).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7))
        .when(F.col("id") % 9000 < 90, F.col("id") % 90)
        .when(F.col("id") % 900_000 < 9000, F.lit(None))
        .otherwise(F.col("id") % 300_000 + 1000)
        .alias("card"),
        F.concat(F.lit("d"), F.when(F.col("id") % 5 > 0, F.col("id") % 7919).otherwise(F.col("id"))).alias("device"),
        F.lit(None).cast("date").alias("none"),
    )
    columns = ["card", "device", "none"]
    wanted = _exactly(rows, columns, above, share=["none"])
    for sure in ({}, {"sure": 0}):
        hot = find_hot(rows, columns, above, share_missing=["none"], **sure)
        assert {c: {r[c] for r in df.collect()} for c, df in hot.items()} == wanted
        assert all(df.schema[c].dataType == rows.schema[c].dataType for c, df in hot.items())
    assert find_hot(rows.limit(0), columns, above) == {}


def test_a_sketch_shuffles_no_row_per_entity(spark):
    rows = spark.range(400_000, numPartitions=8).select(F.col("id").alias("card"))
    seen = _suspects(rows, ["card"], 1000)
    seen.collect()
    plan = seen._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)", plan)
    assert keys and not any("_v" in k or "card" in k for k in keys)
    assert [r["values"] for r in seen.collect()] == [[]]


def test_doubles_are_rounded_in_doubles(spark):
    """As the decimal rounding does, without a decimal per value."""
    values = [None, float("nan"), 0.0, -0.0, -1e-7, 0.5, 2 / 3, -2 / 3, 0.123455, -0.123455, 1234567.891234, -99999.999996, 86400.0]
    rows = spark.createDataFrame([(v,) for v in values], "client_amt_avg_prior double")
    made = rounded(rows)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan.replace("rint(", "")
    found = [repr(r[0]) for r in made.collect()]
    assert found == [repr(r[0]) for r in rows.select(steady(F.col("client_amt_avg_prior"))).collect()]
