"""Row-level operators on tiny frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeward.functions.derive import (
    Derivation,
    DerivationError,
    apply_derivations,
    frequency_map,
    level_indicator,
    require_maps,
    start_day,
)
from timeward.functions.scalars import (
    boolean_from_text,
    client_key,
    kind_of,
    missing_count,
    optional_number,
)
from timeward.operators.assemble import (
    AssemblyError,
    align_to,
    contract_view,
    drop_roles,
    join_identity,
    prepare_types,
    require_same_rows,
    scoring_history,
    vocabulary,
)
from timeward.operators.splits import entity_split, with_seen_entity


def values(df, column):
    return [r[column] for r in df.collect()]


def test_start_day(spark):
    df = spark.createDataFrame(
        [(864000, 3.0, 1.0), (1382400, 9.0, None)], "TransactionDT long, D1 double, D15 double"
    ).coalesce(1)
    assert values(df.select(start_day("D1").alias("x")), "x") == [7.0, 7.0]
    assert values(df.select(start_day("D15").alias("x")), "x") == [9.0, None]


@pytest.mark.parametrize(
    "data,level,expected",
    [
        (["W", "C", "W", "S"], "W", [1, 0, 1, 0]),
        (["M0", None, "M2"], "M0", [1, None, 0]),
        (["debit", "credit"], "charge card", [0, 0]),
    ],
)
def test_level_indicator(spark, data, level, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, c string").orderBy("i")
    assert values(df.select("i", level_indicator("c", level).alias("x")).orderBy("i"), "x") == expected


def test_frequency_encoding(spark):
    train = spark.createDataFrame([("1000",)] * 5 + [("2000",)] * 2 + [("7",)], "addr1 string")
    maps = frequency_map(train, ["addr1"])
    rows = spark.createDataFrame([(1, 1000), (2, 2000), (3, 9999), (4, None), (5, 7)], "TransactionID int, addr1 long")
    declared = [Derivation("f", "frequency_encode", ("addr1",))]
    found = apply_derivations(rows, declared, maps)
    assert {r["TransactionID"]: r["f"] for r in found.collect()} == {1: 5, 2: 2, 3: None, 4: None, 5: None}
    with pytest.raises(DerivationError):
        apply_derivations(rows, declared)
    require_maps(maps, declared)
    with pytest.raises(DerivationError):
        require_maps(maps, [Derivation("g", "frequency_encode", ("card2",))])


def test_derivations_refuse_what_they_cannot_compute(spark):
    df = spark.range(1)
    with pytest.raises(DerivationError):
        apply_derivations(df, [Derivation("x", "no_such_tool", ("id",))])
    with pytest.raises(DerivationError):
        apply_derivations(df, [Derivation("x", "one_hot", ("gone",), {"level": "a"})])


def test_client_key_needs_every_part(spark):
    df = spark.createDataFrame(
        [(1, 10, 325, 2, 864000), (2, 10, None, 2, 864000), (3, 10, 325, None, 864000)],
        "id int, card1 long, addr1 long, D1 long, TransactionDT long",
    )
    assert {r["id"]: r["k"] for r in df.select("id", client_key().alias("k")).collect()} == {
        1: "10_325_8", 2: None, 3: None,
    }


def test_boolean_text_and_optional_numbers(spark):
    df = spark.createDataFrame([("T",), ("false",), ("1",), ("0",), ("x",), (None,)], "s string").coalesce(1)
    assert values(df.select(boolean_from_text("s").alias("b")), "b") == [True, False, True, False, None, None]
    text = spark.createDataFrame([("NA",), ("NaN",), (None,), ("1.5",)], "s string").coalesce(1)
    assert values(text.select(optional_number(F.col("s")).alias("n")), "n") == [None, None, None, 1.5]


def test_missing_count_survives_a_wide_block(spark):
    df = spark.range(3).select(
        "id", *[F.when(F.col("id") > i % 3, F.lit(1.0)).alias(f"V{i}") for i in range(339)]
    )
    found = {r["id"]: r["n"] for r in df.select("id", missing_count([f"V{i}" for i in range(339)]).alias("n")).collect()}
    assert found == {0: 339, 1: 226, 2: 113}
    assert values(spark.range(1).select(missing_count([]).alias("n")), "n") == [0]


def test_kinds():
    assert [kind_of(t) for t in (T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType())] == [
        "int", "float", "str", "bool", "float",
    ]


ML = "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, split string, card_seen_in_train boolean, ProductCD string, V1 double"


def ml_frame(spark):
    return spark.createDataFrame(
        [(1, 10, 5.0, 0, "train", True, "W", 0.1), (2, 11, 6.0, 1, "train", True, "C", None), (3, 12, 7.0, 0, "val", False, "W", 0.3)], ML
    )


def test_roles_are_not_features(spark):
    assert drop_roles(ml_frame(spark)).columns == ["TransactionAmt", "ProductCD", "V1"]


def test_prepared_types(spark):
    df = spark.createDataFrame([(1, 2.0, True, 3.0), (2, None, None, None)], "TransactionID long, V1 double, M1 boolean, id_13 double")
    out = prepare_types(df, keep=["TransactionID"])
    assert [t for _, t in out.dtypes] == ["bigint", "float", "float", "string"]
    assert values(out.orderBy("TransactionID"), "M1") == [1.0, None]


def test_unseen_level_becomes_null(spark):
    train = spark.createDataFrame([("W",), ("C",), ("W",)], "ProductCD string")
    later = spark.createDataFrame([(1, "W"), (2, "S"), (3, "C"), (4, None)], "TransactionID long, ProductCD string")
    out = align_to(later, train.schema, levels=vocabulary(train, ["ProductCD"]), carry=["TransactionID"])
    assert {r["TransactionID"]: r["ProductCD"] for r in out.collect()} == {1: "W", 2: None, 3: "C", 4: None}


def test_contract_view_order_and_drift(spark):
    df = ml_frame(spark)
    assert contract_view(df, ["V1", "ProductCD"], carry=["isFraud", "TransactionAmt"]).columns == [
        "isFraud", "TransactionAmt", "V1", "ProductCD",
    ]
    with pytest.raises(AssemblyError):
        contract_view(df, ["V1", "V999"], carry=[])


def test_union_takes_the_training_schema(spark):
    train = spark.createDataFrame([(1, 2.0, 1)], "TransactionID long, TransactionAmt double, isFraud long")
    later = spark.createDataFrame([("x", 5, 2)], "extra string, TransactionID int, TransactionAmt int")
    out = scoring_history(train, later)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "bigint", "string"]
    assert {(r["TransactionID"], r["isFraud"], r["origin"]) for r in out.collect()} == {(1, 1, "train"), (5, None, "test")}


def test_join_keeps_rows_and_counts_raw_nulls(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, 2.0, 2.0)], "TransactionID long, V1 double, V2 double")
    right = spark.createDataFrame([(2, "d")], "TransactionID long, DeviceInfo string")
    out = {r["TransactionID"]: r for r in join_identity(left, right, block=["V1", "V2"]).collect()}
    assert (out[1]["DeviceInfo"], out[1]["null_count_V_block"]) == (None, 1)
    assert (out[2]["DeviceInfo"], out[2]["null_count_V_block"]) == ("d", 0)
    with pytest.raises(AssemblyError):
        require_same_rows(left, right, "join")


def test_seen_entity_has_three_values(spark):
    make = lambda xs: spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "client_uid string, x long")
    got = {r["x"]: r["seen_in_train"] for r in with_seen_entity(make(["a", "c", None]), make(["a", "a", "b", None])).collect()}
    assert got == {0: True, 1: False, 2: None}
    with pytest.raises(KeyError):
        with_seen_entity(make(["a"]).drop("client_uid"), make(["a"]))


def test_entity_split_shares_no_entity(spark):
    df = spark.range(600).select(
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("c"), (F.col("id") % 150).cast("string"))).alias("client_uid"), "id"
    )
    rows = entity_split(df, frac=0.7, seed=3).collect()
    part = {p: {r["client_uid"] for r in rows if r["part"] == p} for p in ("train", "holdout")}
    assert len(rows) == 600 and not part["train"] & part["holdout"]
    assert None in part["holdout"] and None not in part["train"]
    shuffled = {r["id"]: r["part"] for r in entity_split(df.orderBy(F.desc("id")), frac=0.7, seed=3).collect()}
    assert shuffled == {r["id"]: r["part"] for r in rows}
    with pytest.raises(ValueError):
        entity_split(df, frac=1.0)


def test_one_dictionary_for_many_columns_on_all_routes(spark):
    from pyspark.sql import functions as F

    from timeward.operators.lookups import with_dictionary

    words = spark.createDataFrame(
        [("a", "x", 5), ("a", "y", 7), ("b", "x", 1), ("c", "7", 9), ("d", "unused", 3)], "column string, value string, n long"
    )
    rows = spark.createDataFrame(
        [(1, "x", "x", 7), (2, "y", None, 8), (3, None, "z", None), (4, "x", "x", 7), (5, "z", "y", 7)], "id long, p string, q string, r long"
    )
    probes = {"p_n": ("a", F.col("p")), "q_n": ("b", F.col("q")), "r_n": ("c", F.col("r")), "q_as_a": ("a", F.col("q")), "none": ("gone", F.col("p"))}
    expected = [
        (1, "x", "x", 7, 5, 1, 9, 5, None), (2, "y", None, 8, 7, None, None, None, None), (3, None, "z", None, None, None, None, None, None),
        (4, "x", "x", 7, 5, 1, 9, 5, None), (5, "z", "y", 7, None, None, 9, 7, None),
    ]
    for options in ({}, {"key": "id", "most_bytes": 0}, {"most_bytes": 0}):
        found = with_dictionary(rows, words, probes, "n", **options)
        assert found.columns == [*rows.columns, *probes]
        assert sorted(map(tuple, found.collect())) == expected, options
    joined = with_dictionary(rows, words, probes, "n", key="id", most_bytes=0)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # with the dictionary, and back to the rows
    assert with_dictionary(rows, words, {}, "n").columns == rows.columns
