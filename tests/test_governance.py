from datetime import date

import pytest
from pyspark.sql import functions as F

from timeward.contract.document import from_document, to_document
from timeward.contract.tables import (
    ContractError,
    REJECTIONS,
    blacklist_rejections,
    build_contract,
    declared_columns,
    schema_rows,
    freshness,
    map_digest,
    override_rows,
    read_fragments,
    rejections_of,
    require_model_matches,
    summary,
    training_features,
)
from timeward.plans.audits import (
    distribution_shift,
    run_audits,
    segment_rejections,
    time_rejections,
)
from timeward.plans.gate import (
    GateError,
    GateLimits,
    gate_checks,
    require_metrics,
    require_passed,
    require_promoted,
    verdict,
)
from timeward.policy import ADMIT, REJECT, Policy, PolicyError, Ruling, policy_from

FAR = date(2999, 1, 1)


def declared(spark):
    schema = spark.createDataFrame([], "TransactionID long, V1 double, V2 double, ProductCD string, card_txn_count_1h long, D1n double").schema
    return declared_columns(schema_rows(spark, schema), derived=["D1n"])


def rejections(spark, *rows):
    return spark.createDataFrame(list(rows), REJECTIONS)


def test_declaration(spark):
    got = [(r["column"], r["source"], r["dtype"]) for r in declared(spark).orderBy("position").collect()]
    assert got == [
        ("V1", "request", "float"), ("V2", "request", "float"), ("ProductCD", "request", "str"),
        ("card_txn_count_1h", "retrieved", "int"), ("D1n", "derived", "float"),
    ]


def test_first_rejection_counts_and_override_keeps_the_objection(spark):
    policy = Policy(rulings=(Ruling("V2", ADMIT, "needed", FAR), Ruling("V1", REJECT, "policy")))
    found = rejections(spark, (1, "late", "t", "V1", 0.9, "column"), (0, "early", "t", "V1", 0.1, "block:a"), (1, "late", "t", "V2", 0.7, "column"))
    both = found.unionByName(blacklist_rejections(spark, policy))
    rows = {r["column"]: r for r in build_contract(declared(spark), both, override_rows(spark, policy)).collect()}
    assert (rows["V1"]["rejected_by"], rows["V1"]["rejected_value"], rows["V1"]["rejected_unit"]) == ("early", 0.1, "block:a")
    assert rows["V2"]["admitted"] and rows["V2"]["admitted_by"] == "override" and rows["V2"]["rejected_by"] == "late"
    assert rows["ProductCD"]["admitted"] and rows["ProductCD"]["rejected_by"] == ""


def test_undeclared_names_raise(spark):
    none = override_rows(spark, Policy())
    with pytest.raises(ContractError, match="V9"):
        build_contract(declared(spark), rejections(spark, (0, "c", "t", "V9", None, "column")), none)
    with pytest.raises(ContractError, match="V9"):
        build_contract(declared(spark), rejections(spark), override_rows(spark, Policy(rulings=(Ruling("V9", ADMIT, "x", FAR),))))


def contract(spark):
    return build_contract(declared(spark), rejections(spark, (0, "c", "t", "V1", 1.5, "column")), override_rows(spark, Policy()))


def test_document_round_trip_and_tampering(spark):
    built = contract(spark)
    document = to_document(built, Policy())
    again = to_document(built, Policy())
    assert document["fingerprint"] == again["fingerprint"]
    assert document["summary"] == summary(built).first().asDict()
    assert training_features(from_document(spark, document)) == ["V2", "ProductCD", "card_txn_count_1h", "D1n"]
    assert to_document(built, Policy(psi_threshold=0.3))["fingerprint"] != document["fingerprint"]
    assert to_document(built, Policy(), maps=spark.createDataFrame([("a", "x", 5)], "column string, value string, count long"))["fingerprint"] != document["fingerprint"]
    document["columns"][0]["admitted"] = True
    with pytest.raises(ContractError):
        from_document(spark, document)


def test_model_problems_come_together(spark):
    built = contract(spark)
    names = lambda *xs: spark.createDataFrame([(x,) for x in xs], "column string")
    require_model_matches(built, names("V2", "ProductCD", "card_txn_count_1h", "D1n"), fingerprint="a", expected="a")
    with pytest.raises(ContractError) as error:
        require_model_matches(built, names("V1", "V2", "ProductCD", "zz"), fingerprint="a", expected="b")
    text = str(error.value)
    assert "V1: in the model, not in the contract c" in text and "zz: in the model, not in the contract not declared" in text
    assert "D1n: admitted but unused" in text and "fingerprint" in text


def write(folder, name, text):
    (folder / name).write_text(text)


def test_fragments(spark, tmp_path):
    write(tmp_path, "a.json", '{"check": "x", "tool": "t", "rejections": [\n {"column": "V1", "value": "NA"}, {"column": "V2", "value": 0.5, "unit": "block:b"}]}')
    write(tmp_path, "b.json", '{"check": "y", "tool": "t", "rejections": [{"column": "V1", "value": null}]}')
    got = {(r["precedence"], r["column"], r["value"], r["unit"]) for r in rejections_of(read_fragments(spark, str(tmp_path), ["y", "x"])).collect()}
    assert got == {(0, "V1", None, "column"), (1, "V1", None, "column"), (1, "V2", 0.5, "block:b")}
    with pytest.raises(ContractError, match="audits without a result: .'z'"):
        read_fragments(spark, str(tmp_path), ["x", "z"])
    write(tmp_path, "c.json", '{"check": "z", "rejections": []}')
    with pytest.raises(ContractError, match="tool"):
        read_fragments(spark, str(tmp_path), ["x", "z"])


def test_freshness(spark):
    at = lambda s: F.lit(s).cast("timestamp")
    age, fresh = freshness(at("2026-01-01 00:00:00"), at("2026-01-31 12:00:00"), 30)
    assert tuple(spark.range(1).select(age, fresh).first()) == (30.5, False)
    _, unstamped = freshness(F.lit(None).cast("timestamp"), at("2026-01-31 12:00:00"), 30)
    assert spark.range(1).select(unstamped).first()[0] is False


def test_map_digest_ignores_order_and_sees_changes(spark):
    make = lambda rows: map_digest(spark.createDataFrame(rows, "column string, value string, count long")).first()["digest"]
    rows = [("a", "x", 5), ("a", "y", 7)]
    assert make(rows) == make(rows[::-1]) != make([("a", "x", 5), ("a", "y", 8)])


def test_policy_rules():
    assert Policy().validate().digest() == Policy().digest() != Policy(psi_threshold=0.1).digest()
    with pytest.raises(PolicyError, match="expired"):
        Policy(rulings=(Ruling("V1", ADMIT, "x", date(2020, 1, 1)),)).validate(date(2026, 1, 1))
    with pytest.raises(PolicyError, match="both"):
        Policy(rulings=(Ruling("V1", REJECT, "x"), Ruling("V1", ADMIT, "y", FAR))).validate()
    with pytest.raises(PolicyError, match="missing 'reason'"):
        policy_from({"blacklist": [{"column": "V1"}]})
    with pytest.raises(PolicyError, match="more than once"):
        policy_from({"derive": [{"name": "a", "tool": "t", "inputs": ["x"]}] * 2})
    read = policy_from({"distribution_shift": {"psi_threshold": 0.5, "enabled": False}, "segment_qualification": {"enabled": True, "segment_column": "p"}})
    assert (read.psi_threshold, read.segment_enabled, read.enabled("distribution_shift"), read.enabled("redundancy")) == (0.5, True, False, True)
    assert policy_from({}).psi_threshold == 0.25


# ---- audits and gate -------------------------------------------------------------------------


def test_constant_reference_is_degenerate_not_shifted(spark):
    df = spark.range(1000).select(
        F.col("id").alias("TransactionDT"),
        F.when(F.col("id") > 500, F.rand(1)).otherwise(F.lit(1.0)).alias("flat"),
        (F.col("id") % 10).cast("double").alias("steady"),
    )
    got = {r["column"]: r for r in distribution_shift(df, ["flat", "steady"]).collect()}
    assert got["flat"]["psi"] is None and got["flat"]["degenerate"]
    assert got["steady"]["psi"] < 0.01 and not got["steady"]["degenerate"]


def test_a_whole_family_goes_with_one_inverted_member(spark):
    found = spark.createDataFrame([("a", 0.6, 0.4, -0.2, True), ("b", 0.6, 0.55, -0.05, False), ("c", 0.6, 0.6, 0.0, False)], "column string, auc_train double, auc_holdout double, delta double, inverted boolean")
    families = spark.createDataFrame([("a", "f"), ("b", "f"), ("c", "g")], "column string, family string")
    got = {(r["column"], r["unit"]) for r in time_rejections(found, families=families).collect()}
    assert got == {("a", "block:f"), ("b", "block:f")}
    assert [r["column"] for r in time_rejections(found).collect()] == ["a"]


def test_segment_audit_only_reports_by_default(spark):
    found = spark.createDataFrame([("a", "W", 100, 0.7, 0.5, True), ("b", "W", 100, 0.7, None, False), ("a", "C", 5, 0.7, 0.7, False)], "column string, segment string, rows long, pooled double, within double, hollow boolean")
    assert segment_rejections(found).count() == 0
    assert [r["column"] for r in segment_rejections(found, reject=True).collect()] == ["a"]
    assert {r["column"] for r in segment_rejections(found, reject=True, reject_unmeasurable=True).collect()} == {"a", "b"}


def test_audits_follow_the_policy(spark):
    noise = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)).cast("double")
    late = F.col("id") > 1000
    label = (noise(1) > 500).cast("int")
    rows = spark.range(2000).select(
        F.col("id").alias("TransactionID"), F.col("id").alias("TransactionDT"), label.alias("isFraud"),
        F.lit("W").alias("ProductCD"),
        (noise(2) + F.when(late, -300).otherwise(300) * label).alias("turns"),
        noise(3).alias("mate"),
        (noise(4) + F.when(late, 5000).otherwise(0)).alias("moves"),
        noise(5).alias("same"), (noise(5) * 2).alias("copy"),
    )
    columns = ["turns", "mate", "moves", "same", "copy"]
    groups = {"f": ["turns", "mate"], "g": ["same", "copy"]}
    got = {(r["check"], r["column"], r["unit"]) for r in run_audits(rows, columns, Policy(), groups=groups).collect()}
    assert {("time_consistency", "turns", "block:f"), ("time_consistency", "mate", "block:f"),
            ("distribution_shift", "moves", "column"), ("redundancy", "same", "column")} <= got
    off = Policy(disabled=frozenset({"time_consistency", "distribution_shift", "redundancy"}), segment_enabled=False)
    assert run_audits(rows, columns, off).count() == 0


GOOD = {"test_pr_auc": 0.52, "test_pr_auc_unseen": 0.53, "test_expected_calibration_error": 0.0077, "test_threshold_false_positive_rate": 0.0117}


def metrics(spark, **changes):
    values = {**GOOD, **changes}
    return spark.createDataFrame([(k, v) for k, v in values.items() if v is not None], "metric string, value double")


def dominant(spark, *rows):
    return spark.createDataFrame(list(rows), "product string, pr_auc double, positive_rate double")


@pytest.mark.parametrize(
    "changes,lift,failed",
    [
        ({}, 0.2130, ""),
        ({"test_pr_auc": 0.0698}, 0.2130, "pr_auc_above_baseline"),
        ({"test_pr_auc_unseen": 0.06}, 0.2130, "no_cold_entity_regression"),
        ({"test_expected_calibration_error": 0.021}, 0.2130, "calibration_sane"),
        ({"test_threshold_false_positive_rate": 0.013}, 0.05, "dominant_segment_not_regressed, threshold_survives_out_of_sample"),
    ],
)
def test_gate(spark, changes, lift, failed):
    checks = gate_checks(metrics(spark, **changes), dominant(spark, ("W", lift, 0.0198)))
    found = verdict(checks).first()
    assert (found["promoted"], found["failed"]) == (failed == "", failed)


def test_absent_is_not_zero(spark):
    with pytest.raises(GateError, match="test_pr_auc_unseen"):
        require_metrics(metrics(spark, test_pr_auc_unseen=None))
    none = gate_checks(metrics(spark), dominant(spark))
    with pytest.raises(GateError, match="dominant"):
        require_passed(none)


def test_promoted_run_must_be_the_newest(spark):
    runs = spark.createDataFrame([("a", 1), ("b", 2)], "run string, updated_at int")
    make = lambda *rows: spark.createDataFrame(list(rows), "run string, promoted_at int")
    assert require_promoted(make(("a", 1), ("b", 2)), runs) == "b"
    with pytest.raises(GateError, match="not the newest"):
        require_promoted(make(("b", 1), ("a", 2)), runs)
    with pytest.raises(GateError, match="no run"):
        require_promoted(make(), runs)


def test_limits_are_the_documented_ones():
    assert GateLimits().baseline_pr_auc * GateLimits().min_pr_auc_lift == pytest.approx(0.06985)
