import pytest

from timeward.sources.pinned import (
    LoadError,
    Pin,
    cast_back,
    fractional_counts,
    header_lines,
    header_mismatches,
    identity_pins,
    integer_columns,
    is_current,
    load_pinned,
    read_staging,
    refresh,
    require_header,
    require_valid,
    require_whole,
    schema_matches,
    scoring_pins,
    staging_schema,
    transaction_pins,
    validation_scan,
)
from timeward.sources.sinks import append_log, read_log

PINS = [Pin("TransactionID", "INTEGER"), Pin("TransactionAmt", "FLOAT"), Pin("C1", "INTEGER"), Pin("ProductCD", "STRING"), Pin("M1", "BOOLEAN")]


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_pinned_schemas():
    transactions, identity = transaction_pins(), identity_pins()
    assert len(transactions) == 394 and len(identity) == 41
    count = lambda pins, t: sum(p.type == t for p in pins)
    assert [count(transactions, t) for t in ("FLOAT", "INTEGER", "BOOLEAN", "STRING")] == [345, 35, 8, 6]
    assert [count(identity, t) for t in ("FLOAT", "STRING", "BOOLEAN", "INTEGER")] == [23, 13, 4, 1]
    assert "isFraud" not in [p.name for p in scoring_pins(transactions)]


def test_only_integers_are_widened():
    kinds = {f.name: f.dataType.simpleString() for f in staging_schema(PINS).fields}
    assert kinds == {"TransactionID": "double", "TransactionAmt": "double", "C1": "double", "ProductCD": "string", "M1": "string"}
    assert integer_columns(PINS) == ["TransactionID", "C1"]


def test_load(spark, tmp_path):
    path = write(tmp_path / "a.csv", "TransactionID,Amt,C-1,ProductCD,M1", "1.0,2.5,3.0,W,T", "2,1,,C,", "3.0,,4.0,,F")
    out = load_pinned(spark, path, PINS)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "bigint", "string", "boolean"]
    assert sorted(map(tuple, out.collect())) == [(1, 2.5, 3, "W", True), (2, 1.0, None, "C", None), (3, None, 4, None, False)]


def test_fractions_are_named(spark, tmp_path):
    path = write(tmp_path / "a.csv", "TransactionID,TransactionAmt,C1,ProductCD,M1", "1,2,0.5,W,T", "2,1,1.25,C,F", "3,1.5,2.0,C,F")
    staged = read_staging(spark, path, PINS)
    assert fractional_counts(staged, integer_columns(PINS)).first().asDict() == {"TransactionID": 0, "C1": 2}
    with pytest.raises(LoadError, match=r"C1 \(2\)"):
        require_whole(staged, integer_columns(PINS))
    assert fractional_counts(staged, []) is None
    require_whole(staged, [])
    assert cast_back(staged, PINS).columns == [p.name for p in PINS]


def test_malformed_numbers_raise(spark, tmp_path):
    path = write(tmp_path / "a.csv", "TransactionID,TransactionAmt,C1,ProductCD,M1", "1,oops,1,W,T")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_staging(spark, path, PINS).collect()


def test_header(spark, tmp_path):
    pins = [Pin("id_01", "FLOAT"), Pin("id_02", "FLOAT")]
    assert header_mismatches(["id-01", "id-02"], pins) == []
    assert header_mismatches(["id-01"], pins) == ["1 columns against 2 pinned"]
    assert header_mismatches(["id-01", "x"], pins) == ["1: x is not id_02"]
    with pytest.raises(LoadError):
        require_header(spark, write(tmp_path / "a.csv", "id-01,x", "1,2"), pins)


def test_validation(spark):
    good = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None)], "TransactionID long, isFraud double")
    assert require_valid(good, ["TransactionID"], "isFraud") == 3
    with pytest.raises(LoadError, match="absent: TransactionAmt"):
        require_valid(good, ["TransactionAmt"], "isFraud")
    bad = spark.createDataFrame([(1, "2"), (2, "1"), (3, "x"), (4, "2")], "TransactionID long, isFraud string")
    assert validation_scan(bad, [], "isFraud").first()["invalid_labels"] == 3
    with pytest.raises(LoadError, match=r"3 label\(s\) other than 0 and 1, e.g. 2, x"):
        require_valid(bad, ["TransactionID"], "isFraud")


def test_schema_match(spark):
    schema = spark.createDataFrame([], "TransactionID long, addr1 double").schema
    assert not schema_matches(schema, [Pin("TransactionID", "INTEGER"), Pin("addr1", "INTEGER")])
    assert schema_matches(schema, [Pin("TransactionID", "INT64"), Pin("addr1", "FLOAT64")])
    assert not schema_matches(schema, [Pin("gone", "STRING")])


def test_reload_only_when_something_changed(spark, tmp_path):
    pins = [Pin("a", "INTEGER"), Pin("b", "FLOAT")]
    source = tmp_path / "src"
    source.mkdir()
    write(source / "1.csv", "a,b", "1,0.5", "2,1.5")
    target, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    status = lambda p: refresh(spark, str(source), target, manifest, p).first()["status"]
    assert not is_current(spark, target, manifest, "x", pins, 2)
    assert [status(pins), status(pins)] == ["loaded", "current"]
    write(source / "2.csv", "a,b", "3,2.5")
    assert [status(pins), status(pins)] == ["loaded", "current"]
    assert spark.read.parquet(target).count() == 3


def test_log_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(spark.createDataFrame([(1, "a")], "id long, run string"), path)
    append_log(spark.createDataFrame([(2, "b", 0.5)], "id long, run string, score double"), path)
    assert {tuple(r) for r in read_log(spark, path).select("id", "run", "score").collect()} == {(1, "a", None), (2, "b", 0.5)}


def test_every_file_of_a_folder_must_have_the_pinned_header(spark, tmp_path):
    pins = [Pin("a", "INTEGER"), Pin("b", "STRING")]
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,x\n')
    (folder / "2.csv").write_text('"a", "b"\n2,"y, z"\n')
    require_header(spark, str(folder), pins)
    (folder / "3.csv").write_text("b,a\nx,3\n")
    with pytest.raises(LoadError, match="b is not a"):
        require_header(spark, str(folder), pins)


def test_a_refresh_parses_the_source_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from timeward.sources import pinned

    parsed = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(value):
        parsed.add(1)
        return True

    real = pinned.read_staging
    monkeypatch.setattr(pinned, "read_staging", lambda *a: real(*a).where(seen.asNondeterministic()("a")))
    pins = [Pin("a", "INTEGER"), Pin("b", "FLOAT")]
    source = write(tmp_path / "s.csv", "a,b", *(f"{k},{k / 2}" for k in range(500)))
    target, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    assert refresh(spark, source, target, manifest, pins).first()["status"] == "loaded" and parsed.value == 500
    assert refresh(spark, source, target, manifest, pins).first()["status"] == "current" and parsed.value == 500
    assert load_pinned(spark, source, pins).agg(F.sum("a")).first()[0] == sum(range(500)) and parsed.value == 1000


def test_a_failed_refresh_leaves_the_old_target(spark, tmp_path):
    pins = [Pin("TransactionID", "INTEGER"), Pin("isFraud", "INTEGER")]
    source, target, manifest = tmp_path / "s.csv", str(tmp_path / "t"), str(tmp_path / "m")
    run = lambda: refresh(spark, str(source), target, manifest, pins).first()
    write(source, "TransactionID,isFraud", "1,0", "2,1")
    assert run()["status"] == "loaded"
    for lines, problem in ((["1,0", "2.5,1", "3.5,1"], r"TransactionID \(2\)"), (["1,0", "2,3"], "1 label")):
        write(source, "TransactionID,isFraud", *lines)
        with pytest.raises(LoadError, match=problem):
            run()
        assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, 0), (2, 1)]
    write(source, "TransactionID,isFraud", "4,1")
    assert run()["rows"] == 1


def test_a_wrong_header_after_many_others_is_found(spark, tmp_path):
    pins = [Pin("a", "INTEGER"), Pin("b", "STRING")]
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(30):
        (folder / f"{k:02d}.csv").write_text(f"a,{' ' * k}b\n1,x\n")
    require_header(spark, str(folder), pins)
    for name, header in (("w", "a,z"), ("x", "a,b,"), ("y", "a"), ("z", "a,b,c")):
        (folder / f"{name}.csv").write_text(f"{header}\n1,x\n")
        with pytest.raises(LoadError, match="in 1 of 31"):
            require_header(spark, str(folder), pins)
        (folder / f"{name}.csv").unlink()
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(LoadError, match="empty"):
        require_header(spark, str(empty), pins)


def test_proofs_of_written_tables(spark, tmp_path):
    from pyspark.sql import functions as F

    from timeward.sources.proof import ProofError, proved_write, require_same_keys

    rows = spark.range(1000).withColumn("v", F.col("id") % 7)
    proof = proved_write(rows, str(tmp_path / "a"), key="id", counts={"zero": F.col("v") == 0, "none": F.col("v") < 0})
    assert (proof.rows, proof.counts, proof.found) == (1000, {"zero": 143, "none": 0}, {"zero": 143})
    again = proved_write(rows.repartition(5), str(tmp_path / "b"), key="id")
    assert require_same_keys(proof, again, "x") == 1000
    with pytest.raises(ProofError, match="999 rows"):
        require_same_keys(proved_write(rows.limit(999), str(tmp_path / "c"), key="id"), again, "x")
    with pytest.raises(ProofError, match="other keys"):
        require_same_keys(proved_write(rows.withColumn("id", F.col("id") + 1), str(tmp_path / "d"), key="id"), again, "x")
    nothing = proved_write(rows.limit(0), str(tmp_path / "e"), key="id", counts={"zero": F.col("v") == 0})
    assert (nothing.rows, nothing.found) == (0, {})


def test_header_lines_hold_no_lines_back(spark, tmp_path):
    """The first line of each file, whatever its size, with nothing sorted or grouped to find it."""
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(5):
        (folder / f"{k}.csv").write_text(f"a{k},b\n" + "1,2\n" * (30_000 if k == 3 else 3))
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\nx,y\n")
    found = header_lines(spark, str(folder))
    got = {r["file"].rsplit("/", 1)[1]: r["header"] for r in found.collect()}
    assert got == {f"{k}.csv": f"a{k},b" for k in range(5)} | {"blank.csv": ""}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort" not in plan and "Exchange" not in plan
