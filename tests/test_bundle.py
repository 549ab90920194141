import dataclasses

import pytest
from pyspark.sql import functions as F

from timeward.contract.tables import ContractError
from timeward.functions.derive import Derivation, DerivationError, apply_derivations, frequency_map
from timeward.operators.calibration import fit_calibrator
from timeward.plans.bundle import FORMAT, Bundle, BundleError, load_bundle, promoted_bundle, save_bundle, score_promoted
from timeward.plans import models
from timeward.plans.gate import GateError
from timeward.plans.models import TreeInputs, fit_trees
from timeward.registry.modelling import _contract_of
from timeward.sources.sinks import read_log, replace_run

KEEP = ["TransactionID"]


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(400).select(
        F.col("id").alias("TransactionID"),
        (F.col("id") % 7 == 0).cast("int").alias("isFraud"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 7) + (F.col("id") % 3) / 10).alias("x"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("d"), F.col("id") % 13)).alias("device"),
        F.element_at(F.array(F.lit("W"), F.lit("C"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("ProductCD"),
    )
    return made.cache()


@pytest.fixture(scope="module")
def fitted(rows):
    derivations = (Derivation("device_n", "frequency_encode", ("device",)),)
    maps = frequency_map(rows, ["device"])
    ready = apply_derivations(rows, derivations, maps)
    inputs = TreeInputs(("x", "device_n"), ("ProductCD",))
    model = fit_trees(ready.where("TransactionID < 300"), ready.where("TransactionID >= 300"), inputs, max_iter=2, maxDepth=2)
    calibrator = fit_calibrator(model.score(ready), "raw_score", "platt")
    return Bundle("r1", model, calibrator, 0.3, "stamp", "v7", derivations, maps)


def _shown(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("method", ["platt", "isotonic"])
def test_reloaded_bundle_scores_alike(spark, rows, fitted, tmp_path, method):
    ready = apply_derivations(rows, fitted.derivations, fitted.maps)
    calibrator = fit_calibrator(fitted.model.score(ready), "raw_score", method)
    bundle = dataclasses.replace(fitted, calibrator=calibrator)
    back = load_bundle(spark, save_bundle(bundle, str(tmp_path)))
    assert (back.run, back.threshold, back.fingerprint, back.code_version) == ("r1", 0.3, "stamp", "v7")
    assert back.features == bundle.features and back.derivations == bundle.derivations
    assert back.model.params == dict(bundle.model.params) and back.calibrator.method == method
    assert back.model is not bundle.model and _shown(back.score(rows, keep=KEEP)) == _shown(bundle.score(rows, keep=KEEP))


def test_complete_bundles_stay_and_incomplete_ones_are_written_again(spark, fitted, tmp_path):
    path = save_bundle(fitted, str(tmp_path))
    with pytest.raises(BundleError, match="never overwritten"):
        save_bundle(fitted, str(tmp_path))
    (tmp_path / "r1" / "manifest" / "_SUCCESS").unlink()
    with pytest.raises(BundleError, match="no complete bundle"):
        load_bundle(spark, path)
    assert load_bundle(spark, save_bundle(fitted, str(tmp_path))).run == "r1"
    with pytest.raises(BundleError, match="no complete bundle"):
        load_bundle(spark, str(tmp_path / "other"))


def test_parts_must_be_those_of_the_manifest(spark, rows, fitted, tmp_path):
    path = save_bundle(fitted, str(tmp_path / "a"))
    frequency_map(rows.where("TransactionID < 200"), ["device"]).select("column", "value", "count").write.mode("overwrite").parquet(f"{path}/maps")
    with pytest.raises(BundleError, match="frequency maps"):
        load_bundle(spark, path)
    path = save_bundle(fitted, str(tmp_path / "b"))
    text = (next((tmp_path / "b" / "r1" / "manifest").glob("part-*"))).read_text()
    for old, new, problem in (('"x", ', "", "values"), (f'"format": {FORMAT}', '"format": 9', "format")):
        spark.createDataFrame([(text.strip().replace(old, new),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        with pytest.raises(BundleError, match=problem):
            load_bundle(spark, path)


def _stored(spark, fitted, tmp_path, names=("r1",)):
    contract = _contract_of(spark, fitted.model.inputs)
    promotions = spark.createDataFrame([(n, "stamp", k) for k, n in enumerate(names)], "run string, fingerprint string, promoted_at int")
    runs = promotions.select("run", F.col("promoted_at").alias("updated_at"))
    save_bundle(fitted, str(tmp_path))
    return str(tmp_path), promotions, runs, contract


def test_promoted_run_is_resolved_and_scores(spark, rows, fitted, tmp_path):
    root, promotions, runs, contract = _stored(spark, fitted, tmp_path)
    bundle, scored = score_promoted(rows, root, promotions, runs, contract, "stamp", keep=KEEP)
    assert bundle.run == "r1" and _shown(scored) == _shown(fitted.score(rows, keep=KEEP))


def test_every_disagreement_raises(spark, rows, fitted, tmp_path):
    root, promotions, runs, contract = _stored(spark, fitted, tmp_path)
    ask = lambda p=promotions, r=runs, c=contract, f="stamp": promoted_bundle(spark, root, p, r, c, f)
    assert ask().run == "r1"
    newer = runs.union(spark.createDataFrame([("r2", 5)], runs.schema))
    with pytest.raises(GateError, match="not the newest"):
        ask(r=newer)
    with pytest.raises(GateError, match="no run has been promoted"):
        ask(p=promotions.limit(0))
    with pytest.raises(BundleError, match="no complete bundle"):
        ask(p=promotions.withColumn("run", F.lit("r3")), r=runs.withColumn("run", F.lit("r3")))
    with pytest.raises(BundleError, match="promoted with fingerprint"):
        ask(p=promotions.withColumn("fingerprint", F.lit("other")))
    with pytest.raises(ContractError, match="fingerprint"):
        ask(f="other")
    with pytest.raises(ContractError, match="x: in the model"):
        ask(c=contract.withColumn("admitted", F.col("column") != "x"))
    with pytest.raises(ContractError, match="admitted but unused"):
        ask(c=contract.union(contract.limit(1).withColumn("column", F.lit("extra"))))


def test_absent_maps_and_features_raise(rows, fitted):
    none_left = dataclasses.replace(fitted, maps=fitted.maps.where("count < 0"))
    with pytest.raises(DerivationError):
        none_left.score(rows, keep=KEEP)
    with pytest.raises(Exception, match="x"):
        fitted.score(rows.drop("x"), keep=KEEP)


def test_a_run_logged_twice_leaves_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log = lambda rows: replace_run(spark.createDataFrame(rows, "id int, run string, v int"), path)
    log([(1, "a", 1), (2, "a", 1)])
    log([(1, "b/../x", 1), (7, None, 1)])
    log([(1, "a", 2)])
    log([(9, "2024", 3)])
    assert _shown(read_log(spark, path).select("id", F.coalesce("run", F.lit("-")), "v")) == [(1, "a", 2), (1, "b/../x", 1), (7, "-", 1), (9, "2024", 3)]
    replace_run(spark.createDataFrame([(4, "c", 1, "new")], "id int, run string, v int, more string"), path)
    found = read_log(spark, path)
    assert found.columns == ["id", "run", "v", "more"] and found.where("more IS NULL").count() == 4
    assert dict(found.dtypes)["run"] == "string"


def test_a_fit_is_dealt_by_rows_not_by_files(rows, monkeypatch):
    """A task of a fit holds a fixed number of rows, however few files or splits they come from."""
    seen = []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models, "_FIT_ROWS", 50)
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit(self, data))
    held = rows.coalesce(1)
    model = fit_trees(held.where("TransactionID < 300"), held.where("TransactionID >= 300"), TreeInputs(("x",), ("ProductCD",)), max_iter=1, maxDepth=2)
    assert seen == [8] and model.trees == 1


def test_all_fits_share_one_dealing(rows, monkeypatch):
    """Each fit used to prepare and shuffle the same rows once more; the models are those of single fits."""
    kept = rows.sparkSession.sparkContext._jsc.getPersistentRDDs
    rows.count()
    held, dealt, deal = set(kept()), [], models._dealt
    monkeypatch.setattr(models, "_dealt", lambda df: dealt.append(1) or deal(df))
    parts = rows.where("TransactionID < 300"), rows.where("TransactionID >= 300")
    inputs = TreeInputs(("x",), ("ProductCD",))
    fixed = {"max_iter": 2, "subsamplingRate": 0.7}
    found = models.fit_all_trees(*parts, inputs, settings=[{"seed": 1, "maxDepth": 2}, {"seed": 2, "maxDepth": 3}], **fixed)
    assert len(dealt) == 1
    assert [m.params for m in found] == [{"subsamplingRate": 0.7, "maxDepth": d} for d in (2, 3)]
    for model, seed in zip(found, (1, 2)):
        alone = fit_trees(*parts, inputs, seed=seed, maxDepth=seed + 1, **fixed)
        assert alone.params == model.params
        assert alone.pipeline.stages[-1].toDebugString.split("\n")[1:] == model.pipeline.stages[-1].toDebugString.split("\n")[1:]
    assert set(kept()) == held
