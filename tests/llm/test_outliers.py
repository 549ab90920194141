import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.samples import empty_docs, hard_docs, hard_rows, prose, row, statistics
from timeward.llm import outliers


def test_statistics_of_hard_texts(spark):
    held = outliers.with_stats(hard_docs(spark)).select("text", "stats.*").collect()
    assert len(held) == len(hard_rows())
    for r in held:
        assert tuple(r[n] for n in outliers.STATS) == statistics(r["text"])
        n = r["n_words"]
        assert r["base_failed"] == (n < 50 or 100 * r["n_repeat_words"] > 50 * n)


def test_repeated_windows_overlap(spark):
    texts = ["a b c a b c", "a a a a", "a b a b a", "a b c d a b c", "a b c x b c d", "x x x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r["text"]: r["n"] for r in outliers.with_stats(rows).select("text", F.col("stats.n_repeat_words").alias("n")).collect()}
    assert found == {t: statistics(t)[4] for t in texts}


def _group(n, source, seed=0):
    r = random.Random(seed)
    return [row(seed * 10_000 + k, prose(seed * 10_000 + k, r.randrange(60, 500)), "en", source) for k in range(n)]


def test_outliers_go_and_clean_documents_stay(spark):
    clean = _group(400, "a") + _group(250, "b", 1) + _group(5, "c", 2)
    junk = [row(90_000 + k, " ".join(w + "###" for w in prose(k, 100).split()), "en", "abc"[k % 3]) for k in range(60)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in outliers.with_verdict(docs).where("kept").select("doc_id").collect()}
    assert kept == {r[0] for r in clean}


def test_estimate_equals_concentration_in_numpy(spark):
    docs = spark.createDataFrame(_group(300, "a"), "doc_id long, text string, lang string, source string, n_chars long")
    held = outliers.with_stats(docs)
    found = {r["key"]: r for r in outliers.estimate(held).collect()}
    rows = held.where("NOT stats.base_failed").select(*outliers.coordinates("stats")).collect()
    x = np.array([[r[k] for k in range(outliers.P)] for r in rows], float)
    lower = lambda v: np.sort(v)[(len(v) - 1) // 2]
    m = np.array([lower(x[:, k]) for k in range(outliers.P)])
    mad = np.array([lower(abs(x[:, k] - m[k])) for k in range(outliers.P)])
    cov = np.diag(2.1981 * mad**2 + outliers.FLOOR**2)
    for _ in range(outliers.STEPS):
        d = np.sqrt(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m))
        bins = np.floor(np.minimum(outliers._BINS * d, outliers._LAST_BIN))
        below = np.array([(bins < b).sum() for b in bins])
        near = x[below < outliers.SHARE * len(x)]
        m = near.mean(axis=0)
        cov = np.cov(near.T, bias=True) + outliers.FLOOR**2 * np.eye(outliers.P)
    for key in ("2", '1{"l":"en"}'):
        assert np.allclose([found[key][f"m{k}"] for k in range(outliers.P)], m)
    inverse = np.linalg.inv(np.linalg.cholesky(cov))
    assert np.allclose([found["2"][f"w{i}{j}"] for i, j in outliers._LOWER], [inverse[i, j] for i, j in outliers._LOWER])


def test_hard_rows_and_clashing_names(spark):
    docs = hard_docs(spark).withColumns({"full_text": F.lit(1), "words": F.lit(2), "mcd_params": F.lit(3), "kept": F.lit("x"), "_stats": F.lit(4)})
    judged = outliers.with_verdict(docs)
    assert set(judged.columns) == {*docs.columns, "stats"}
    rows = judged.collect()
    assert len(rows) == len(hard_rows())
    assert {(r["full_text"], r["words"], r["mcd_params"], r["_stats"]) for r in rows} == {(1, 2, 3, 4)}
    assert all(r["kept"] is False for r in rows if r["stats"]["base_failed"])
    assert {r["doc_id"] for r in rows if r["kept"]} == {6, 7, None, 8, 9, 11}


def test_planted_outliers_of_one_coordinate(spark):
    """Each kind passes the base and lies off in few statistics only."""
    r = random.Random(9)

    def repeated(k, share):
        words, again = prose(70_000 + k, 200).split(), prose(80_000 + k, 20).split()
        while len(again) < share * 200:
            again += again[:20]
        return " ".join(words[: 200 - len(again)] + again)

    def symbols(k, share):
        text = prose(60_000 + k, 200)
        for _ in range(int(share * len(text))):
            at = r.randrange(len(text))
            text = text[:at] + "%" + text[at:]
        return text

    clean = _group(400, "a")
    few = [row(50_000 + k, prose(50_000 + k, 200) + " 5 %", "en", "a") for k in range(20)]
    planted = [row(70_000 + k, repeated(k, 0.4), "en", "a") for k in range(20)]
    planted += [row(60_000 + k, symbols(k, share), "en", "a") for k in range(40) for share in [(0.012, 0.03)[k % 2]]]
    docs = spark.createDataFrame(clean + few + planted, "doc_id long, text string, lang string, source string, n_chars long")
    judged = outliers.with_verdict(docs).collect()
    assert not any(r["stats"]["base_failed"] for r in judged)
    assert {r["doc_id"] for r in judged if r["kept"]} == {r[0] for r in clean + few}


def test_statistics_under_a_filter_take_no_longer(spark):
    import time

    docs = spark.createDataFrame([(prose(k, 3000),) for k in range(4)], "text string")
    started = time.perf_counter()
    assert outliers.with_stats(docs).where("NOT stats.base_failed").count() == 4
    assert time.perf_counter() - started < 30


def test_no_rows(spark):
    assert outliers.with_verdict(empty_docs(spark)).count() == 0
