import math
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import DOCS, empty_docs, hard_docs, hard_rows, row, words
from tests.oracle import compare
from timeward.llm import mixing
from timeward.llm.sql import mixing_sql


def _skewed():
    r = random.Random(2)
    sizes = {"hot": 400, "b": 60, "c": 30, "d": 12, None: 10, "": 6}
    rows = []
    for source, n in sizes.items():
        rows += [row(len(rows) + k, "w " * r.randrange(1, 40), "en", source) for k in range(n)]
    return rows


def _counts(rows):
    totals = {}
    for r in rows:
        totals[r[3]] = totals.get(r[3], 0) + len(words(r[1]))
    return totals


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix(entropy=0.8, most_passes=50.0), mixing.Mix(entropy=1.0, most_passes=3.5), mixing.Mix(budget=3000)])
def test_budgets_and_exponent(spark, mix):
    rows = _skewed()
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mixed(docs, mix).collect()
    totals = _counts(rows)
    largest = max(totals.values())
    s = {k: v / largest for k, v in totals.items()}

    def fits(k):
        p = {x: v ** (k / mixing.GRID) for x, v in s.items()}
        z = sum(p.values())
        entropy = -sum(v / z * math.log(v / z) for v in p.values())
        return entropy >= mix.entropy * math.log(len(s)) - 1e-12, max(p[x] / s[x] for x in s) <= mix.most_passes

    k = max(
        max((k for k in range(0, mixing.GRID + 1, 1) if fits(k)[0]), default=0),
        min(k for k in range(0, mixing.GRID + 1, 1) if fits(k)[1]),
    )
    z = sum(v ** (k / mixing.GRID) for v in s.values())
    total = mix.budget or largest * z
    spent = {}
    for r in found:
        spent[r["source"]] = spent.get(r["source"], 0) + r["mix_tokens"]
    for source in totals:
        budget = round(s[source] ** (k / mixing.GRID) / z * total)
        assert budget <= spent.get(source, 0) + 1 and spent.get(source, 0) - budget < 80, source


def test_every_document_stays_and_passes_are_whole(spark):
    rows = _skewed()
    found = mixing.mixed(spark.createDataFrame(rows, DOCS), mixing.Mix(entropy=1.0)).collect()
    first = sorted(r["doc_id"] for r in found if r["mix_pass"] == 0)
    assert first == sorted(r[0] for r in rows)
    assert {r["mix_pass"] for r in found} == {0, 1}
    # A pass is a permutation of blocks: one place per block and pass.
    places = {}
    for r in found:
        places.setdefault((r["source"], r["mix_pass"], r["mix_block"]), set()).add(r["mix_place"])
    assert all(len(p) == 1 for p in places.values())


def test_sql_counterpart_with_repeats(spark, duck):
    import duckdb
    import pandas as pd

    rows = _skewed() + hard_rows()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", frame)
    mix = mixing.Mix(entropy=0.99, most_passes=3.0)
    found = mixing.mixed(spark.createDataFrame(rows, DOCS).select("doc_id", "source", "text"), mix).drop("text")
    assert compare(found, con, mixing_sql(mix)) == []


def test_columns_and_hard_rows(spark):
    docs = hard_docs(spark).withColumns({"mix_size": F.lit("x"), "mix_pass": F.lit("old")})
    found = mixing.mixed(docs)
    assert {r["mix_size"] for r in found.collect()} == {"x"}
    assert found.where("mix_pass = 0").count() == len(hard_rows())
    texts = found.select("text", "mix_tokens").collect()
    assert all(r["mix_tokens"] == len(words(r["text"])) for r in texts)


def test_no_rows_and_no_words(spark):
    assert mixing.mixed(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([row(1, ""), row(2, None)], DOCS)
    assert mixing.mixed(blank).count() == 2
