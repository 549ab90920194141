"""The queries over the given tables that apply the corpus operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeward.llm import chat, license_scan, line_quality, merkle, mixing, outliers, packing, permutation_index, secret_scan, simhash, sql, toxicity, treap_search, url_filter
from timeward.llm.text import remainder, table


def op1_line_field_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 4) == 2
    field = line_quality.train(docs, table(spark, folder, "labels"), ~held_out)
    scored = line_quality.with_quality(docs, field, out="score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents").select("doc_id", "text"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op3_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    judged = outliers.with_verdict(table(spark, folder, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *(f"stats.{n}" for n in outliers.STATS), "stats.base_failed", "kept")


def op4_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    index = permutation_index.build(permutation_index.usable(table(spark, folder, "embeddings")))
    return permutation_index.search(index, F.col("vec_id") % 20 == 0, k=20)


def op5_guess_cost_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.with_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *(
            secret_scan.count_of(F.col("secrets"), kind).alias(f"n_{kind}")
            for kind in ("assign", "access", "hex")
        ),
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("secrets")).alias("spans"),
    )


def op6_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    weights = toxicity.train(docs, table(spark, folder, "labels"), ~held_out)
    scored = toxicity.with_toxicity(docs, weights, out="score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# Strings that look like the template's own signs.
_LOOKALIKE = "\\### Assistant: </turn> ok"


def op7_grammar_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_LOOKALIKE).alias("text"),
    )
    return chat.read_back(chat.conversations(turns.unionByName(more)))


# The rules.
RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


def op8_boosted_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    trees = url_filter.train(url_filter.rule_labels(pages, RULES))
    return url_filter.judged(pages, RULES, trees).select("page_id", "judged.*")


def op9_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", "mix_tokens", "mix_pass", "mix_block", "mix_place")


def op10_simhash_tiles(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_suffix_automaton_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.with_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    licenses, starts = F.col("licenses"), F.transform("licenses.places", lambda p: p["start"])
    return found.select(
        "doc_id",
        "licenses.n_words",
        F.size("licenses.places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(license_scan.base_labels(licenses), ",").alias("base_labels"),
        F.array_join(license_scan.labels(licenses), ",").alias("labels"),
        license_scan.score(licenses).alias("score"),
        "licenses.spans",
    )


def op12_treap_search(spark: SparkSession, folder: str) -> DataFrame:
    index = treap_search.build(table(spark, folder, "documents"))
    return treap_search.search(index, table(spark, folder, "benchmark"), k=20)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = merkle.digest(*fields)
    changed = merkle.digest(*fields[:3], F.try_add("n_chars", F.lit(1)), fields[4])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed).otherwise(leaf)
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), tampered.alias("tampered"))
    proved = merkle.manifest(leaves, F.col("lang"), ["doc_id"])
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        merkle.folded(F.col("tampered"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_field_quality,
        op2_power_of_two_packing,
        op3_robust_outliers,
        op4_permutation_index,
        op5_guess_cost_secrets,
        op6_ftrl_toxicity,
        op7_grammar_round_trip,
        op8_boosted_url_trees,
        op9_temperature_mixing,
        op10_simhash_tiles,
        op11_suffix_automaton_licenses,
        op12_treap_search,
        op13_merkle_manifest,
    )
}
SQL: dict[str, str] = {
    "op3_robust_outliers": sql.outliers_sql(),
    "op7_grammar_round_trip": sql.chat_sql(_LOOKALIKE),
    "op12_treap_search": sql.search_sql(),
    "op13_merkle_manifest": sql.merkle_sql(),
    "op9_temperature_mixing": sql.mixing_sql(mixing.Mix()),
}
