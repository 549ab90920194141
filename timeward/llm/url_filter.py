"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

A rule such as ``net/`` or ``example.com/de/`` fits its host and all subdomains if the path starts with
its own; the longest that fits decides. The trees are fitted on a bounded sample of labelled URLs
and judge those that no rule fits. Everything is DataFrame functions and Spark's own trees.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from itertools import chain

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import fresh
from timeward.session import materialize

# Bound of the training sample, labelled URLs of either class.
PER_CLASS = 10_000
TREES, DEPTH = 20, 4


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, as in ``example.com/de/``; everything before the first slash is host."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and what follows the path. All are empty for a null and where ``://`` is lacking."""
    known = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.when(known, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    part = lambda k: F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)(.*)$", k)
    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2), part(3)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``size, text, verdict`` of the longest rule that fits, ties to the smaller text; else null.

    Looks each suffix of the host up in a map of the rules' hosts, so the work per URL doesn't
    depend on the number of rules.
    """
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    if not by_host:
        return F.lit(None).cast("struct<size:int,text:string,verdict:string>")
    entry = lambda r: F.struct(
        F.lit(-len(r.text)).alias("size"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path")
    )
    known = F.create_map(
        *chain.from_iterable((F.lit(h), F.array(*map(entry, found))) for h, found in by_host.items())
    )
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    hits = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull()))
    best = F.array_min(F.filter(hits, lambda r: F.startswith(path, r["path"])))
    return F.when(best.isNotNull(), F.struct((-best["size"]).alias("size"), best["text"].alias("text"), best["verdict"].alias("verdict")))


def _share(text: Column, found: str) -> Column:
    size = F.length(text)
    return F.when(size > 0, (size - F.length(F.translate(text, found, ""))) / size).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    letters = F.split(text, "")
    bits = F.aggregate(
        F.array_distinct(letters),
        F.lit(0.0),
        lambda total, c: total
        - F.when(c == "", 0.0).otherwise(
            (size - F.length(F.replace(text, c, F.lit("")))) / size
            * F.log2((size - F.length(F.replace(text, c, F.lit("")))) / size)
        ),
    )
    return F.when(size > 0, bits).otherwise(0.0)


LEXICAL = (
    "size", "host_size", "path_size", "rest_size", "depth", "labels", "digits", "host_digits", "dashes", "vowels",
    "entropy", "parameters", "percents", "first_segment", "has_extension", "secure", "suffix_block_rate", "suffix_seen",
)


def with_lexical(urls: DataFrame, url: str, out: str) -> DataFrame:
    """Adds a struct of host, path, suffix (last label of the host) and the lexical features of a URL."""
    held = fresh(urls, "url_parts")
    host, path, rest = split_url(F.col(url))
    step = urls.withColumn(held, F.struct(host.alias("host"), path.alias("path"), rest.alias("rest")))
    h, p, r = (F.col(f"{held}.{n}") for n in ("host", "path", "rest"))
    whole = F.concat(h, p, r)
    count = lambda text, found: F.length(text) - F.length(F.translate(text, found, ""))
    numbers = {
        "size": F.length(whole),
        "host_size": F.length(h),
        "path_size": F.length(p),
        "rest_size": F.length(r),
        "depth": count(p, "/"),
        "labels": F.size(F.split(h, r"\.")),
        "digits": _share(whole, string.digits),
        "host_digits": _share(h, string.digits),
        "dashes": count(h, "-"),
        "vowels": _share(h, "aeiou"),
        "entropy": _entropy(h),
        "parameters": count(r, "="),
        "percents": count(whole, "%"),
        # The first segment of a path as a number: sections such as /de/ or /shop/ of one site differ in kind.
        "first_segment": F.pmod(F.crc32(F.split_part(p, F.lit("/"), F.lit(2))), F.lit(32)),
        "has_extension": p.rlike(r"\.\w{2,5}$").cast("int"),
        "secure": F.coalesce(F.lower(F.left(F.col(url), F.lit(6))) == "https:", F.lit(False)).cast("int"),
    }
    made = F.struct(
        h.alias("host"),
        p.alias("path"),
        F.substring_index(h, ".", -1).alias("suffix"),
        *(c.cast("double").alias(n) for n, c in numbers.items()),
    )
    return step.withColumn(out, made).drop(held)


@dataclass(frozen=True)
class Trees:
    """The fitted trees, and per suffix how many sampled URLs it has and the share to block."""

    model: GBTClassificationModel | None
    suffixes: dict[str, tuple[float, float]]


def _assembled(rows: DataFrame, parts: str, suffixes: dict, out: str) -> DataFrame:
    """Adds the vector of features; names of helper columns are the caller's to keep apart."""
    get = lambda k: F.coalesce(
        F.try_element_at(
            F.create_map(*chain.from_iterable((F.lit(s), F.lit(float(v[k]))) for s, v in suffixes.items())),
            F.col(f"{parts}.suffix"),
        )
        if suffixes
        else F.lit(None).cast("double"),
        F.lit(0.5 if k else 0.0),
    )
    named = {n: fresh(rows, f"lexical_{n}") for n in LEXICAL}
    values = {n: F.col(f"{parts}.{n}") for n in LEXICAL[:-2]} | {"suffix_block_rate": get(1), "suffix_seen": get(0)}
    wide = rows.withColumns({named[n]: v for n, v in values.items()})
    return VectorAssembler(inputCols=list(named.values()), outputCol=out, handleInvalid="keep").transform(wide).drop(*named.values())


def train(labelled: DataFrame, per_class: int = PER_CLASS, most_suffixes: int = 500, seed: int = 11) -> Trees:
    """Fits the trees on ``url, label`` (1 block, 0 allow): at most ``per_class`` URLs of either label, in the order of
    a hash. With one label only, there are no trees and every URL is allowed, or blocked, like the sample.

    The suffixes' statistics come from the same sample, at most ``most_suffixes``, the commonest.
    """
    known = labelled.select("url", F.col("label").cast("double").alias("label")).where("url IS NOT NULL AND label IN (0, 1)")
    order = [F.xxhash64("url"), F.col("url")]
    picked = [known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    sample = materialize(with_lexical(picked[0].unionByName(picked[1]), "url", "parts"), "labelled_urls")
    counted = sample.groupBy("parts.suffix").agg(F.count("*").alias("n"), F.avg("label").alias("rate"))
    suffixes = {
        r["suffix"]: (float(r["n"]), r["rate"]) for r in counted.orderBy(F.desc("n"), "suffix").limit(most_suffixes).collect()
    }
    kinds = [r[0] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return Trees(None, {"": (0.0, kinds[0] if kinds else 0.0)})
    rows = _assembled(sample, "parts", suffixes, "features").select("features", "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.2, subsamplingRate=1.0, seed=seed)
    return Trees(trees.fit(materialize(rows.repartition(4, "features"), "url_features")), suffixes)


def judged(urls: DataFrame, rules: list[Rule], trees: Trees, url: str = "url", out: str = "judged") -> DataFrame:
    """Adds a struct ``host, path, rule, verdict``: ``block`` or ``allow``; ``rule`` is null where the trees decide.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by features of
    that emptiness. Repeated rows are judged alike. A column named ``out`` is replaced, all others stay.
    """
    parts, best, vector = fresh(urls, "parts"), fresh(urls, "best_rule"), fresh(urls, "features")
    rows = with_lexical(urls, url, parts)
    rows = rows.withColumn(best, matching_rule(F.col(f"{parts}.host"), F.col(f"{parts}.path"), rules))
    if trees.model is None:
        score, drop = F.lit(float(trees.suffixes[""][1])), []
    else:
        names = {n: fresh(rows, n) for n in ("raw", "probability", "prediction")}
        model = trees.model.copy()
        model.setFeaturesCol(vector).setRawPredictionCol(names["raw"])
        model.setProbabilityCol(names["probability"]).setPredictionCol(names["prediction"])
        rows = model.transform(_assembled(rows, parts, trees.suffixes, vector))
        # The prediction is 1 where the probability to block is above one half.
        score, drop = F.col(names["prediction"]), [vector, *names.values()]
    made = F.struct(
        F.col(f"{parts}.host").alias("host"),
        F.col(f"{parts}.path").alias("path"),
        F.col(f"{best}.text").alias("rule"),
        F.coalesce(F.col(f"{best}.verdict"), F.when(score > 0.5, "block").otherwise("allow")).alias("verdict"),
    )
    return rows.withColumn(out, made).drop(parts, best, *drop)


def rule_labels(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``url, label`` for the URLs that a rule decides: the labelled set where no other is at hand."""
    host, path, _ = split_url(F.col(url))
    found = urls.select(F.col(url).alias("url"), matching_rule(host, path, rules).alias("r")).where("r IS NOT NULL")
    return found.select("url", F.when(F.col("r.verdict") == "block", 1).otherwise(0).alias("label"))
