"""Quality rules: text statistics, and robust multivariate outliers among them.

The statistics of a document, on transformed scales, form a vector. Per language and source a minimum
covariance determinant estimate (Rousseeuw and Van Driessen, 1999) gives its usual place and spread:
from coordinate-wise medians and median deviations on, concentration steps keep the three quarters of the
vectors with the least Mahalanobis distance and take their mean and covariance anew. Documents far from
the estimate of their group go.

All of it is DataFrame expressions. Vectors are whole numbers (thousandths), so sums don't depend
on the order of rows. A concentration step is one aggregation to (group, bin of the distance), so
that a group of any size reaches no task whole; groups are small tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeward.llm.text import blank_less, fresh
from timeward.session import materialize

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent

SCALE = 1000
# Standard deviation that is added to each coordinate of an estimate: half a step on the
# logarithmic scale. It keeps a coordinate that is constant in a group from condemning any change.
FLOOR = 500
SHARE = 0.75
STEPS = 5
# A group gives its own estimate from so many documents on; smaller ones take their language's,
# and languages smaller than that the one of all documents.
LEAST_ROWS = 50  # ten for each dimension
# Chi-square with five degrees of freedom: its median, and the distance that one clean document in
# a hundred million exceeds.
CHI_MEDIAN = 4.351460
CUTOFF = 45.08
_BINS = 64  # per unit of distance
_LAST_BIN = _BINS * 1000

P = len(STATS)
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def with_stats(docs: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """Adds a struct of the five base statistics (longs) and ``base_failed`` for each whole text.

    A null or empty text has no words: all are 0 and the base fails. A column named ``out`` is
    replaced, all others stay.
    """
    stats = _let(F.coalesce(F.col(text), F.lit("")), _statistics)
    return docs.withColumn(out, stats).select(*(c for c in docs.columns if c.lower() != out.lower()), out)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _statistics(content: Column) -> Column:
    spaced = F.translate(content, "\t\n\x0b\f\r", " " * 5)
    lines = F.filter(F.split(content, "\n"), lambda line: blank_less(line) != "")
    return _let(
        F.array_remove(F.split(spaced, " "), ""),
        lambda words: _let(lines, lambda kept: _let(_repeated(words), lambda covered: _struct(content, words, kept, covered))),
    )


def _repeated(words: Column) -> Column:
    """Words in windows of three that stand in the text twice or more."""
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )

    def twice(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(r: Column) -> Column:
        reach = F.transform(r, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(r, k + 1) - at, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    found = _let(F.sort_array(hashed), lambda s: _let(twice(s), covered))
    return F.coalesce(F.when(F.size(words) >= 3, found), F.lit(0))


def _struct(content: Column, words: Column, lines: Column, covered: Column) -> Column:
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(blank_less(content)),
        "n_symbols": F.length(content) - F.length(F.translate(content, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
    }
    failed = (counts["n_words"] < LEAST_WORDS) | (
        100 * counts["n_repeat_words"].cast("bigint") > MOST_REPEATED * counts["n_words"]
    )
    return F.struct(*(c.cast("bigint").alias(n) for n, c in counts.items()), failed.alias("base_failed"))


# The coordinates, in expressions that mean the same in Spark and other engines.
# Each but the first reaches the cut-off alone, even where a group's spread is nothing but FLOOR: at 2.3 times the mean word's
# length, at 0.9 % of symbols, at a repeated line for every 8 words, at 31 % of repeated words. Length alone condemns no document
# of less than 4,000 times the usual one.
COORDINATES = (
    "0.4 * ln(n_words)",
    "4 * ln(word_chars / n_words)",
    "1.5 * ln(1 + 1000.0 * n_symbols / word_chars)",
    "1.25 * ln(1 + 100.0 * n_dup_lines / n_words)",
    "2.4 * ln(1 + 10.0 * n_repeat_words / n_words)",
)


def coordinates(stats: str) -> list[Column]:
    """Whole thousandths of the transformed statistics, of a document that passed the base."""
    named = []
    for k, text in enumerate(COORDINATES):
        for name in STATS:
            text = text.replace(name, f"{stats}.{name}")
        named.append(F.expr(f"CAST(round({SCALE} * {text}) AS BIGINT)").alias(f"x{k}"))
    return named


def _levels(lang: str, source: str) -> list[Column]:
    """Group keys of a row, finest first. JSON tells null from any text."""
    pair, own = F.struct(F.col(lang).alias("l"), F.col(source).alias("s")), F.struct(F.col(lang).alias("l"))
    return [F.concat(F.lit("0"), F.to_json(pair)), F.concat(F.lit("1"), F.to_json(own)), F.lit("2")]


def _inverse_root(cov: dict[tuple[int, int], str]) -> list[tuple[str, str]]:
    """Names and SQL of L (Cholesky) and of its inverse, each using those before it."""
    made = []
    for j in range(P):
        less = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        made.append((f"l{j}{j}", f"sqrt({cov[j, j]}{less})"))
        for i in range(j + 1, P):
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            made.append((f"l{i}{j}", f"({cov[i, j]}{less}) / l{j}{j}"))
    for j in range(P):
        made.append((f"w{j}{j}", f"1 / l{j}{j}"))
        for i in range(j + 1, P):
            total = " + ".join(f"l{i}{k} * w{k}{j}" for k in range(j, i))
            made.append((f"w{i}{j}", f"-({total}) / l{i}{i}"))
    return made


def squared_distance() -> str:
    """SQL of the squared Mahalanobis distance of x0.. from m0.. with the inverse root w00.."""
    rows = (" + ".join(f"w{i}{j} * (x{j} - m{j})" for j in range(i + 1)) for i in range(P))
    return " + ".join(f"({r}) * ({r})" for r in rows)


def distance_bin() -> str:
    return f"CAST(floor(least({_BINS} * sqrt({squared_distance()}), {_LAST_BIN})) AS BIGINT)"


_PARAMS = [f"m{j}" for j in range(P)] + [f"w{i}{j}" for i, j in _LOWER]


def _with_roots(moments: DataFrame) -> DataFrame:
    """From key, n, m0.., c00.. to key, n, m0.., w00.."""
    for name, text in _inverse_root({(i, j): f"c{i}{j}" for i, j in _LOWER}):
        moments = moments.withColumn(name, F.expr(text))
    return moments.select("key", "n", *_PARAMS)


def _running(by: list[str], along: str) -> Window:
    return Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, 0)


def _half(counts: DataFrame, value: str) -> DataFrame:
    """Lower median of ``value`` per key and axis; ``counts`` has one row per value."""
    by = ["key", "axis"]
    run = F.sum("n").over(_running(by, value))
    total = F.sum("n").over(Window.partitionBy(*by))
    marked = counts.withColumn("run", run).withColumn("total", total)
    return marked.where("2 * run >= total").groupBy(*by).agg(F.min(value).alias("middle"), F.max("total").alias("total"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median deviations as a first estimate with no correlation."""
    axes = F.explode(F.array(*(F.struct(F.lit(k).alias("axis"), F.col(f"x{k}").alias("value")) for k in range(P))))
    counts = materialize(
        rows.select("key", axes.alias("a")).groupBy("key", "a.axis", "a.value").agg(F.count("*").alias("n")),
        "values",
    )
    middle = materialize(_half(counts, "value"), "medians")
    off = (
        counts.join(middle.drop("total"), ["key", "axis"])
        .select("key", "axis", F.abs(F.col("value") - F.col("middle")).alias("off"), "n")
        .groupBy("key", "axis", "off")
        .agg(F.sum("n").alias("n"))
    )
    spread = _half(off, "off").select("key", "axis", F.col("middle").alias("mad"))
    both = middle.join(spread, ["key", "axis"])
    at = lambda c, k: F.max(F.when(F.col("axis") == k, F.col(c)))
    first = both.groupBy("key").agg(
        F.max("total").alias("n"),
        *(at("middle", k).cast("double").alias(f"m{k}") for k in range(P)),
        *(at("mad", k).cast("double").alias(f"d{k}") for k in range(P)),
    )
    variance = lambda k: f"2.1981 * d{k} * d{k} + {FLOOR * FLOOR}.0D"
    return _with_roots(
        first.select(
            "key", "n", *(f"m{k}" for k in range(P)),
            *(F.expr(variance(i) if i == j else "0.0D").alias(f"c{i}{j}") for i, j in _LOWER),
        )
    )


def _binned(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Counts, sums and products per key and bin of the distance, with running counts."""
    sums = [F.sum(f"x{k}").alias(f"s{k}") for k in range(P)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _LOWER]
    found = (
        rows.join(params.drop("n"), "key")
        .withColumn("bin", F.expr(distance_bin()))
        .groupBy("key", "bin")
        .agg(F.count("*").alias("n"), *sums, *products)
    )
    return found.withColumn("run", F.sum("n").over(_running(["key"], "bin"))).withColumn(
        "total", F.sum("n").over(Window.partitionBy("key"))
    )


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Mean and covariance of the share of rows nearest to the last estimate, whole bins."""
    near = _binned(rows, params).where(f"run - n < {SHARE} * total")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("double")
    total = near.groupBy("key").agg(
        F.max("total").alias("n"),
        F.sum("n").cast("double").alias("h"),
        *(wide(f"s{k}").alias(f"s{k}") for k in range(P)),
        *(wide(f"p{i}{j}").alias(f"p{i}{j}") for i, j in _LOWER),
    )
    ridge = lambda i, j: f" + {FLOOR * FLOOR}.0D" if i == j else ""
    return _with_roots(
        total.select(
            "key",
            "n",
            *((F.col(f"s{k}") / F.col("h")).alias(f"m{k}") for k in range(P)),
            *(F.expr(f"(p{i}{j} - s{i} * s{j} / h) / h{ridge(i, j)}").alias(f"c{i}{j}") for i, j in _LOWER),
        )
    )


def estimate(docs: DataFrame, stats: str = "stats", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source, per language, and for all: ``key, n``, place ``m0..``,
    inverse root ``w00..`` and ``factor``, which makes squared distances chi-square at the median.

    Documents that fail the base take no part. Null languages and sources are values of their own.
    """
    passed = docs.where(~F.col(f"{stats}.base_failed"))
    narrow = materialize(passed.select(F.array(*_levels(lang, source)).alias("keys"), *coordinates(stats)), "vectors")
    rows = narrow.withColumn("key", F.explode("keys")).drop("keys")
    params = materialize(_start(rows), "estimate")
    for _ in range(STEPS):
        params = materialize(_concentrate(rows, params), "estimate")
    bins = _binned(rows, params).where("2 * run >= total").groupBy("key").agg(F.min("bin").alias("bin"))
    middle = (F.col("bin") + F.lit(0.5)) / _BINS
    factor = F.greatest(middle * middle / CHI_MEDIAN, F.lit(1.0))
    return materialize(params.join(bins, "key").select("key", "n", *_PARAMS, factor.alias("factor")), "estimate")


def judge(
    docs: DataFrame, found: DataFrame, stats: str = "stats", lang: str = "lang", source: str = "source", out: str = "kept"
) -> DataFrame:
    """Adds ``out``: false if the base failed or the vector lies beyond CUTOFF of the finest
    estimate that rests on LEAST_ROWS documents (else on all). Nothing else changes."""
    names = {c: fresh(docs, f"mcd_{c}") for c in ("params", *(f"x{k}" for k in range(P)))}
    every = found.select("key", F.struct("n", "factor", *_PARAMS).alias("params"))
    joined, picks = docs, []
    for level, key in enumerate(_levels(lang, source)):
        side = every.where(F.col("key").startswith(str(level))).where(F.lit(level == 2) | (F.col("params.n") >= LEAST_ROWS))
        own, own_key = fresh(joined, f"mcd_level_{level}"), fresh(joined, f"mcd_key_{level}")
        side = side.select(F.col("key").alias(own_key), F.col("params").alias(own))
        joined = joined.join(side, key == F.col(own_key), "left").drop(own_key)
        picks.append(own)
    joined = joined.withColumn(names["params"], F.coalesce(*(F.col(p) for p in picks))).drop(*picks)
    text = squared_distance()
    for k in range(P):
        text = text.replace(f"x{k}", f"`{names[f'x{k}']}`")
    for p in _PARAMS:
        text = text.replace(p, f"`{names['params']}`.{p}")
    x = [F.when(~F.col(f"{stats}.base_failed"), c).alias(names[f"x{k}"]) for k, c in enumerate(_plain(stats))]
    joined = joined.select("*", *x)
    inside = F.expr(f"({text}) / `{names['params']}`.factor <= {CUTOFF}")
    verdict = ~F.col(f"{stats}.base_failed") & F.coalesce(inside, F.lit(True))
    return joined.withColumn(out, verdict).drop(*names.values())


def _plain(stats: str) -> list[Column]:
    """The coordinates, null for a document without words."""
    return [F.when(F.col(f"{stats}.n_words") > 0, c) for c in coordinates(stats)]


def with_verdict(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", stats: str = "stats", out: str = "kept",
    carry: list[str] | None = None,
) -> DataFrame:
    """Adds the statistics and the verdict to each document. ``carry`` names the columns to keep
    (default: all). No rows give no rows."""
    held = with_stats(docs, text, stats)
    if carry is not None:
        held = held.select(*dict.fromkeys([*carry, lang, source, stats]))
    held = materialize(held, "stats")
    return judge(held, estimate(held, stats, lang, source), stats, lang, source, out)


def chi_square_tail(x: float) -> float:
    """Share of a chi-square variable with five degrees of freedom beyond ``x``."""
    root = math.sqrt(x)
    return math.erfc(root / math.sqrt(2)) + math.sqrt(2 / math.pi) * math.exp(-x / 2) * (root + root**3 / 3)
