"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, normalised. The exponent is
bisected: the largest one whose weights reach a target entropy, unless the passes over a small
source would then exceed the repetition limit; in that case the least one that meets the limit. The weights
become a token budget per source. A source's documents are dealt into blocks by a hash; every pass
over the source goes through its blocks in an order of its own, and the last pass ends where the
budget does. So a document's number of copies follows from its block and one number per source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeward.llm.text import fresh
from timeward.session import materialize

BLOCKS = 4096
GRID = 65536  # steps of the exponent between 0 (all sources alike) and 1 (shares as they are)


@dataclass(frozen=True)
class Mix:
    """Goals of a mixture. ``entropy`` is a share of the largest possible one, ln(sources).
    ``budget`` is in tokens; None means the least at which no source is passed over less than once,
    so that every document stays."""

    entropy: float = 0.97
    most_passes: float = 2.0
    budget: int | None = None
    seed: int = 17
    blocks: int = BLOCKS


def words(text: Column) -> Column:
    """Tokens as white-space separated words; a null text has none.

    Byte-wise replacements and lengths only; a regular expression just for texts with runs of blanks.
    """
    spaced = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\f\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    trimmed = F.trim(spaced)
    single = F.when(trimmed.contains("  "), F.regexp_replace(trimmed, " +", " ")).otherwise(trimmed)
    blanks = F.octet_length(single) - F.octet_length(F.replace(single, F.lit(" "), F.lit("")))
    return F.when(trimmed == "", 0).otherwise(blanks + 1).cast("bigint")


def _hash(*parts) -> Column:
    """60 bits of an MD5, alike in every engine."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _powers(totals: DataFrame, steps: list[int], largest: float) -> list[tuple[float, float, float]]:
    """Per exponent step / GRID: sums of s^a and of s^a ln s, and the least s^(a-1), with s the
    source's tokens as a share of the largest source's."""
    s = F.col("tokens") / F.lit(largest)
    columns = []
    for k in steps:
        a = F.lit(k / GRID)
        columns += [
            F.sum(F.pow(s, a)),
            F.sum(F.pow(s, a) * F.ln(s)),
            F.max(F.pow(s, a - 1)),
        ]
    row = totals.agg(*columns).first()
    return [tuple(row[3 * i : 3 * i + 3]) for i in range(len(steps))]


def _enough_entropy(sums: tuple, k: int, sources: int, goal: float) -> bool:
    import math

    z, weighted, _ = sums
    # Entropy of w = s^a / z: ln z - a / z * sum(s^a ln s)
    return math.log(z) - (k / GRID) * weighted / z >= goal * math.log(sources)


def _search(totals: DataFrame, largest: float, test, low: int, high: int) -> int:
    """Largest step in [low, high] that passes ``test``, which holds up to some step and no
    further, or ``low``. Sixteen points a job instead of one cut the rounds to a quarter."""
    while high > low:
        width = high - low
        steps = sorted({low + max(1, width * i // 16) for i in range(1, 17)})
        good = [test(found, k) for k, found in zip(steps, _powers(totals, steps, largest))]
        passed = [k for k, ok in zip(steps, good) if ok]
        failed = [k for k, ok in zip(steps, good) if not ok]
        low = max(passed, default=low)
        high = min(failed, default=high + 1) - 1
    return low


def exponent(totals: DataFrame, mix: Mix) -> int:
    """Step of the exponent, out of GRID, for ``totals`` (``source, tokens``, all above zero)."""
    sources, largest = totals.agg(F.count("*"), F.max("tokens").cast("double")).first()
    if not sources or sources == 1:
        return GRID
    by_entropy = _search(
        totals, largest, lambda found, k: _enough_entropy(found, k, sources, mix.entropy), 0, GRID
    )
    # Passes fall as the exponent rises: search for the last step that breaks the limit.
    breaks = _search(totals, largest, lambda found, k: found[2] > mix.most_passes, -1, GRID)
    return max(by_entropy, breaks + 1)


def _sized(docs: DataFrame, size: Column, mix: Mix, names: dict[str, str]) -> DataFrame:
    key = F.coalesce(F.col("source"), F.lit(""))
    known = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.lit("1"))
    block = F.pmod(_hash(F.lit(f"{mix.seed}"), F.col("doc_id").cast("string")), F.lit(mix.blocks))
    return docs.withColumns({names["size"]: size, names["key"]: F.concat(known, key), names["block"]: block.cast("int")})


def _turn(mix: Mix, source: Column, number: Column, block: Column) -> Column:
    """Place of a block in the order of one pass over its source."""
    return _hash(F.lit(f"{mix.seed}"), source, number.cast("string"), block.cast("string"))


def budgets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """From ``source, block, tokens`` to one row per source: ``source, tokens, weight, budget, passes``
    (whole ones) and ``cut``: blocks up to this place in the order of the pass after those are in.

    The last block is the one that reaches the budget; at most its own size lies beyond it. Sources
    without tokens get one pass and no budget.
    """
    blocks = materialize(sizes.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    every = materialize(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    totals = every.where("tokens > 0")
    step = exponent(totals, mix)
    largest = totals.agg(F.max("tokens").cast("double")).first()[0] or 1.0
    s = F.col("tokens") / F.lit(largest)
    z = totals.agg(F.sum(F.pow(s, F.lit(step / GRID)))).first()[0] or 1.0
    weight = F.pow(s, F.lit(step / GRID)) / F.lit(z)
    # With the least budget at which all are passed over once, the largest source is passed once exactly.
    total = F.lit(float(mix.budget)) if mix.budget is not None else F.lit(largest * z)
    planned = totals.select(
        "source", "tokens", weight.alias("weight"), F.round(weight * total).cast("bigint").alias("budget")
    ).withColumn("passes", F.expr("budget div tokens").cast("int"))
    left = planned.select("source", "passes", (F.col("budget") - F.col("passes") * F.col("tokens")).alias("left"))
    placed = blocks.join(left.where("left > 0"), "source").withColumn(
        "place", _turn(mix, F.col("source"), F.col("passes"), F.col("block"))
    )
    before = F.coalesce(
        F.sum("tokens").over(
            Window.partitionBy("source").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    cuts = placed.withColumn("before", before).where("before < left").groupBy("source").agg(F.max("place").alias("cut"))
    empty = every.where("tokens = 0").select(
        "source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("budget"), F.lit(1).alias("passes")
    )
    return (
        planned.unionByName(empty)
        .join(cuts, "source", "left")
        .select("source", "tokens", "weight", "budget", "passes", F.coalesce("cut", F.lit(-1)).cast("bigint").alias("cut"))
    )


def mixed(docs: DataFrame, mix: Mix = Mix(), size: Column | None = None) -> DataFrame:
    """The rows of ``docs`` (``doc_id, source, text``) as often as the mixture wants them.

    Adds ``mix_tokens, mix_pass`` (from 0), ``mix_block`` and ``mix_place``: sorted by pass and
    place, the rows of a source come as one permutation of its blocks after another. Columns of those
    names are replaced, all others stay. A null source is a source of its own; a null id is dealt
    like an empty one. Repeated rows and texts without words are rows like any other. No rows give
    no rows. ``size`` counts the tokens of a row (default: words of ``text``).
    """
    made = ("mix_tokens", "mix_pass", "mix_block", "mix_place")
    own = [c for c in docs.columns if c.lower() not in made]
    docs = docs.select(*own)
    names = {n: fresh(docs, f"mix_{n}") for n in ("size", "key", "block", "passes", "cut")}
    sized = _sized(docs, words(F.col("text")) if size is None else size, mix, names)
    keys = [F.col(names["key"]).alias("source"), F.col(names["block"]).alias("block"), F.col(names["size"]).alias("tokens")]
    plan = materialize(budgets(sized.select(*keys), mix), "budgets")
    side = plan.select(
        F.col("source").alias(names["key"]), F.col("passes").alias(names["passes"]), F.col("cut").alias(names["cut"])
    )
    joined = sized.join(side, names["key"])
    passes, cut = F.col(names["passes"]), F.col(names["cut"])
    block, key = F.col(names["block"]), F.col(names["key"])
    last = F.when(_turn(mix, key, passes, block) <= cut, 1).otherwise(0)
    copies = passes + last
    rows = joined.where(copies > 0).select(
        *own,
        F.col(names["size"]).alias("mix_tokens"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("mix_pass"),
        block.alias("mix_block"),
        key.alias(names["key"]),
    )
    return rows.withColumn("mix_place", _turn(mix, key, F.col("mix_pass"), F.col("mix_block"))).drop(names["key"])
