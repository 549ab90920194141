"""Declared row-local columns, one definition for audits, training and scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.names import DAY_SECONDS, ID, TIME
from timeward.operators.lookups import with_dictionary


class DerivationError(Exception):
    """A declared column cannot be computed from the frame it was given."""


@dataclass(frozen=True)
class Derivation:
    name: str
    tool: str
    inputs: tuple[str, ...]
    params: Mapping[str, object] = field(default_factory=dict)

    def as_dict(self) -> dict:
        return {
            "name": self.name,
            "tool": self.tool,
            "inputs": list(self.inputs),
            "params": dict(self.params),
        }


def start_day(column: str, time: str = TIME, unit_seconds: int = DAY_SECONDS) -> Column:
    """The day a "days since" counter began."""
    return (F.floor(F.col(time) / F.lit(unit_seconds)) - F.col(column)).cast("double")


def level_indicator(column: str, level: str) -> Column:
    """1 for the level, 0 for any other value, NULL where the value is missing."""
    return (F.col(column).cast("string") == F.lit(level)).cast("tinyint")


def frequency_map(train: DataFrame, columns: Sequence[str], min_count: int = 2) -> DataFrame:
    """(``column``, ``value``, ``count``) over the training rows, for values seen often enough.

    All columns are counted in one pass; partial counts are merged before the shuffle.
    """
    texts = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        train.select(F.inline(texts))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") >= min_count)
    )


def frequency_summary(train: DataFrame, columns: Sequence[str], min_count: int = 2) -> DataFrame:
    """Per column: levels seen, levels kept, and the share of all rows the kept ones cover."""
    counts = frequency_map(train, columns, min_count=1)
    kept = F.col("count") >= min_count
    total = train.agg(F.count(F.lit(1)).alias("_rows"))
    return (
        counts.groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("levels_seen"),
            F.count_if(kept).alias("levels_kept"),
            F.coalesce(F.sum(F.when(kept, F.col("count"))), F.lit(0)).alias("_covered"),
        )
        .crossJoin(F.broadcast(total))  # one row
        .select(
            "column",
            "levels_seen",
            "levels_kept",
            F.round(F.col("_covered") / F.greatest(F.col("_rows"), F.lit(1)), 4).alias("coverage"),
        )
    )


def _add_start_day(frame: DataFrame, d: Derivation, maps: DataFrame | None) -> DataFrame:
    return frame.withColumn(
        d.name,
        start_day(
            d.inputs[0],
            str(d.params.get("time_column", TIME)),
            int(d.params.get("unit_seconds", DAY_SECONDS)),
        ),
    )


def _add_indicator(frame: DataFrame, d: Derivation, maps: DataFrame | None) -> DataFrame:
    return frame.withColumn(d.name, level_indicator(d.inputs[0], str(d.params["level"])))


def _add_frequency(frame: DataFrame, d: Derivation, maps: DataFrame | None) -> DataFrame:
    return _add_frequencies(frame, [d], maps)


def _add_frequencies(frame: DataFrame, declared: Sequence[Derivation], maps: DataFrame | None) -> DataFrame:
    """The training counts of the rows' values, from one map for all. Unseen and missing values both give NULL."""
    keys = {d.name: str(d.params.get("map_key", d.inputs[0])) for d in declared}
    if maps is None:
        raise DerivationError(f"{declared[0].name} needs a fitted frequency map for {keys[declared[0].name]!r}")
    probes = {d.name: (keys[d.name], F.col(d.inputs[0])) for d in declared}
    return with_dictionary(frame, maps, probes, "count", key=ID if ID in frame.columns else None)


TOOLS: dict[str, Callable[[DataFrame, Derivation, DataFrame | None], DataFrame]] = {
    "days_since_to_start_day": _add_start_day,
    "one_hot": _add_indicator,
    "frequency_encode": _add_frequency,
}


def fitted_keys(declared: Sequence[Derivation]) -> list[str]:
    return sorted(
        {str(d.params.get("map_key", d.inputs[0])) for d in declared if d.tool == "frequency_encode"}
    )


def apply_derivations(
    frame: DataFrame, declared: Sequence[Derivation], maps: DataFrame | None = None
) -> DataFrame:
    """Adds every declared column, in order, so a later one may read an earlier one.

    ``maps`` is the fitted (``column``, ``value``, ``count``) table. A derivation that cannot be
    computed raises; none is skipped.
    """
    waiting: list[Derivation] = []  # frequency encodings in a row, which one lookup serves
    for d in declared:
        if waiting and (d.tool != "frequency_encode" or {*d.inputs, d.name} & {w.name for w in waiting}):
            frame, waiting = _add_frequencies(frame, waiting, maps), []
        tool = TOOLS.get(d.tool)
        if tool is None:
            raise DerivationError(f"{d.name}: no tool named {d.tool!r}, have {sorted(TOOLS)}")
        if absent := [c for c in d.inputs if c not in frame.columns]:
            raise DerivationError(f"{d.name} needs {absent}, which the frame does not have")
        if d.tool == "frequency_encode":
            waiting.append(d)
        else:
            frame = tool(frame, d, maps)
    return _add_frequencies(frame, waiting, maps) if waiting else frame


def require_maps(maps: DataFrame, declared: Sequence[Derivation]) -> None:
    """Raises when a fitted derivation has no map; one small aggregate over the map table."""
    wanted = fitted_keys(declared)
    if not wanted:
        return
    # At most one row per wanted column comes back.
    have = {r["column"] for r in maps.where(F.col("column").isin(wanted)).select("column").distinct().collect()}
    if absent := [k for k in wanted if k not in have]:
        raise DerivationError(f"no frequency map for {absent}")
