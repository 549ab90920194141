"""What a table holds, measured while it is written: no second pass over the rows proves the first."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ProofError(Exception):
    """A written table does not hold what was asked of it."""


@dataclass(frozen=True)
class Proof:
    """``keys`` is an order-free digest of the key column: equal for equal multisets of keys."""

    rows: int
    keys: str | None = None
    counts: Mapping[str, int] = field(default_factory=dict)

    @property
    def found(self) -> dict[str, int]:
        return {name: n for name, n in self.counts.items() if n}


def proved_write(
    df: DataFrame, path: str, *, key: str | None = None, counts: Mapping[str, Column] | None = None, out: list[Column] | None = None
) -> Proof:
    """Writes ``df`` (or the columns ``out`` of it) to ``path`` as Parquet and returns what was seen on the way.

    ``counts`` are conditions on the rows of ``df``; how often each holds is reported. Metrics travel with
    the tasks' results. The rows are checked against the footers of the written files, so that a metric
    lost or doubled by a retried task can't prove a table that is not there.
    """
    counts = dict(counts or {})
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("_rows")]
    if key is not None:
        metrics.append(F.sum(F.xxhash64(key).cast("decimal(38,0)")).cast("string").alias("_keys"))
    metrics += [F.count_if(condition).alias(f"_c{k}") for k, condition in enumerate(counts.values())]
    watched = df.observe(seen, *metrics)
    (watched.select(*out) if out else watched).write.mode("overwrite").parquet(path)
    got = seen.get
    rows = got.get("_rows", 0)
    written = df.sparkSession.read.parquet(path).count()
    if written != rows:
        raise ProofError(f"{path}: {rows} rows observed, {written} written")
    return Proof(rows, got.get("_keys"), {name: got.get(f"_c{k}", 0) for k, name in enumerate(counts)})


def require_same_keys(left: Proof, right: Proof, what: str) -> int:
    """Raises when two written tables differ in rows or keys."""
    if left.rows != right.rows:
        raise ProofError(f"{what}: {left.rows} rows against {right.rows}")
    if left.keys != right.keys:
        raise ProofError(f"{what}: as many rows, but other keys")
    return left.rows
