"""Runs registered queries next to their SQL on DuckDB and compares every value.

    python -m tests.oracle [--sf sf0.01] [name-part ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(value) + 0.0
    if type(value).__name__ == "Decimal":
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    return value


def _family(kind: str) -> str:
    kind = kind.lower()
    if kind in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"):
        return "int"
    if kind.startswith("decimal") or kind in ("double", "float", "real"):
        return "float"
    return {"varchar": "string"}.get(kind, kind)


def compare(df, con, sql: str, *, exact: bool = True) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when they agree."""
    names = sorted(df.columns)
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if names != sorted(described):
        return [f"columns {names} against {sorted(described)}"]
    problems = [
        f"type of {n}: {t} against {described[n]}"
        for n, t in df.dtypes
        if _family(t) != _family(described[n])
    ]
    mine = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    order = list(described)
    theirs = [
        tuple(_plain(r[order.index(n)]) for n in names) for r in con.execute(sql).fetchall()
    ]
    if len(mine) != len(theirs):
        return problems + [f"{len(mine)} rows against {len(theirs)}"]
    key = lambda row: tuple((v is None, str(type(v)) if v is None else "", _rank(v)) for v in row)
    mine.sort(key=key)
    theirs.sort(key=key)
    wrong = [
        (a, b)
        for a, b in zip(mine, theirs)
        if not all(_same(x, y, exact) for x, y in zip(a, b))
    ]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if not _same(x, y, exact)]
        problems.append(f"{len(wrong)} of {len(mine)} rows differ, e.g. {cells[:4]} in {a[:6]}")
    return problems


def _rank(value):
    if value is None:
        return ""
    if isinstance(value, (int, float)):
        return f"{float(value):030.6f}"
    return str(value)


def _same(x, y, exact: bool) -> bool:
    if x is None or y is None:
        return x is y
    if isinstance(x, float) or isinstance(y, float):
        return x == y or (not exact and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))
    return x == y


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as entry
    from timeward.session import build_session

    spark = build_session("oracle", 8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/{args.sf}"
    con = connect(folder)
    sqls = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if args.names and not any(part in name for part in args.names):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                problems = compare(df, con, sqls[name])
                note = ""
            else:
                problems, note = [], f" rows={df.count()} {df.columns[:6]}"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:700]}"], ""
        failed += bool(problems)
        state = "FAIL" if problems else ("ok  " if name in sqls else "rows")
        print(f"{state} {name} {time.time() - start:.1f}s{note}", flush=True)
        for p in problems:
            print("     ", p[:900], flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
