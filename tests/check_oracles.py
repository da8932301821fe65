"""Run every registered query next to its SQL: ``python tests/check_oracles.py [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    """Rows with columns by name, exact values, order not counting."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty when both give the same columns and rows."""
    frame = query(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    result = connect(sf_dir).execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"{name}: columns {sorted(frame.columns)} are not {sorted(names)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, not {len(want)}"
    pairs = zip(canonical(got, frame.columns), canonical(want, names))
    return next((f"{name}: {g} is not {w}" for g, w in pairs if g != w), "")


def main() -> None:
    from conftest import session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = session()
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        if name not in oracles:
            print(f"     {name} has no SQL", flush=True)
            continue
        start = time.time()
        try:
            problem = compare(spark, sf_dir, name, query, oracles[name])
        except Exception as error:
            problem = f"{name}: {str(error)[:1500]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
