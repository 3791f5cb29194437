"""Side-by-side comparison of the queries with their SQL in DuckDB.

    python tests/parity.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _order(value: object) -> tuple:
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "nan")
    if isinstance(value, (int, float)):
        return (2, float(value))
    return (3, str(value))


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: [_order(v) for v in r])


def sides(spark, db, query, sql: str, sf_dir: str) -> tuple[list[str], list, list[str], list]:
    """Columns and sorted rows of both engines, columns in name order."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = ordered([tuple(r) for r in df.select(*[df[f"`{c}`"] for c in names]).collect()])
    result = db.execute(sql)
    theirs_names = [c[0] for c in result.description]
    place = [theirs_names.index(c) for c in sorted(theirs_names)]
    theirs = ordered([tuple(r[i] for i in place) for r in result.fetchall()])
    return names, ours, sorted(theirs_names), theirs


def difference(names: list[str], ours: list, names2: list[str], theirs: list) -> str | None:
    if names != names2:
        return f"columns {names} != {names2}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"first difference:\n  spark {a}\n  sql   {b}"
        if [type(v) for v in a] != [type(v) for v in b]:
            return f"types {[type(v).__name__ for v in a]} != {[type(v).__name__ for v in b]}"
    return None


def main() -> None:
    from conftest import make_session

    import __spark_entry__ as entry

    sf_dir, *chosen = sys.argv[1:]
    spark, db = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in chosen or queries:
        start = time.time()
        if name not in oracles:
            rows = queries[name](spark, sf_dir).collect()
            print(f"{name:34} rows {len(rows)}  {time.time() - start:.1f}s")
            continue
        try:
            problem = difference(*sides(spark, db, queries[name], oracles[name], sf_dir))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        print(f"{name:34} {problem or 'equal'}  {time.time() - start:.1f}s", flush=True)


if __name__ == "__main__":
    main()
