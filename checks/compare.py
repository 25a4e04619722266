"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name prefix ..]``."""

from __future__ import annotations

import sys
import time

import duckdb

from tianguis.session import local_session

from . import operators  # noqa: F401  (registers its queries and those of ingest)
from .oracles import SQL
from .queries import QUERIES
from .tables import GIVEN


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both engines agree in columns and rows, else the first difference."""
    df = QUERIES[name](spark, sf_dir)
    found = canonical(df.columns, [tuple(r.values()) for r in df.toArrow().to_pylist()])
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = canonical(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"\n  found    {a}\n  expected {b}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = [n for n in QUERIES if n in SQL and (len(sys.argv) < 3 or n.startswith(tuple(sys.argv[2:])))]
    spark, con, bad = local_session(8), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as exc:  # keep going: one report for all queries
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
