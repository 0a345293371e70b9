"""Run queries against their SQL on one scale factor: ``python -m workload.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from gaugeloom.session import local_session
from workload.oracle import ORACLE
from workload.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    return 0.0 if isinstance(value, float) and value == 0 else value


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = Counter(tuple(normal(v) for v in r) for r in got.select(*columns).collect())
    want = con.sql(ORACLE[name])
    if sorted(want.columns) != columns:
        return f"columns {columns} vs {sorted(want.columns)}"
    expected = Counter(
        tuple(normal(v) for v in r) for r in want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    )
    if rows == expected:
        return None
    more, less = rows - expected, expected - rows
    return (
        f"rows {sum(rows.values())} vs {sum(expected.values())}, "
        f"{sum(more.values())} only here {list(more)[:2]}, {sum(less.values())} only there {list(less)[:2]} {columns}"
    )


def main(sf_dir: str, *names: str) -> None:
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")


if __name__ == "__main__":
    main(*sys.argv[1:])
