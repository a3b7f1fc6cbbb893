"""Compare registered queries with their SQL: ``oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tenurecast.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows: list[tuple], order: list[int]) -> list[tuple]:
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty if rows, column names and values agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    common = sorted(names)
    left = canonical(got, [df.columns.index(c) for c in common])
    right = canonical(want, [names.index(c) for c in common])
    for a, b in zip(left, right):
        if a != b:
            pairs = [(c, x, y) for c, x, y in zip(common, a, b) if x != y]
            return f"values differ: {pairs[:4]}"
    return ""


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    con = connect(sf_dir)
    failed = 0
    for name in wanted or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = compare(spark, con, name, sf_dir)
                verdict = problem or "match"
            else:
                problem = ""
                verdict = f"{entry.queries()[name](spark, sf_dir).count()} rows, no SQL"
        except Exception as e:  # report and go on with the next query
            problem = verdict = f"{type(e).__name__}: {str(e)[:300]}"
        failed += bool(problem)
        print(f"{name:24} {time.time() - start:7.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
