"""Run every registered query next to its SQL and compare the rows.

    python tests/compare.py [scale folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What tells the two results apart; None if nothing does."""
    ours = entry.queries()[name](spark, sf_dir)
    rows = ours.collect()
    if name not in entry.oracle_sql():
        return None if rows else "no rows"
    sql = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    if sorted(names) != sorted(ours.columns):
        return f"columns {sorted(ours.columns)} against {sorted(names)}"
    order = sorted(names)
    left = Counter(tuple(r[c] for c in order) for r in rows)
    picks = [names.index(c) for c in order]
    right = Counter(tuple(r[i] for i in picks) for r in sql.fetchall())
    if left != right:
        ours_only, sql_only = (list(d.items())[:2] for d in (left - right, right - left))
        return f"{len(rows)} rows against {sum(right.values())}; ours {ours_only}, SQL {sql_only}"
    return None if rows else "no rows"


def main(argv: list[str]) -> int:
    from tests.conftest import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or entry.queries():
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
