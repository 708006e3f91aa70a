"""Compare registered queries with their SQL: python tests/check_oracle.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when query and SQL agree, else what differs."""
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = sorted(map(repr, ([r[c] for c in columns] for r in got.collect())))
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    if sorted(names) != columns:
        return f"columns {columns} / {sorted(names)}"
    at = [names.index(c) for c in columns]
    expected = sorted(repr([r[i] for i in at]) for r in want.fetchall())
    if len(rows) != len(expected):
        return f"rows {len(rows)} / {len(expected)}"
    bad = [(a, b) for a, b in zip(rows, expected) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from tillstream.plans.queries import QUERIES
    from tillstream.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(session, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:30s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
        failed += [name] if problem else []
    print("failed:", failed or "none")
