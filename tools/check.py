"""Compare registered queries with their SQL twins in DuckDB.

    python tools/check.py [sf folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docsift.registry import ORACLES, QUERIES  # noqa: E402
from docsift.session import get_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool | None, str]:
    """(equal, note); equal is None when the query has no SQL twin."""
    df = QUERIES[name](spark, sf_dir)
    got = normal(df.columns, df.collect())
    if name not in ORACLES:
        return None, f"{len(got)} rows"
    answer = con.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    want = normal(columns, answer.fetchall())
    if got == want:
        return True, f"{len(got)} rows"
    gaps = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return False, f"{len(got)} rows against {len(want)}; first gaps {str(gaps)[:1500]}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session(
        "docsift-check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            equal, note = compare(spark, con, sf_dir, name)
        except Exception as error:
            equal, note = False, f"{type(error).__name__}: {str(error)[:1200]}"
        mark = {True: "ok  ", False: "BAD ", None: "rows"}[equal]
        bad += equal is False
        print(f"{mark} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
