"""Run the named queries beside their SQL in DuckDB and compare every value.

``python tests/check_oracles.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallymill.plans.catalog import ORACLES, QUERIES  # noqa: E402
from tallymill.sources.tables import TABLES  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return repr(value) if isinstance(value, (int, float)) else str(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty text when equal, else what differs."""
    df = QUERIES[name](spark, folder)
    got = df.collect()
    if name not in ORACLES:
        return "" if got else "no rows"
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    wide = [d[0] for d in cur.description if str(d[1]) in ("HUGEINT", "UHUGEINT")]
    want = cur.fetchall()
    if wide:
        return f"SQL columns {wide} are 128-bit; cast them"
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    a, b = _bag(df.columns, got), _bag(cols, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main(argv):
    from tallymill.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in argv[1:] or list(QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
