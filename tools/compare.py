"""Run named queries in Spark and their SQL twins in DuckDB and compare all rows.

Usage: python tools/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quern.plans.catalog import ENTRIES  # noqa: E402
from quern.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    """Comparable form of a cell; integers and doubles stay apart."""
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("f", value + 0.0)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, decimal.Decimal):
        return ("d", value.normalize())
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        [tuple(normal(row[i]) for i in order) for row in rows], key=str
    )


def difference(entry, spark, con, folder) -> str | None:
    """None when equal, else what differs."""
    return frame_difference(entry.run(spark, folder), entry, con)


def frame_difference(frame, entry, con) -> str | None:
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    if entry.sql is None:
        return None if got[1] else "no rows"
    relation = con.sql(entry.sql)
    want = table(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"columns {got[0]}\n   spark {a}\n   sql   {b}"
    return None


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(ENTRIES)
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(ENTRIES[name], spark, con, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if ENTRIES[name].sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s", flush=True)
        if problem:
            failed += 1
            print("   ", problem, flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
