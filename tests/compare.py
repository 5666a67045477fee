"""Runs registered queries against their SQL: python tests/compare.py [sf] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as driver
from tripflow.session import local_session

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def comparable(rows) -> list[str]:
    def text(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 9))
        return f"{type(value).__name__}:{value}"

    return sorted(str([text(value) for value in row]) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = driver.queries()[name](spark, sf_dir)
    mine = [tuple(row) for row in frame.collect()]
    cursor = con.execute(driver.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return f"columns {frame.columns} against {columns}"
    order = [columns.index(column) for column in frame.columns]
    left, right = comparable(mine), comparable([[row[i] for i in order] for row in theirs])
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
        return f"{len(pairs)} of {len(left)} rows differ, first {pairs[0]}"
    return None if mine else "no rows"


if __name__ == "__main__":
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    session, connection = local_session("compare", "8"), connect(folder)
    session.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for query in sys.argv[2:] or driver.queries():
        if query not in driver.oracle_sql():
            print(f"{query:24s} no SQL")
            continue
        started = time.time()
        try:
            problem = difference(session, connection, query, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None
        print(f"{query:24s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("all equal" if not wrong else f"{wrong} differ")
    sys.exit(bool(wrong))
