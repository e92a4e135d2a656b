"""Compares every query with its SQL equivalent; `python tests/check_oracle.py [folder] [names...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from ledgerlane.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(folder: str, sql: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = [str(column[1]) for column in result.description]
    return names, types, result.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, folder: str, name: str) -> str:
    started = time.time()
    df = entry.queries()[name](spark, folder)
    mine = [tuple(row) for row in df.collect()]
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {name}: {len(mine)} rows, {seconds:.2f}s"
    names, types, theirs = oracle_rows(folder, sql)
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {name}: {sorted(set(names) ^ set(df.columns))}"
    left, right = normal(df.columns, mine), normal(names, theirs)
    if left != right:
        only = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"DIFFERENT {name}: {len(left)} vs {len(right)} rows\n  " + "\n  ".join(f"{a}\n  {b}" for a, b in only)
    kinds = dict(zip(names, types))
    return f"ok {name}: {len(left)} rows, {seconds:.2f}s  " + ", ".join(
        f"{c} {t}/{kinds[c]}" for c, t in df.dtypes
    )


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    session = local_session("check")
    failed = 0
    for query in chosen:
        try:
            line = compare(session, folder, query)
        except Exception as error:  # report and go on
            line = f"ERROR {query}: {str(error)[:1500]}"
        failed += not line.startswith(("ok", "rows-only"))
        print(line if not line.startswith("ok") else line[:110], flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    sys.exit(bool(failed))
