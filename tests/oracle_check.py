"""Runs registered queries next to their SQL and compares the results.

Usage: python tests/oracle_check.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def differences(spark, con, query, sql: str, folder: str) -> list[str]:
    """What differs between a query and its SQL; an empty list if nothing does."""
    frame = query(spark, folder)
    columns, mine = sorted_rows(frame.columns, frame.collect())
    result = con.execute(sql)
    names, theirs = sorted_rows([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return [f"columns {columns} against {names}"]
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows against {len(theirs)}"]
    if not mine:
        return ["no rows on either side"]
    return [f"{a} against {b}" for a, b in zip(mine, theirs) if a != b][:3]


def main() -> int:
    import __spark_entry__ as entry
    from panelyard.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in sqls:
            continue
        start = time.time()
        try:
            found = differences(spark, con, query, sqls[name], folder)
        except Exception as error:  # noqa: BLE001 - reported per query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{name:28} {time.time() - start:6.2f} s  {'OK' if not found else found}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
