"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _multiset(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def _kinds(names, rows) -> dict[str, set[str]]:
    return {
        name: {type(row[i]).__name__ for row in rows if row[i] is not None}
        for i, name in enumerate(names)
    }


def differences(spark, con, query, sql: str, folder: str) -> list[str]:
    """Messages about anything that differs; empty when the results agree."""
    df = query(spark, folder)
    ours = [tuple(row) for row in df.collect()]
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = cursor.fetchall()
    found = []
    our_names, our_rows = _multiset(df.columns, ours)
    their_names, their_rows = _multiset(names, theirs)
    if our_names != their_names:
        return [f"columns {our_names} != {their_names}"]
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    extra, lacking = our_rows - their_rows, their_rows - our_rows
    if extra or lacking:
        found.append(f"only in Spark ({sum(extra.values())}): {list(extra)[:3]}")
        found.append(f"only in SQL ({sum(lacking.values())}): {list(lacking)[:3]}")
    kinds, other = _kinds(df.columns, ours), _kinds(names, theirs)
    found += [f"type of {n}: {kinds[n]} != {other[n]}" for n in kinds if kinds[n] != other[n]]
    return found


def main() -> int:
    import __spark_entry__ as registry
    from gaugeworks.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session("oracle-check")
    con = connect(folder)
    queries, sql = registry.queries(), registry.oracle_sql()
    failed = 0
    for key in chosen or queries:
        start = time.time()
        try:
            found = differences(spark, con, queries[key], sql[key], folder)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - start:.1f}s", flush=True)
        for message in found:
            print("     ", message, flush=True)
    print(f"{failed} of {len(chosen or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
