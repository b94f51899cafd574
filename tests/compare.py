"""Compare registered queries with their SQL, run by DuckDB on the same files.

    python -m tests.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SPARK_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def differences(spark, con, name, query, sql, sf_dir) -> list[str]:
    """What differs between a query and its SQL; empty when names, types and rows agree."""
    frame = query(spark, sf_dir)
    got_names, got = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_names, want = _sorted_rows(list(kinds), result.fetchall())
    found = []
    if got_names != want_names:
        found.append(f"{name}: columns {got_names} != {want_names}")
    for column, kind in frame.dtypes:
        if SPARK_KINDS.get(kind, kind) != kinds.get(column):
            found.append(f"{name}: type of {column}: {kind} != {kinds.get(column)}")
    if len(got) != len(want):
        found.append(f"{name}: {len(got)} rows != {len(want)}")
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        found.append(f"{name}: columns {got_names}; only in Spark {extra}; only in SQL {missing}")
    if not want:
        found.append(f"{name}: no rows")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from checks import ORACLES, QUERIES
    from chartloom.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            if name in ORACLES:
                found = differences(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                found = [] if QUERIES[name](spark, sf_dir).count() else [f"{name}: no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{name}: {type(error).__name__}: {str(error)[:1200]}"]
        failed += bool(found)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {name} [{kind}] {time.time() - started:.2f}s", flush=True)
        for line in found:
            print("    ", line[:1500], flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
