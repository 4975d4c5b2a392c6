"""Run registered queries against their SQL; usable as a script.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else f"{value:.9g}")
    if isinstance(value, int):
        return (2, f"{float(value):.9g}")
    return (3, str(value))


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    got_columns = frame.columns
    got = _rows(got_columns, frame.collect())
    cursor = connection.execute(sql)
    want_columns = [c[0] for c in cursor.description]
    want = _rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"first difference: {str(a)[:600]} != {str(b)[:600]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from reviewmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    if not os.environ.get("PLAIN_SESSION"):
        settings["spark.sql.shuffle.partitions"] = "8"
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sql:
                problem = differences(frame, connection, sql[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
