"""Run registered queries next to their SQL and compare rows, columns and values.

    python tests/check.py [data folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from haulmark.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    """Type and value, so that 1, 1.0 and Decimal('1') differ."""
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None)
    return f"{type(value).__name__}:{value!r}"


def compare(frame, con, sql: str) -> str:
    columns = sorted(frame.columns)
    actual = sorted(
        tuple(canonical(v) for v in row) for row in frame.select(*columns).collect()
    )
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(name) for name in columns]
    expected = sorted(tuple(canonical(row[i]) for i in order) for row in result.fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for left, right in zip(actual, expected, strict=True):
        if left != right:
            diff = [
                f"{c}: {a} != {b}" for c, a, b in zip(columns, left, right, strict=True) if a != b
            ]
            return f"values differ: {diff[:4]}"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = function(spark, sf_dir)
            if name in oracles:
                problem = compare(frame, con, oracles[name])
                verdict = "ok" if not problem else f"FAIL {problem}"
            else:
                verdict, problem = f"rows {frame.count()}", ""
        except Exception as error:  # noqa: BLE001 -- report every query
            problem = verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:26s} {time.time() - start:7.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))
