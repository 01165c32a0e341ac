"""Runs registered queries against their SQL twins and prints what differs.

    python -m parity.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from matchlake.session import build_session
from parity.oracle import ORACLE
from parity.registry import QUERIES


def _plain(value: object) -> object:
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> str | None:
    """None if the query's DataFrame and its twin agree on columns and rows."""
    columns, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return None
    cursor = con.execute(ORACLE[name])
    want_columns, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if rows != want:
        extra, lost = sorted(set(rows) - set(want))[:3], sorted(set(want) - set(rows))[:3]
        return f"{len(rows)} rows vs {len(want)}; only Spark: {extra}; only SQL: {lost}"
    return None


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = build_session("parity", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": os.environ.get("PARITY_TZ", "UTC"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, name)
        except Exception as failure:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
