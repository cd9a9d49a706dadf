"""Compare registered queries with their SQL: python -m tests.check [sf_dir] [key ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, folder: str, name: str, build, sql: str) -> list[str]:
    """What differs between the two results; empty when they are equal."""
    df = build(spark, folder)
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(columns):
        return [f"{name}: columns {sorted(df.columns)} against {sorted(columns)}"]
    ours, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    only_ours, only_theirs = ours - theirs, theirs - ours
    if not only_ours and not only_theirs:
        return []
    return [
        f"{name}: {sum(ours.values())} rows against {sum(theirs.values())}",
        f"  {sorted(df.columns)}",
        *(f"  only in Spark: {r}" for r in list(only_ours)[:3]),
        *(f"  only in SQL:   {r}" for r in list(only_theirs)[:3]),
    ]


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import TEST_SETTINGS
    from tramline import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else DEFAULT_DIR
    spark = build_session("tramline-check", "local[8]", **TEST_SETTINGS)
    spark.sparkContext.setLogLevel("ERROR")
    for setting in os.environ.get("CHECK_CONF", "").split():
        spark.conf.set(*setting.split("=", 1))
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if name not in sql or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = differences(spark, con, folder, name, build, sql[name])
        except Exception as error:
            found = [f"{name}: {type(error).__name__} {str(error)[:1500]}"]
        failed += bool(found)
        print("\n".join(found) or f"{name}: equal", f"({time.time() - start:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
