"""Run a query in Spark and its SQL in DuckDB, and compare the rows as multisets."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, run, sql: str | None, root: str) -> str:
    """Empty text if equal, else what differs."""
    df = run(spark, root)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    a, b = multiset(df.columns, got), multiset(columns, want)
    if a != b:
        return f"{len(got)} rows, wanted {len(want)}; only here {list((a - b))[:3]}; missing {list((b - a))[:3]}"
    return "" if got else "both empty"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    root = sys.argv[1]
    only = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(root), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, run, sql.get(name), root)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:32s} {time.time() - start:6.2f}s {problem}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
