"""Compare the queries with their SQL: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in map(tuple, rows)), key=repr)


# DuckDB type name of a Spark type name
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark_df, con, sql, allow_empty: bool = False) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(names)}"
    wrong = [
        f"{n}: {t} / {types[n]}" for n, t in spark_df.dtypes if TYPES.get(t, t) != types[n]
    ]
    expected = rows_of(names, result.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    if not got and not allow_empty:
        return "no rows"
    different = [(a, b) for a, b in zip(got, expected) if a != b]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first {different[0]}"
    return f"types {wrong}" if wrong else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from roadlog.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", "8g", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            outcome = compare(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        failed = outcome is not None and not outcome.startswith("rows only")
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - start:.2f}s {outcome or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
