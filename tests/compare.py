"""Run registered queries next to their SQL.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=_sort_key
    )


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def differences(name, query, spark, con, sf_dir) -> str | None:
    """None when Spark and SQL agree, else what differs."""
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return None if got else "no rows"
    result = con.sql(query.sql)
    kinds = dict(zip(result.columns, map(str, result.types), strict=True))
    for column, kind in df.dtypes:
        if column in kinds and SPARK_TO_DUCK.get(kind) != kinds[column]:
            return f"type of {column}: {kind} against {kinds[column]}"
    want_names, want = rows_of(result.columns, result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    if not got:
        return "both empty"
    for a, b in zip(got, want, strict=True):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(got_names, a, b, strict=True) if x != y]
            return f"cells {cells[:4]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--module", default="")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from pyspark.sql import SparkSession

    from marlstone.catalog import all_queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = ran = 0
    for name, query in all_queries().items():
        if args.module and args.module not in query.build.__module__:
            continue
        if args.names and not any(n in name for n in args.names):
            continue
        ran += 1
        start = time.time()
        try:
            problem = differences(name, query, spark, con, args.sf)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "rows" if query.sql is None else "sql"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {ran} failing")
    spark.stop()
    return bad if ran else 1


if __name__ == "__main__":
    sys.exit(main())
