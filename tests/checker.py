"""Run a registered query and its SQL twin and compare them, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

# How a Spark column type reads on the other side.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain_rows = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(plain_rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, folder, con, fn, sql):
    """None when equal, else a description of the first difference."""
    df = fn(spark, folder)
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    other = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if TYPES.get(kind) != other[name]:
            return f"type of {name}: {kind} != {other[name]}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(df.columns)}: {a} != {b}"
    if not ours:
        return "both sides are empty"
    return None


def session(cpus="8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    folder = sys.argv[1]
    names = sys.argv[2:]
    spark, con = session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            if name in oracles:
                problem = compare(spark, folder, con, fn, oracles[name])
                label = "ok"
            else:
                problem, label = None, f"rows-only {fn(spark, folder).count()}"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - begin:6.2f}s {name}: {problem or label}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
