"""Runs registered queries on Spark and their statements on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(int(value)) if value == value.to_integral_value() else str(value.normalize())
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return str(int(value)) if value == int(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def compare(spark, connection, folder, name, run, sql):
    started = time.time()
    df = run(spark, folder)
    rows = df.collect()
    spent = time.time() - started
    columns, ours = bag(df.columns, rows)
    if sql is None:
        return len(ours), spent, None
    cursor = connection.execute(sql)
    theirs_columns, theirs = bag([d[0] for d in cursor.description], cursor.fetchall())
    if columns != theirs_columns:
        return len(ours), spent, f"columns {columns} != {theirs_columns}"
    if ours != theirs:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        return len(ours), spent, f"{len(ours)} != {len(theirs)} rows; ours {sorted(a)[:2]} theirs {sorted(b)[:2]}"
    return len(ours), spent, None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.log.level", "ERROR").getOrCreate()
    )
    connection, sqls, bad, total = connect(folder), entry.oracle_sql(), 0, 0.0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            count, spent, problem = compare(spark, connection, folder, name, run, sqls.get(name))
        except Exception as failure:
            count, spent, problem = -1, 0.0, f"{type(failure).__name__}: {str(failure)[:700]}"
        total += spent
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name} rows={count} {spent:.2f}s {problem or ''}"[:1500], flush=True)
    print(f"bad={bad} total={total:.1f}s")
