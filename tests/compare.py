"""Run registered queries beside their SQL and compare the rows.

``python tests/compare.py [sf] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return f"{value.isoformat()} 00:00:00"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def duck_rows(sf_dir, sql):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted_rows(columns, cursor.fetchall())


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, sf_dir, query, sql):
    """None when the rows agree, else a short description."""
    got_columns, got = spark_rows(query(spark, sf_dir))
    want_columns, want = duck_rows(sf_dir, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return f"{len(got)} rows against {len(want)}; first differences {pairs}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = f"/root/testdata/sf{args[0] if args else '0.01'}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = args[1:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in [n for n in queries if any(w in n for w in wanted)]:
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, sf_dir, queries[name], oracles[name])
            else:
                rows = queries[name](spark, sf_dir).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(wanted)} differ" if bad else "all agree")


if __name__ == "__main__":
    main()
