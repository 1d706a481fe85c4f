"""Compare registered queries with their SQL on DuckDB: ``python tests/compare.py sf0.01 [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def duckdb_rows(folder: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session, clear_scratch

    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    if os.environ.get("PLAIN_SESSION"):  # Spark's defaults and a foreign time zone
        builder = SparkSession.builder.master("local[8]").config("spark.sql.session.timeZone", "America/Los_Angeles")
        for key, value in quiet.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session("compare", 8, "local[8]", **quiet)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/{sys.argv[1]}"
    oracle, wrong = oracle_sql(), 0
    for name, build in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            got = spark_rows(build(spark, folder))
        except Exception as error:  # report and go on with the next query
            print(f"{name:22s} ERROR {str(error)[:1500]}", flush=True)
            wrong += 1
            continue
        took = time.time() - start
        if name not in oracle:
            print(f"{name:22s} rows only {len(got[1])} {took:.2f}s", flush=True)
            continue
        start = time.time()
        try:
            want = duckdb_rows(folder, oracle[name])
        except Exception as error:
            print(f"{name:22s} ORACLE ERROR {str(error)[:800]}", flush=True)
            wrong += 1
            continue
        same = got == want
        wrong += not same
        print(f"{name:22s} {'ok  ' if same else 'DIFF'} {len(got[1]):7d} {len(want[1]):7d} {took:6.2f}s {time.time() - start:6.2f}s", flush=True)
        if not same:
            print("   columns", got[0], want[0])
            diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
            for a, b in diff:
                print("   spark ", str(a)[:400])
                print("   duckdb", str(b)[:400])
    clear_scratch(spark)
    print("wrong:", wrong)
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
