"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, rows_of(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, rows_of(df.columns, df.collect())


def compare(spark, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    from tickflow.plans.oracle import ORACLE_SQL
    from tickflow.plans.queries import QUERIES
    expected_columns, expected = oracle_rows(sf_dir, ORACLE_SQL[name])
    columns, got = spark_rows(QUERIES[name](spark, sf_dir))
    if sorted(columns) != sorted(expected_columns):
        return f"columns {columns} / {expected_columns}"
    if len(got) != len(expected):
        return f"rows {len(got)} / {len(expected)}"
    if got != expected:
        odd = [(g, e) for g, e in zip(got, expected) if g != e]
        return f"{len(odd)} rows differ, first {odd[0]}"
    return None


def main():
    from pyspark.sql import SparkSession
    from tickflow.plans.queries import QUERIES
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args[1:] or QUERIES:
        start = time.time()
        problem = compare(spark, name, sf_dir)
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
