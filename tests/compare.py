"""Runs registered queries on Spark and on DuckDB and compares rows, as `python tests/compare.py [sf] [names]`."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLE_NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plan(df, mode: str = "formatted") -> str:
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def counted(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(con, df, sql: str) -> str | None:
    """None if equal, else what differs. Types must agree as far as Python tells them apart."""
    spark_names, spark_rows = counted(df.columns, df.collect())
    result = con.execute(sql)
    duck_names, duck_rows = counted([d[0] for d in result.description], result.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} / {duck_names}"
    if spark_rows != duck_rows:
        only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
        return (
            f"rows {sum(spark_rows.values())} / {sum(duck_rows.values())}; only Spark {sum(only_spark.values())}: "
            f"{list(only_spark)[:2]}; only DuckDB {sum(only_duck.values())}: {list(only_duck)[:2]}"
        )
    kinds = [{type(v) for row in side for v in row if v is not None} for side in (spark_rows, duck_rows)]
    if kinds[0] != kinds[1]:
        return f"value types {kinds}"
    return None


def main() -> int:
    from dialoom.plans.oracle import ORACLE
    from dialoom.plans.queries import QUERIES
    from dialoom.session import build_session

    sf_dir = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(con, QUERIES[name](spark, sf_dir), ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
