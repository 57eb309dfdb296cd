"""Runs queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(item) for item in value]
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((repr([plain(row[n]) for n in names]) for row in df.collect()))


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, sorted(repr([plain(row[p]) for p in places]) for row in cursor.fetchall())


def difference(spark, con, folder, build, sql):
    names, left = spark_rows(build(spark, folder))
    check_names, right = duck_rows(con, sql)
    if names != check_names:
        return f"columns {names} and {check_names}"
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return f"{len(left)} and {len(right)} rows; only Spark {only_left}; only SQL {only_right}"
    return None


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from duewatch.catalog import CHECKS, QUERIES
    from duewatch.session import build_session
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN"):  # a session with none of our settings
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session = SparkSession.getActiveSession()
    session.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            if name in CHECKS:
                problem = difference(session, con, folder, QUERIES[name], CHECKS[name])
                rows = ""
            else:
                rows = f"{len(QUERIES[name](session, folder).collect())} rows, unchecked"
                problem = None
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:900]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {rows} {problem or ''}", flush=True)
    print(f"{failed} of {len(wanted)} failed")
