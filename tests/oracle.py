"""Compare registered queries with their SQL in DuckDB: python tests/oracle.py [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, list):
        return tuple(cell(x) for x in v)
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, folder, name):
    """(problems, number of rows)"""
    df = entry.queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [], len(rows)
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"], len(rows)
    for c, t in df.dtypes:
        if SAME.get(t, types[c]) != types[c]:
            problems.append(f"type of {c}: {t} != {types[c]}")
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} != {len(expected)}")
    ours, theirs = bag(df.columns, rows), bag(columns, expected)
    if ours != theirs:
        names = sorted(columns)
        problems.append(f"values differ; {names}\n   only ours   {list((ours - theirs).items())[:3]}\n"
                        f"   only theirs {list((theirs - ours).items())[:3]}")
    return problems, len(rows)


def main():
    from pyspark.sql import SparkSession
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", os.environ.get("SHARED_DIR", "/tmp/tabulith-oracle"))
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    wanted = sys.argv[1:] or list(entry.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problems, rows = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problems, rows = [f"{type(error).__name__}: {str(error)[:700]}"], -1
        bad += bool(problems)
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name} ({kind}, {rows} rows, {time.time() - start:.1f}s)", flush=True)
        for p in problems:
            print("   ", p, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")


if __name__ == "__main__":
    main()
