"""Compare named queries with their SQL on one data folder: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, (Decimal, float, int)):
        f = float(v)
        return "nan" if math.isnan(f) else f + 0.0
    if isinstance(v, (datetime, date)):
        return str(v)
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, folder, query, sql):
    """None when equal, else a short text."""
    df = query(spark, folder)
    got = [tuple(x) for x in df.collect()]
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = normal(df.columns, got), normal(want_cols, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:3]} columns {sorted(df.columns)}" if bad else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if argv[1:] and not any(name.startswith(a) for a in argv[1:]):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, query, oracles[name])
            else:
                problem = None if query(spark, folder).count() > 0 else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
