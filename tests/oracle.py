"""Compare registered queries with their SQL on DuckDB.

``python tests/oracle.py [name ...]`` checks the named queries (default: all)
at ``$SF_DIR`` (default sf0.01).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """One form for values that are equal in both engines."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None if v is None else "NaN"
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def family(v) -> str:
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, (float, decimal.Decimal)):
        return type(v).__name__
    return type(v).__name__


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, sf_dir, query, sql) -> str:
    """Empty when equal, otherwise what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not got and not want:
        return "both empty"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for n in names:
        x = {family(r[df.columns.index(n)]) for r in got if r[df.columns.index(n)] is not None}
        y = {family(r[names.index(n)]) for r in want if r[names.index(n)] is not None}
        if x != y:
            return f"type of {n}: {x} != {y}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else ""


def main(names):
    from pyspark.sql import SparkSession

    from sedimenta.registry import ORACLES, QUERIES

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            msg = compare(spark, con, sf_dir, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += bool(msg)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if msg else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {msg}", flush=True)
    print(f"{bad} failed of {len(names or QUERIES)}")


if __name__ == "__main__":
    main(sys.argv[1:])
