"""Run queries and their SQL side by side: python tests/check_queries.py SF_DIR [NAME ...]"""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def compare(spark, con, sf_dir, name):
    """None if the query and its SQL agree in columns and rows, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in sql.fetchall()), key=repr)
    if len(got) != len(want):
        extra = [x for x in got if x not in set(want)][:3], [x for x in want if x not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}: {extra}"
    for g, w in zip(got, want):
        if g != w:
            return f"{columns}: {g} against {w}"
    return None if got else "no rows"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    bad = 0
    for name in sys.argv[2:] or sorted(entry.oracle_sql()):
        start = time.time()
        try:
            problem = compare(spark, con, sys.argv[1], name)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:22s} {time.time() - start:6.2f}s {'ok' if problem is None else 'DIFFERS ' + problem[:1500]}", flush=True)
    print("differing:", bad)
