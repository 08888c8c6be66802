"""Runs registered queries beside their SQL and compares whole results."""

from __future__ import annotations

import glob
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, build, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = build(spark, sf_dir)
    result = connection.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} against {sorted(result.columns)}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(result.columns, result.fetchall())
    if ours == theirs:
        return None
    known, seen = set(theirs), set(ours)
    only_ours = [r for r in ours if r not in known][:2]
    only_theirs = [r for r in theirs if r not in seen][:2]
    return f"{sorted(df.columns)}: {len(ours)} rows against {len(theirs)}; ours {only_ours}; oracle {only_theirs}"


if __name__ == "__main__":
    import tempfile
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", work)
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                outcome = compare(spark, duck, build, sqls[name], sf)
            else:
                outcome = None if build(spark, sf).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += outcome is not None
        print(f"\n{'ok ' if outcome is None else 'BAD'} {name} {time.time() - start:.1f}s {outcome or ''}", flush=True)
    print(f"{bad} bad")
    sys.exit(bad > 0)
