"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype(float) + 0.0
        elif pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("float64" if df[c].isna().any() else "int64")
    return df.sort_values(list(df.columns), na_position="first", ignore_index=True)


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame):
    """None when equal, otherwise a short description."""
    a, b = normal(spark_df), normal(duck_df)
    if list(a.columns) != list(b.columns):
        return f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}"
    if len(a) != len(b):
        return f"rows differ: {len(a)} and {len(b)}"
    for c in a.columns:
        kinds = (a[c].dtype.kind, b[c].dtype.kind)
        if kinds[0] != kinds[1] and len(a):
            return f"types differ in {c}: {a[c].dtype} and {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = same.idxmin()
            return f"{(~same).sum()} values differ in {c}, first {a[c][at]!r} and {b[c][at]!r}"
    return None


def main(sf="0.01", *names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", os.environ.get("PARTITIONS", "8"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in sql:
                out = difference(got, con.execute(sql[name]).df())
                word = "ok" if out is None else f"DIFF {out}"
            else:
                out, word = None, "rows only"
        except Exception as e:  # noqa: BLE001
            took, out = time.time() - start, str(e)
            word, got = "ERROR " + str(e)[:600], []
        bad += out is not None
        print(f"{name:26s} {took:6.2f}s duck {time.time() - start - took:5.2f}s {len(got):7d} rows  {word}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
