"""Run driver queries in Spark and their oracle SQL in DuckDB, then compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query: rows, schema (names) and value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return "NULL"
        if float(v).is_integer() and abs(v) < 2**53:
            return str(int(v))  # nullable integers arrive as floats from pandas
        return f"{float(v):.6g}" if abs(v) >= 1e6 else f"{round(float(v), 6):.6f}"
    if isinstance(v, pd.Timestamp | dt.datetime):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, np.integer | int) and not isinstance(v, bool):
        return str(int(v))
    if isinstance(v, np.ndarray | list | tuple):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if v is pd.NaT:
        return "NULL"
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(f"{name:22s} {results[name]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = f"rows={len(sdf)} (no oracle)"
        else:
            odf = con.sql(sql[name]).df()
            sc, sr = rows_of(sdf)
            oc, orr = rows_of(odf)
            if sc != oc:
                results[name] = f"SCHEMA MISMATCH spark={sc} oracle={oc}"
            elif len(sr) != len(orr):
                results[name] = f"ROWCOUNT MISMATCH spark={len(sr)} oracle={len(orr)}"
            elif sr != orr:
                diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
                results[name] = f"VALUE MISMATCH rows={len(sr)} first={diff}"
            else:
                results[name] = f"OK rows={len(sr)}"
        if verbose:
            print(f"{name:22s} {results[name]}  ({ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v.startswith("OK") and "no oracle" not in v]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
