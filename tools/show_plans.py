"""Print the physical plans of the headline operators (for PLANS.md).

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from strata.operators.dedupe import dedupe_latest
    from strata.operators.keys import dense_number
    from strata.operators.marts import DimensionLookup, lookup_keys
    from strata.operators.transform import stamp_audit
    from strata.operators.upsert import upsert
    from strata.sources.csv import file_headers

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")

    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    shows = {
        "upsert (K4)": upsert(stamp_audit(o.where(F.col("o_orderdate") < "1999-01-01"), "r1"),
                              o.where(F.col("o_orderdate") >= "1998-01-01"), ["o_orderkey"],
                              run_id="r2", check=False),
        "dedupe_latest (A2)": dedupe_latest(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]),
        "fact lookup (J1)": lookup_keys(o, [DimensionLookup(
            t("customer").select("c_custkey", F.col("c_custkey").alias("CUSTOMER_KEY")),
            "o_custkey", "c_custkey", "CUSTOMER_KEY")]),
        "dense_number, range path (W1/W2)": dense_number(
            o, ["o_orderdate", "o_orderkey"], "ORDER_KEY", total_order=True),
    }
    for name, df in shows.items():
        print(f"### {name}\n```")
        df.explain()
        print("```")
    folder = f"{sf}"
    print("### header scan (S6)\n```")
    file_headers(spark, folder, glob="customer.parquet").explain()
    print("```")


if __name__ == "__main__":
    main()
