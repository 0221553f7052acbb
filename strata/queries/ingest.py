"""Bronze queries: CSV reads (S4, S5, S6), header rule (P1), bronze load."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.transform import normalize_headers, rows_of_run, stamp_audit
from strata.queries.common import NOW, NOW_2, RUN_ID, RUN_ID_2, table
from strata.session import scratch_dir
from strata.sources.csv import csv_to_bronze, load_csv_folder, read_csv, write_csv
from strata.sources.tables import LayerTable, read_run
from strata.schemas import ADDED_BY, ADDED_ON

CUSTOMER_BRONZE = T.StructType([
    T.StructField("C_CUSTKEY", T.LongType()),
    T.StructField("C_NAME", T.StringType()),
    T.StructField("C_NATIONKEY", T.IntegerType()),
    T.StructField("C_ACCTBAL", T.DoubleType()),
    T.StructField("C_MKTSEGMENT", T.StringType()),
    T.StructField(ADDED_BY, T.StringType()),
    T.StructField(ADDED_ON, T.TimestampType()),
])

SUPPLIER_BRONZE = T.StructType([
    T.StructField("S_SUPPKEY", T.LongType()),
    T.StructField("S_NAME", T.StringType()),
    T.StructField("S_NATIONKEY", T.IntegerType()),
    T.StructField("S_ACCTBAL", T.DoubleType()),
])


def csv_ingest(spark, sf_dir):
    """Customer as CSV with untidy headers and an extra column -> bronze table -> read back."""
    src = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("c-name"),
        F.col("c_nationkey").alias("(c_nationkey)"), F.col("c_acctbal").alias("C.AcctBal $"),
        F.col("c_mktsegment").alias("c mktsegment!"), F.lit("x").alias("Extra col"))
    drop = write_csv(src, scratch_dir(spark, "drop_customer"))
    bronze = LayerTable(spark, scratch_dir(spark, "bronze_customer")).create(CUSTOMER_BRONZE)
    load_csv_folder(spark, drop, bronze, run_id=RUN_ID, now=NOW)  # one checked pass: one layout
    return bronze.read()


def csv_mixed_headers(spark, sf_dir):
    """Supplier as files of two column orders in one folder; every value lands in its column."""
    sup = table(spark, sf_dir, "supplier")
    folder = scratch_dir(spark, "drop_supplier")
    write_csv(sup.where(F.col("s_nationkey") < 12)
              .select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), folder)
    write_csv(sup.where(F.col("s_nationkey") >= 12)
              .select("s_acctbal", "s_nationkey", "s_name", "s_suppkey"), folder, mode="append")
    return csv_to_bronze(spark, folder, SUPPLIER_BRONZE, run_id=RUN_ID, now=NOW)


def csv_infer(spark, sf_dir):
    """Part as CSV read back with inferred types."""
    folder = write_csv(table(spark, sf_dir, "part"), scratch_dir(spark, "drop_part"))
    return read_csv(spark, folder, infer_schema=True)


def normalize_headers_q(spark, sf_dir):
    """Orders under untidy names, renamed by the header rule."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" order key "), F.col("o_custkey").alias("Cust#Key"),
        F.col("o_orderstatus").alias("__status__"), F.col("o_totalprice").alias("Total Price ($)"),
        F.col("o_orderdate").alias("order-date"), F.col("o_orderpriority").alias("Priority...Level"))
    return normalize_headers(o)


def audit_by_run(spark, sf_dir):
    """Two stamped batches of orders appended to one table; read back the second run's rows."""
    o = table(spark, sf_dir, "orders")
    bronze = LayerTable(spark, scratch_dir(spark, "bronze_orders"))
    bronze.create(stamp_audit(o, "", None, (ADDED_BY, ADDED_ON)).schema)
    bronze.append(stamp_audit(o.where(F.col("o_orderdate") < "1998-06-01"), RUN_ID, NOW, (ADDED_BY, ADDED_ON)))
    bronze.append(stamp_audit(o.where(F.col("o_orderdate") >= "1998-06-01"), RUN_ID_2, NOW_2, (ADDED_BY, ADDED_ON)))
    return rows_of_run(bronze.read(), RUN_ID_2)


def rows_of_a_run(spark, sf_dir):
    """Three runs' orders in one table, one of them by two appends; one run's rows, with the number of files they are in."""
    o = table(spark, sf_dir, "orders")
    stamped = lambda df, run, now: stamp_audit(df, run, now, (ADDED_BY, ADDED_ON))
    bronze = LayerTable(spark, scratch_dir(spark, "bronze_runs"))
    bronze.replace(stamped(o.where(F.col("o_orderdate") < "1994-01-01").coalesce(1), RUN_ID, NOW))
    bronze.append(stamped(o.where((F.col("o_orderdate") >= "1994-01-01") & (F.col("o_orderdate") < "1996-01-01")), "run-0003", NOW), "run-0003")
    for low, high in (("1996-01-01", "1997-01-01"), ("1997-01-01", "2100-01-01")):
        bronze.append(stamped(o.where((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high)).coalesce(1), RUN_ID_2, NOW_2), RUN_ID_2)
    rows = read_run(bronze, RUN_ID_2)
    return rows.withColumn("FILES", F.lit(rows.select(F.input_file_name()).distinct().count()).cast("long"))


QUERIES = {
    "rows_of_a_run": rows_of_a_run,
    "csv_ingest": csv_ingest,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_infer": csv_infer,
    "normalize_headers": normalize_headers_q,
    "audit_by_run": audit_by_run,
}

ORACLE = {
    "rows_of_a_run": f"""
        SELECT *, '{RUN_ID_2}' AS ADDED_BY, TIMESTAMP '{NOW_2}' AS ADDED_ON, 2 AS FILES
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
    "csv_ingest": f"""
        SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY,
               c_acctbal AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT,
               '{RUN_ID}' AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON
        FROM customer""",
    "csv_mixed_headers": """
        SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY,
               s_acctbal AS S_ACCTBAL FROM supplier""",
    "csv_infer": """
        SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
        FROM part""",
    "normalize_headers": """
        SELECT o_orderkey AS ORDER_KEY, o_custkey AS CUST_KEY, o_orderstatus AS STATUS,
               o_totalprice AS TOTAL_PRICE, o_orderdate AS ORDER_DATE, o_orderpriority AS PRIORITY_LEVEL
        FROM orders""",
    "audit_by_run": f"""
        SELECT *, '{RUN_ID_2}' AS ADDED_BY, TIMESTAMP '{NOW_2}' AS ADDED_ON
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'""",
}
