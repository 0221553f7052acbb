"""End-to-end queries: CSV -> bronze -> silver -> gold under the run gate (G2, G3, G6, G7),
and incremental file ingest (K9)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.marts import DimensionLookup, build_dimension, build_fact
from strata.plans.control import ControlTables
from strata.plans.jobs import GoldBuilder, LayerConfig, LoadContext, create_tables, run_layers
from strata.queries.common import NOW, RUN_ID, audit_sql, table
from strata.schemas import (
    ADDED_BY, ADDED_ON, EDW_CONFIG, OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION,
    string_schema, with_audit,
)
from strata.session import scratch_dir
from strata.sources.csv import write_csv
from strata.sources.tables import Lakehouse
from strata.streaming.ingest import ingest_new_files

BRONZE = {
    ("bronze", "CUSTOMER"): string_schema(
        ["CUST_KEY", "CUST_NAME", "NATION_KEY", "ACCT_BAL", "MKT_SEGMENT"], audit=(ADDED_BY, ADDED_ON)),
    ("bronze", "ORDERS"): string_schema(
        ["ORDER_KEY", "CUST_KEY", "ORDER_STATUS", "TOTAL_PRICE", "ORDER_DATE"], audit=(ADDED_BY, ADDED_ON)),
}
SILVER = {
    ("silver", "CUSTOMER"): with_audit(T.StructType([
        T.StructField("CUSTOMER_ID", T.LongType()), T.StructField("CUSTOMER_NAME", T.StringType()),
        T.StructField("NATION_ID", T.IntegerType()), T.StructField("BALANCE", T.DoubleType()),
        T.StructField("SEGMENT", T.StringType())])),
    ("silver", "ORDERS"): with_audit(T.StructType([
        T.StructField("ORDER_ID", T.LongType()), T.StructField("CUSTOMER_ID", T.LongType()),
        T.StructField("STATUS", T.StringType()), T.StructField("AMOUNT", T.DoubleType()),
        T.StructField("ORDER_DATE", T.TimestampType())])),
}
GOLD = {
    ("gold", "DIM_CUSTOMER"): with_audit(T.StructType([
        T.StructField("CUSTOMER_KEY", T.LongType()), T.StructField("CUSTOMER_ID", T.LongType()),
        T.StructField("CUSTOMER_NAME", T.StringType()), T.StructField("SEGMENT", T.StringType())])),
    ("gold", "FACT_ORDERS"): with_audit(T.StructType([
        T.StructField("ORDER_KEY", T.LongType()), T.StructField("ORDER_ID", T.LongType()),
        T.StructField("CUSTOMER_KEY", T.LongType()), T.StructField("ORDER_DATE", T.TimestampType()),
        T.StructField("AMOUNT", T.FloatType())])),
}


def _dim_customer(ctx: LoadContext):
    return build_dimension(
        ctx.lake.table("silver", "CUSTOMER").read(), ["CUSTOMER_ID", "CUSTOMER_NAME", "SEGMENT"],
        key="CUSTOMER_KEY", order_by=["CUSTOMER_ID"], run_id=ctx.run_id, now=ctx.now,
        schema=GOLD[("gold", "DIM_CUSTOMER")],
        existing=ctx.lake.table("gold", "DIM_CUSTOMER").read(), natural_key=["CUSTOMER_ID"])


def _fact_orders(ctx: LoadContext):
    dim = ctx.lake.table("gold", "DIM_CUSTOMER").read()
    return build_fact(
        ctx.lake.table("silver", "ORDERS").read(), ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "AMOUNT"],
        [DimensionLookup(dim, "CUSTOMER_ID", "CUSTOMER_ID", "CUSTOMER_KEY")],
        key="ORDER_KEY", order_by=["ORDER_DATE", "CUSTOMER_KEY", "ORDER_ID"],
        run_id=ctx.run_id, now=ctx.now, schema=GOLD[("gold", "FACT_ORDERS")])


def full_pipeline(spark, sf_dir):
    """Customer and orders as CSV drops (two layouts of orders) through all three layers."""
    root = scratch_dir(spark, "lake")
    src = f"{root}/raw"
    c = table(spark, sf_dir, "customer")
    write_csv(c.select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Cust Name"),
                       F.col("c_nationkey").alias("Nation Key"), F.col("c_acctbal").alias("Acct Bal ($)"),
                       F.col("c_mktsegment").alias("Mkt-Segment")), f"{src}/customer")
    o = table(spark, sf_dir, "orders")
    write_csv(o.where(F.col("o_orderdate") < "1998-01-01").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Cust Key"),
        F.col("o_orderstatus").alias("Order Status"), F.col("o_totalprice").alias("Total Price"),
        F.col("o_orderdate").alias("Order Date")), f"{src}/orders")
    write_csv(o.where(F.col("o_orderdate") >= "1998-01-01").select(
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("cust_key"),
        F.col("o_orderkey").alias("order_key")), f"{src}/orders", mode="append")

    objects = spark.createDataFrame([
        ("CUSTOMER", "erp", "customer", "customer", "", "CUSTOMER", "CUSTOMER", "Upsert", "CUSTOMER_ID", 0, 1),
        ("ORDERS", "erp", "orders", "orders", "", "ORDERS", "ORDERS", "upsert", " ORDER_ID ", 1, 1),
    ], OBJECTS_CONFIGURATION)
    mapping = spark.createDataFrame([
        ("erp", "CUSTOMER", "CUST_KEY", "CUSTOMER_ID", "bigint", None),
        ("erp", "CUSTOMER", "CUST_NAME", "CUSTOMER_NAME", "string", None),
        ("erp", "CUSTOMER", "NATION_KEY", "NATION_ID", "int", None),
        ("erp", "CUSTOMER", "ACCT_BAL", "BALANCE", "double", "0"),
        ("erp", "CUSTOMER", "MKT_SEGMENT", "SEGMENT", "string", "UNKNOWN"),
        ("Erp", "orders", "ORDER_KEY", "ORDER_ID", "bigint", None),
        ("Erp", "orders", "CUST_KEY", "CUSTOMER_ID", "bigint", None),
        ("Erp", "orders", "ORDER_STATUS", "STATUS", "string", None),
        ("Erp", "orders", "TOTAL_PRICE", "AMOUNT", "double", None),
        ("Erp", "orders", "ORDER_DATE", "ORDER_DATE", "timestamp", None),
    ], OBJECTS_COLUMN_MAPPING)
    edw = spark.createDataFrame([
        ("FACT_ORDERS", "upsert", "ORDER_KEY", "gold", "edw",
         "ORDER_KEY, ORDER_ID, CUSTOMER_KEY, ORDER_DATE, AMOUNT, ADDED_BY, ADDED_ON, MODIFIED_BY, MODIFIED_ON", 1, 1),
        ("DIM_CUSTOMER", "UPSERT", "CUSTOMER_KEY", "gold", "edw",
         "CUSTOMER_KEY, CUSTOMER_ID, CUSTOMER_NAME, SEGMENT", 1, 1),
    ], EDW_CONFIG)

    lake = Lakehouse(spark, f"{root}/tables")
    create_tables(lake, {**BRONZE, **SILVER, **GOLD})
    control = ControlTables(lake.table("control", "status"), lake.table("control", "audit")).create()
    control.register("layers", True)
    ctx = LoadContext(spark, lake, src, RUN_ID, NOW)
    cfg = LayerConfig(objects, mapping, edw,
                      [GoldBuilder("FACT_ORDERS", _fact_orders, "fact"),
                       GoldBuilder("DIM_CUSTOMER", _dim_customer, "dimension")])
    state = run_layers(ctx, cfg, control, "layers")
    assert state == "completed", state
    return lake.table("gold", "FACT_ORDERS").read()


CUSTOMER_HEADER = T.StructType([T.StructField(n, T.StringType()) for n in
                                ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")])
CUSTOMER_STREAM_TARGET = T.StructType([
    T.StructField("C_CUSTKEY", T.LongType()), T.StructField("C_NAME", T.StringType()),
    T.StructField("C_NATIONKEY", T.IntegerType()), T.StructField("C_ACCTBAL", T.DoubleType()),
    T.StructField("C_MKTSEGMENT", T.StringType()),
    T.StructField(ADDED_BY, T.StringType()), T.StructField(ADDED_ON, T.TimestampType())])


def incremental_ingest(spark, sf_dir):
    """Customer CSV in two drops, each ingested by an ``availableNow`` run: every row once."""
    root = scratch_dir(spark, "stream")
    src, out, ckpt, arch = f"{root}/in", f"{root}/bronze", f"{root}/_checkpoint", f"{root}/archive"
    c = table(spark, sf_dir, "customer").select(*[f.name for f in CUSTOMER_HEADER.fields])
    kw = dict(run_id=RUN_ID, now=NOW, archive_dir=arch)
    write_csv(c.where(F.col("c_nationkey") < 12), src)
    ingest_new_files(spark, src, CUSTOMER_HEADER, out, ckpt, CUSTOMER_STREAM_TARGET, **kw)
    write_csv(c.where(F.col("c_nationkey") >= 12), src, mode="append")
    ingest_new_files(spark, src, CUSTOMER_HEADER, out, ckpt, CUSTOMER_STREAM_TARGET, **kw)
    ingest_new_files(spark, src, CUSTOMER_HEADER, out, ckpt, CUSTOMER_STREAM_TARGET, **kw)  # nothing new
    return spark.read.parquet(out)


def incremental_bronze(spark, sf_dir):
    """Config-driven bronze in incremental mode: two drops of customers, two runs; each file
    is loaded once, by the run that first sees it, then archived."""
    from strata.plans.jobs import run_bronze
    from strata.queries.common import NOW_2, RUN_ID_2

    root = scratch_dir(spark, "incr")
    src = f"{root}/landing"
    lake = Lakehouse(spark, f"{root}/tables")
    lake.table("bronze", "CUSTOMER").create(CUSTOMER_STREAM_TARGET)
    objects = spark.createDataFrame([
        ("CUSTOMER", "erp", "customer/in", "customer", "customer/processed", "CUSTOMER", "CUSTOMER",
         "upsert", "C_CUSTKEY", 0, 1)], OBJECTS_CONFIGURATION)
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("C Name"),
        F.col("c_nationkey").alias("C NationKey"), F.col("c_acctbal").alias("C AcctBal"),
        F.col("c_mktsegment").alias("C MktSegment"))
    write_csv(c.where(F.col("C NationKey") < 12), f"{src}/customer/in")
    run_bronze(LoadContext(spark, lake, src, RUN_ID, NOW), objects, incremental=True)
    write_csv(c.where(F.col("C NationKey") >= 12), f"{src}/customer/in", mode="append")
    run_bronze(LoadContext(spark, lake, src, RUN_ID_2, NOW_2), objects, incremental=True)
    run_bronze(LoadContext(spark, lake, src, "run-0003", NOW_2), objects, incremental=True)  # nothing new
    return lake.table("bronze", "CUSTOMER").read()


def _rerun(spark, sf_dir, incremental_silver: bool):
    """Two gated runs over config: run 1 loads orders before 1999; run 2 brings orders from
    1998 on, repriced. Bronze is incremental (each file once); silver is an upsert, so
    matched keys keep ADDED_* of run 1 and get MODIFIED_* of run 2, new keys are inserted."""
    from strata.queries.common import NOW_2, RUN_ID_2

    root = scratch_dir(spark, "rerun")
    src = f"{root}/landing"
    lake = Lakehouse(spark, f"{root}/tables")
    create_tables(lake, {("bronze", "ORDERS"): BRONZE[("bronze", "ORDERS")],
                         ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    control = ControlTables(lake.table("control", "status"), lake.table("control", "audit")).create()
    control.register("orders", True)
    objects = spark.createDataFrame([
        ("ORDERS", "erp", "orders", "orders", "orders_done", "ORDERS", "ORDERS", "upsert", "ORDER_ID", 0, 1),
    ], OBJECTS_CONFIGURATION)
    mapping = spark.createDataFrame([
        ("erp", "ORDERS", "ORDER_KEY", "ORDER_ID", "bigint", None),
        ("erp", "ORDERS", "CUST_KEY", "CUSTOMER_ID", "bigint", None),
        ("erp", "ORDERS", "ORDER_STATUS", "STATUS", "string", None),
        ("erp", "ORDERS", "TOTAL_PRICE", "AMOUNT", "double", None),
        ("erp", "ORDERS", "ORDER_DATE", "ORDER_DATE", "timestamp", None),
    ], OBJECTS_COLUMN_MAPPING)
    cfg = LayerConfig(objects, mapping, spark.createDataFrame([], EDW_CONFIG), [])
    o = table(spark, sf_dir, "orders")
    drop = lambda df: df.select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Cust Key"),
        F.col("o_orderstatus").alias("Order Status"), F.col("o_totalprice").alias("Total Price"),
        F.col("o_orderdate").alias("Order Date"))
    write_csv(drop(o.where(F.col("o_orderdate") < "1999-01-01")), f"{src}/orders")
    kw = dict(incremental=True, incremental_silver=incremental_silver)
    first = run_layers(LoadContext(spark, lake, src, RUN_ID, NOW), cfg, control, "orders", **kw)
    repriced = o.where(F.col("o_orderdate") >= "1998-01-01").withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
    write_csv(drop(repriced), f"{src}/orders", mode="append")
    second = run_layers(LoadContext(spark, lake, src, RUN_ID_2, NOW_2), cfg, control, "orders", **kw)
    assert (first, second) == ("completed", "completed"), (first, second)
    return lake.table("silver", "ORDERS").read()


def layers_rerun(spark, sf_dir):
    """Silver re-reads all of bronze each run (as the reference): every key present in run 2's
    view of bronze is matched, so all existing rows get MODIFIED_* of run 2."""
    return _rerun(spark, sf_dir, incremental_silver=False)


def layers_rerun_incremental(spark, sf_dir):
    """Silver reads only bronze rows newer than its last write: rows run 2 did not bring keep
    MODIFIED_* of run 1."""
    return _rerun(spark, sf_dir, incremental_silver=True)


QUERIES = {"full_pipeline": full_pipeline, "incremental_ingest": incremental_ingest,
           "incremental_bronze": incremental_bronze, "layers_rerun": layers_rerun,
           "layers_rerun_incremental": layers_rerun_incremental}

ORACLE = {
    "layers_rerun_incremental": f"""
        SELECT o_orderkey AS ORDER_ID, o_custkey AS CUSTOMER_ID, o_orderstatus AS STATUS,
               CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1.0 ELSE o_totalprice END
                 AS AMOUNT,
               o_orderdate AS ORDER_DATE,
               CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '{RUN_ID}' ELSE 'run-0002' END AS ADDED_BY,
               CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN TIMESTAMP '{NOW}'
                    ELSE TIMESTAMP '2024-02-01 12:30:00' END AS ADDED_ON,
               CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '{RUN_ID}' ELSE 'run-0002' END AS MODIFIED_BY,
               CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN TIMESTAMP '{NOW}'
                    ELSE TIMESTAMP '2024-02-01 12:30:00' END AS MODIFIED_ON
        FROM orders""",
    "layers_rerun": f"""
        SELECT o_orderkey AS ORDER_ID, o_custkey AS CUSTOMER_ID, o_orderstatus AS STATUS,
               CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1.0 ELSE o_totalprice END
                 AS AMOUNT,
               o_orderdate AS ORDER_DATE,
               CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '{RUN_ID}' ELSE 'run-0002' END AS ADDED_BY,
               CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN TIMESTAMP '{NOW}'
                    ELSE TIMESTAMP '2024-02-01 12:30:00' END AS ADDED_ON,
               'run-0002' AS MODIFIED_BY, TIMESTAMP '2024-02-01 12:30:00' AS MODIFIED_ON
        FROM orders""",
    "incremental_bronze": f"""
        SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY,
               c_acctbal AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT,
               CASE WHEN c_nationkey < 12 THEN '{RUN_ID}' ELSE 'run-0002' END AS ADDED_BY,
               CASE WHEN c_nationkey < 12 THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2024-02-01 12:30:00' END AS ADDED_ON
        FROM customer""",
    "full_pipeline": f"""
        WITH dim AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS CUSTOMER_KEY FROM customer)
        SELECT CAST(row_number() OVER (ORDER BY o.o_orderdate, d.CUSTOMER_KEY NULLS FIRST, o.o_orderkey) AS BIGINT)
                 AS ORDER_KEY,
               o.o_orderkey AS ORDER_ID, CAST(d.CUSTOMER_KEY AS BIGINT) AS CUSTOMER_KEY,
               o.o_orderdate AS ORDER_DATE, CAST(o.o_totalprice AS FLOAT) AS AMOUNT, {audit_sql()}
        FROM orders o LEFT JOIN dim d ON o.o_custkey = d.c_custkey""",
    "incremental_ingest": f"""
        SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY,
               c_acctbal AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT,
               '{RUN_ID}' AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON
        FROM customer""",
}
