"""Gold queries: dimension and fact builds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.marts import DimensionLookup, build_dimension, build_fact
from strata.queries.common import NOW, RUN_ID, audit_sql, table
from strata.schemas import with_audit

FACT_ORDERS = with_audit(T.StructType([
    T.StructField("ORDER_KEY", T.LongType()),
    T.StructField("O_ORDERKEY", T.LongType()),
    T.StructField("CUSTOMER_KEY", T.LongType()),
    T.StructField("O_ORDERDATE", T.TimestampNTZType()),
    T.StructField("O_TOTALPRICE", T.FloatType()),
]))


def building_dimension(spark, sf_dir):
    """Customer dimension of one market segment, keyed in customer-key order."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return build_dimension(
        customers,
        {"c_custkey": "C_CUSTKEY", "c_name": "C_NAME", "c_nationkey": "C_NATIONKEY"},
        key="CUSTOMER_KEY", order_by=["C_CUSTKEY"], run_id=RUN_ID, now=NOW, source_is_scan=True,
    )


def fact_build(spark, sf_dir):
    """Flagship: orders fact with the dimension's key; orders of other segments get null."""
    orders = table(spark, sf_dir, "orders")
    dim = building_dimension(spark, sf_dir)
    return build_fact(
        orders,
        {"o_orderkey": "O_ORDERKEY", "o_custkey": "O_CUSTKEY",
         "o_orderdate": "O_ORDERDATE", "o_totalprice": "O_TOTALPRICE"},
        [DimensionLookup(dim, fact_on="O_CUSTKEY", dim_on="C_CUSTKEY", key="CUSTOMER_KEY")],
        key="ORDER_KEY", order_by=["O_ORDERDATE", "CUSTOMER_KEY", "O_ORDERKEY"],
        run_id=RUN_ID, now=NOW, schema=FACT_ORDERS,
    )


def dim_build(spark, sf_dir):
    """Customer dimension keyed by (nation, customer key)."""
    return build_dimension(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "C_CUSTKEY", "c_name": "C_NAME", "c_nationkey": "C_NATIONKEY",
         "c_mktsegment": "C_MKTSEGMENT"},
        key="CUSTOMER_KEY", order_by=["C_NATIONKEY", "C_CUSTKEY"], run_id=RUN_ID, now=NOW, source_is_scan=True,
    )


def fact_lookup_nonunique(spark, sf_dir):
    """J1 on a dimension that is not unique on the join column (customers per nation):
    each supplier gets one key, the nation's smallest, not one row per customer."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("S_SUPPKEY"), F.col("s_nationkey").alias("S_NATIONKEY"),
        F.col("s_acctbal").alias("S_ACCTBAL"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("NATION"), F.col("c_custkey").alias("C_CUSTKEY"))
    from strata.operators.marts import lookup_keys
    return lookup_keys(supplier, [DimensionLookup(customers, "S_NATIONKEY", "NATION", "C_CUSTKEY")])


QUERIES = {
    "fact_build": fact_build,
    "dim_build": dim_build,
    "fact_lookup_nonunique": fact_lookup_nonunique,
}

ORACLE = {
    "fact_build": f"""
        WITH dim AS (
            SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS CUSTOMER_KEY
            FROM customer WHERE c_mktsegment = 'BUILDING'
        ), f AS (
            SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, d.CUSTOMER_KEY
            FROM orders o LEFT JOIN dim d ON o.o_custkey = d.c_custkey
        )
        SELECT CAST(row_number() OVER (ORDER BY o_orderdate, CUSTOMER_KEY NULLS FIRST, o_orderkey) AS BIGINT) AS ORDER_KEY,
               o_orderkey AS O_ORDERKEY, CUSTOMER_KEY, o_orderdate AS O_ORDERDATE,
               CAST(o_totalprice AS FLOAT) AS O_TOTALPRICE, {audit_sql()}
        FROM f""",
    "dim_build": f"""
        SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY,
               c_mktsegment AS C_MKTSEGMENT,
               CAST(row_number() OVER (ORDER BY c_nationkey, c_custkey) AS BIGINT) AS CUSTOMER_KEY,
               {audit_sql()}
        FROM customer""",
    "fact_lookup_nonunique": """
        SELECT s.s_suppkey AS S_SUPPKEY, s.s_nationkey AS S_NATIONKEY, s.s_acctbal AS S_ACCTBAL,
               c.C_CUSTKEY
        FROM supplier s
        LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS C_CUSTKEY FROM customer GROUP BY c_nationkey) c
          ON s.s_nationkey = c.c_nationkey""",
}


def sales_gold(spark, sf_dir):
    """The yard sales gold pair on mapped tables: appointments from suppliers, sales from
    orders; a yard is (nation, key mod 10), so a yard has several appointments and a sale
    takes its yard's first appointment key. Prices arrive as text in three spellings."""
    from strata.operators.transform import conform
    from strata.plans.yard_marts import dim_appointment_data, fact_sales
    from strata.schemas import SILVER_APPOINTMENT_DATA, SILVER_SALES_DATA_PRIOR_DAY

    nation = table(spark, sf_dir, "nation")
    appt = (table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.concat_ws("-", "n_name", F.col("s_suppkey") % 10).alias("YARD_NAME"),
                    F.col("s_suppkey").cast("string").alias("SALES_ORDER_TICKET_ID"),
                    F.col("s_name").alias("CARRIER_NAME")))
    appt = conform(_fill_missing(appt, SILVER_APPOINTMENT_DATA), SILVER_APPOINTMENT_DATA)
    price = F.col("o_totalprice").cast("string")
    sales = (table(spark, sf_dir, "orders")
             .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("o_custkey").cast("string").alias("YARD_ID"),
                     F.concat_ws("-", "n_name", F.col("o_custkey") % 10).alias("YARD"),
                     F.concat_ws("#", "o_orderpriority", "o_orderkey").alias("COMMODITY_NAME"),
                     F.when(F.col("o_orderstatus") == "O", F.format_number("o_totalprice", 2))
                      .when(F.col("o_orderstatus") == "P", F.concat(F.lit(" "), price, F.lit(" ")))
                      .otherwise(price).alias("PRICE"),
                     F.concat(F.lit("$"), price).alias("SELL_PRICE"),
                     price.alias("INVOICE_TOTAL")))
    sales = conform(_fill_missing(sales, SILVER_SALES_DATA_PRIOR_DAY), SILVER_SALES_DATA_PRIOR_DAY)
    dim = dim_appointment_data(appt, run_id=RUN_ID, now=NOW)
    return fact_sales(sales, dim, run_id=RUN_ID, now=NOW)


def _fill_missing(df, schema):
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                            for f in schema.fields if f.name.lower() not in have])


QUERIES["sales_gold"] = sales_gold
ORACLE["sales_gold"] = f"""
    WITH appt AS (
        SELECT n.n_name || '-' || (s.s_suppkey % 10) AS YARD_NAME, CAST(s.s_suppkey AS VARCHAR) AS SALES_ORDER_ID, s.s_name AS CARRIER_NAME
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
    keyed AS (
        SELECT YARD_NAME, row_number() OVER (ORDER BY YARD_NAME, SALES_ORDER_ID, CARRIER_NAME) AS ADK FROM appt),
    dim AS (SELECT YARD_NAME, min(ADK) AS ADK FROM keyed GROUP BY YARD_NAME),
    sales AS (
        SELECT CAST(o.o_custkey AS VARCHAR) AS YARD_ID, n.n_name || '-' || (o.o_custkey % 10) AS YARD,
               o.o_orderpriority || '#' || o.o_orderkey AS COMMODITY_NAME,
               o.o_orderstatus AS st, o.o_totalprice AS p
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
    SELECT CAST(row_number() OVER (ORDER BY s.YARD_ID, d.ADK NULLS FIRST, s.COMMODITY_NAME) AS INTEGER) AS SALES_KEY,
           s.YARD_ID, CAST(d.ADK AS INTEGER) AS APPOINTMENT_DATA_KEY, s.COMMODITY_NAME,
           CASE WHEN s.st = 'O' AND s.p >= 1000 THEN NULL ELSE CAST(s.p AS FLOAT) END AS PRICE,
           CAST(NULL AS FLOAT) AS SELL_PRICE, CAST(s.p AS FLOAT) AS INVOICE_TOTAL, {audit_sql()}
    FROM sales s LEFT JOIN dim d ON s.YARD = d.YARD_NAME"""
