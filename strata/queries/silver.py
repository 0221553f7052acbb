"""Silver and config queries: mapping-driven rename, fill, cast, conform."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.transform import CAST_ERRORS, cast_columns, cast_with_errors, conform, fill_nulls, rename_columns
from strata.plans.config import (
    gold_columns_table,
    gold_config_with_paths,
    load_mapping,
    merge_columns_table,
)
from strata.queries.common import table
from strata.schemas import OBJECTS_COLUMN_MAPPING


def _mapping(spark, rows):
    return spark.createDataFrame(rows, OBJECTS_COLUMN_MAPPING)


def mapping_rename(spark, sf_dir):
    """Supplier renamed by mapping rows: a swap, a rename onto an existing column, no-ops."""
    sup = table(spark, sf_dir, "supplier").withColumn("SUPPLIER_ID", F.lit("stale"))
    mapping = _mapping(spark, [
        ("erp", "SUPPLIER", "s_name", "s_acctbal", "string", None),
        ("erp", "SUPPLIER", "s_acctbal", "s_name", "double", None),
        ("erp", "SUPPLIER", "s_suppkey", "SUPPLIER_ID", "bigint", None),
        ("erp", "SUPPLIER", "s_nationkey", "s_nationkey", "int", None),
        ("erp", "SUPPLIER", "not_there", "X", "string", None),
        ("other", "SUPPLIER", "s_nationkey", "NATION", "int", None),
    ])
    m = load_mapping(mapping, "ERP", "supplier")
    return rename_columns(sup, m.renames)


def null_fill(spark, sf_dir):
    """Lineitem with nulls made by CASE; defaults from mapping rows whose VALUES is set."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag")).alias("L_RETURNFLAG"),
        F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_discount")).alias("L_DISCOUNT"),
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")).alias("L_QUANTITY"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_tax")).alias("L_TAX"))
    mapping = _mapping(spark, [
        ("erp", "LINEITEM", "l_returnflag", "L_RETURNFLAG", "string", "U"),
        ("erp", "LINEITEM", "l_discount", "L_DISCOUNT", "double", "0.5"),
        ("erp", "LINEITEM", "l_quantity", "L_QUANTITY", "double", "7"),
        ("erp", "LINEITEM", "l_tax", "L_TAX", "double", None),
        ("erp", "ORDERS", "l_tax", "L_TAX", "double", "9"),
    ])
    return fill_nulls(li, load_mapping(mapping, "erp", "LINEITEM").defaults)


def mapping_cast(spark, sf_dir):
    """Orders carried as text (with unusable text) and cast by mapping types."""
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("O_ORDERKEY"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("O_CUSTKEY"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("O_TOTALPRICE"),
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
         .otherwise(F.col("o_orderdate").cast("string")).alias("O_ORDERDATE"),
        F.col("o_orderstatus").alias("O_ORDERSTATUS"))
    mapping = _mapping(spark, [
        ("erp", "ORDERS", "O_ORDERKEY", "O_ORDERKEY", "bigint", None),
        ("erp", "ORDERS", "O_CUSTKEY", "O_CUSTKEY", "bigint", None),
        ("erp", "ORDERS", "O_TOTALPRICE", "O_TOTALPRICE", "double", None),
        ("erp", "ORDERS", "O_ORDERDATE", "O_ORDERDATE", "timestamp", None),
        ("erp", "ORDERS", "O_ORDERSTATUS", "O_ORDERSTATUS", "string", None),
    ])
    return cast_columns(text, load_mapping(mapping, "erp", "orders").types)


def cast_errors(spark, sf_dir):
    """Orders carried as text, some of it unusable: the cast values, and each value that the cast made null."""
    o = table(spark, sf_dir, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("O_ORDERKEY"),
        F.when(F.col("o_custkey") % 11 == 4, F.concat(F.lit("c-"), F.col("o_custkey").cast("string")))
         .when(F.col("o_custkey") % 11 == 5, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("O_CUSTKEY"),
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(F.col("o_orderdate").cast("string")).alias("O_ORDERDATE"))
    mapping = _mapping(spark, [
        ("erp", "ORDERS", "O_ORDERKEY", "O_ORDERKEY", "bigint", None),
        ("erp", "ORDERS", "O_CUSTKEY", "o_custkey", "bigint", None),
        ("erp", "ORDERS", "O_ORDERDATE", "O_ORDERDATE", "timestamp", None),
        ("erp", "ORDERS", "GONE", "GONE", "int", None)])
    out = cast_with_errors(text, load_mapping(mapping, "erp", "orders").types)
    each = out.select("*", F.explode_outer(CAST_ERRORS).alias("e"))
    return each.select("O_ORDERKEY", "O_CUSTKEY", "O_ORDERDATE", F.upper("e.column").alias("ERROR_COLUMN"),
                       F.col("e.value").alias("ERROR_VALUE"), F.col("e.type").alias("ERROR_TYPE"))


PART_TARGET = T.StructType([
    T.StructField("P_PARTKEY", T.LongType()),
    T.StructField("P_NAME", T.StringType()),
    T.StructField("P_SIZE", T.LongType()),
    T.StructField("P_RETAILPRICE", T.DoubleType()),
])


def conform_schema(spark, sf_dir):
    """Part with extra, reordered and text-typed columns conformed to a declared schema."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").cast("string").alias("p_retailprice"), "p_size", "p_brand",
        "p_name", "p_partkey", F.lit(1).alias("extra"))
    return conform(p, PART_TARGET)


def _mapping_from_customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.when(F.col("c_acctbal") >= 5000, F.lit("Erp")).otherwise(F.lit("erp")).alias("SOURCE_NAME"),
        F.when(F.col("c_nationkey") < 12, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("OBJECT_NAME"),
        F.concat(F.lit("src_"), F.col("c_nationkey")).alias("SOURCE_COLUMN_NAME"),
        F.when(F.col("c_custkey") % 97 == 0, F.lit("Added_On"))
         .otherwise(F.concat(F.lit("COL_"), F.col("c_nationkey"))).alias("TARGET_COLUMN_NAME"),
        F.lit("string").alias("COLUMN_DATATYPE"), F.lit(None).cast("string").alias("VALUES"))


def _objects_from_customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("OBJECT_NAME"),
                    F.when(F.col("c_mktsegment") == "HOUSEHOLD", 0).otherwise(1).alias("IS_RUN")).distinct()


def active_config(spark, sf_dir):
    """Mapped target columns of active objects: case-insensitive filters, distinct, sorted, no audit."""
    return merge_columns_table(_mapping_from_customers(spark, sf_dir), "ERP",
                               _objects_from_customers(spark, sf_dir))


def _edw_from_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_brand").alias("OBJECT_NAME"),
        F.lit("upsert").alias("OPERATION_TYPE"),
        F.lit("P_PARTKEY").alias("GOLD_KEY_COLUMN_NAME"),
        F.concat_ws(" , ", F.lit("P_PARTKEY"), F.col("p_type"), F.lit("ACCOUNT_KEY"),
                    F.lit("ADDED_BY"), F.lit("Added_On"), F.lit("MODIFIED_BY"), F.lit("MODIFIED_ON"),
                    F.col("p_name"), F.lit("")).alias("GOLD_COLUMN_NAMES"))


def gold_columns(spark, sf_dir):
    """First column list per gold object, split and trimmed, with the update flag."""
    return gold_columns_table(_edw_from_parts(spark, sf_dir))


def config_join(spark, sf_dir):
    """Active gold config (from customers) joined to object config (from orders) for paths."""
    c = table(spark, sf_dir, "customer")
    edw = c.select(
        F.concat(F.lit("OBJ_"), F.col("c_custkey")).alias("OBJECT_NAME"),
        F.lit("upsert").alias("OPERATION_TYPE"), F.lit("KEY").alias("GOLD_KEY_COLUMN_NAME"),
        F.lit("gold").alias("GOLD_CATALOG_NAME"), F.col("c_mktsegment").alias("GOLD_SCHEMA_NAME"),
        F.lit("KEY, VALUE").alias("GOLD_COLUMN_NAMES"),
        F.lit(0).alias("IS_FULL_LOAD"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("IS_RUN"))
    o = table(spark, sf_dir, "orders")
    objects = o.select(
        F.concat(F.lit("OBJ_"), F.col("o_custkey")).alias("BRONZE_TABLE_NAME"),
        F.concat(F.lit("raw/"), F.col("o_orderkey")).alias("SOURCE_FILE_PATH"),
        F.concat(F.lit("archive/"), F.col("o_orderpriority")).alias("ARCHIVE_PATH"))
    return gold_config_with_paths(edw, objects)


QUERIES = {
    "mapping_rename": mapping_rename,
    "null_fill": null_fill,
    "mapping_cast": mapping_cast,
    "cast_errors": cast_errors,
    "conform_schema": conform_schema,
    "active_config": active_config,
    "gold_columns": gold_columns,
    "config_join": config_join,
}

_MAP = """
    SELECT CASE WHEN c_acctbal >= 5000 THEN 'Erp' ELSE 'erp' END AS SOURCE_NAME,
           CASE WHEN c_nationkey < 12 THEN lower(c_mktsegment) ELSE c_mktsegment END AS OBJECT_NAME,
           CASE WHEN c_custkey % 97 = 0 THEN 'Added_On' ELSE 'COL_' || c_nationkey END AS TARGET_COLUMN_NAME
    FROM customer"""

ORACLE = {
    "mapping_rename": """
        SELECT s_suppkey AS SUPPLIER_ID, s_name AS s_acctbal, s_nationkey, s_acctbal AS s_name
        FROM supplier""",
    "null_fill": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag = 'N' THEN 'U' ELSE l_returnflag END AS L_RETURNFLAG,
               CASE WHEN l_discount = 0 THEN 0.5 ELSE l_discount END AS L_DISCOUNT,
               CASE WHEN l_linenumber = 1 THEN 7.0 ELSE l_quantity END AS L_QUANTITY,
               CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS L_TAX
        FROM lineitem""",
    "cast_errors": """
        WITH o AS (SELECT o_orderkey AS O_ORDERKEY, CASE WHEN o_custkey % 11 IN (4, 5) THEN NULL ELSE o_custkey END AS O_CUSTKEY,
                          CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS O_ORDERDATE,
                          o_custkey % 11 = 4 AS bad_cust, o_orderstatus = 'P' AS bad_date, 'c-' || o_custkey AS cust FROM orders)
        SELECT O_ORDERKEY, O_CUSTKEY, O_ORDERDATE, 'O_CUSTKEY' AS ERROR_COLUMN, cust AS ERROR_VALUE, 'bigint' AS ERROR_TYPE FROM o WHERE bad_cust
        UNION ALL
        SELECT O_ORDERKEY, O_CUSTKEY, O_ORDERDATE, 'O_ORDERDATE', 'not a date', 'timestamp' FROM o WHERE bad_date
        UNION ALL
        SELECT O_ORDERKEY, O_CUSTKEY, O_ORDERDATE, NULL, NULL, NULL FROM o WHERE NOT bad_cust AND NOT bad_date""",
    "mapping_cast": """
        SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS O_TOTALPRICE,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS O_ORDERDATE,
               o_orderstatus AS O_ORDERSTATUS
        FROM orders""",
    "conform_schema": """
        SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, CAST(p_size AS BIGINT) AS P_SIZE,
               p_retailprice AS P_RETAILPRICE FROM part""",
    "active_config": f"""
        WITH m AS ({_MAP}),
             act AS (SELECT DISTINCT c_mktsegment AS OBJECT_NAME FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
        SELECT DISTINCT upper(m.OBJECT_NAME) AS OBJECT_NAME, m.TARGET_COLUMN_NAME
        FROM m JOIN act ON upper(m.OBJECT_NAME) = upper(act.OBJECT_NAME)
        WHERE lower(m.SOURCE_NAME) = 'erp'
          AND upper(m.TARGET_COLUMN_NAME) NOT IN ('ADDED_BY', 'ADDED_ON', 'MODIFIED_BY', 'MODIFIED_ON')""",
    "gold_columns": """
        WITH cfg AS (
            SELECT p_brand AS OBJECT_NAME,
                   concat_ws(' , ', 'P_PARTKEY', p_type, 'ACCOUNT_KEY', 'ADDED_BY', 'Added_On',
                             'MODIFIED_BY', 'MODIFIED_ON', p_name, '') AS GOLD_COLUMN_NAMES
            FROM part),
        top AS (SELECT OBJECT_NAME, min(GOLD_COLUMN_NAMES) AS g FROM cfg GROUP BY OBJECT_NAME),
        items AS (
            SELECT OBJECT_NAME, CAST(i - 1 AS BIGINT) AS POSITION, trim(string_split(g, ',')[i]) AS COLUMN_NAME
            FROM top, range(1, len(string_split(g, ',')) + 1) AS r(i))
        SELECT OBJECT_NAME, POSITION, COLUMN_NAME,
               upper(COLUMN_NAME) NOT IN ('ADDED_BY', 'ADDED_ON', 'MODIFIED_BY', 'MODIFIED_ON', 'ACCOUNT_KEY', 'P_PARTKEY')
                 AS IS_UPDATED
        FROM items WHERE COLUMN_NAME <> ''""",
    "config_join": """
        SELECT 'OBJ_' || c.c_custkey AS OBJECT_NAME, 'upsert' AS OPERATION_TYPE, 'KEY' AS GOLD_KEY_COLUMN_NAME,
               'gold' AS GOLD_CATALOG_NAME, c.c_mktsegment AS GOLD_SCHEMA_NAME,
               'KEY, VALUE' AS GOLD_COLUMN_NAMES, 0 AS IS_FULL_LOAD, 1 AS IS_RUN,
               'raw/' || o.o_orderkey AS SOURCE_FILE_PATH, 'archive/' || o.o_orderpriority AS ARCHIVE_PATH
        FROM customer c JOIN orders o ON 'OBJ_' || c.c_custkey = 'OBJ_' || o.o_custkey
        WHERE c.c_acctbal >= 0""",
}
