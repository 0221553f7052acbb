"""Silver/gold write queries: upsert (K4, K5, J3), replace (K2, K3, K6, K7), dedupe (A2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.names import split_list
from strata.operators.dedupe import dedupe_latest
from strata.operators.upsert import load_mode, replace, upsert
from strata.operators.transform import stamp_audit
from strata.queries.common import NOW, NOW_2, RUN_ID, RUN_ID_2, audit_sql, table
from strata.session import scratch_dir
from strata.sources.tables import LayerTable

ORDER_COLS = {"o_orderkey": "O_ORDERKEY", "o_custkey": "O_CUSTKEY", "o_orderstatus": "O_ORDERSTATUS",
              "o_totalprice": "O_TOTALPRICE", "o_orderdate": "O_ORDERDATE"}


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*[F.col(a).alias(b) for a, b in ORDER_COLS.items()])


def upsert_silver(spark, sf_dir):
    """Orders before 1999 loaded by run 1; orders from 1998 on, repriced, upserted by run 2."""
    orders = _orders(spark, sf_dir)
    silver = LayerTable(spark, scratch_dir(spark, "silver_orders"))
    silver.replace(stamp_audit(orders.where(F.col("O_ORDERDATE") < "1999-01-01"), RUN_ID, NOW))
    source = (orders.where(F.col("O_ORDERDATE") >= "1998-01-01")
              .withColumn("O_TOTALPRICE", F.col("O_TOTALPRICE") + 1.0)
              .withColumn("O_ORDERSTATUS", F.lower("O_ORDERSTATUS")))
    keys = split_list("O_ORDERKEY")
    silver.replace(upsert(silver.read(), source, keys, run_id=RUN_ID_2, now=NOW_2))
    return silver.read()


def upsert_gold(spark, sf_dir):
    """Suppliers, single key; update list from a gold column list (ADDED_* and key kept)."""
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("S_SUPPKEY"), F.col("s_name").alias("S_NAME"),
        F.col("s_nationkey").alias("S_NATIONKEY"), F.col("s_acctbal").alias("S_ACCTBAL"))
    gold = LayerTable(spark, scratch_dir(spark, "gold_supplier"))
    gold.replace(stamp_audit(sup.where(F.col("S_NATIONKEY") < 15), RUN_ID, NOW))
    source = (sup.where(F.col("S_NATIONKEY") >= 10)
              .withColumn("S_ACCTBAL", F.col("S_ACCTBAL") + 100.0)
              .withColumn("S_NATIONKEY", F.col("S_NATIONKEY") + 50)  # not listed: kept on a match
              .withColumn("S_NAME", F.concat(F.col("S_NAME"), F.lit("/v2"))))
    listed = split_list("S_SUPPKEY, S_NAME ,S_ACCTBAL, ADDED_BY, ADDED_ON, MODIFIED_BY, MODIFIED_ON")
    gold.replace(upsert(gold.read(), source, ["S_SUPPKEY"], run_id=RUN_ID_2, now=NOW_2,
                        update_columns=listed))
    return gold.read()


def upsert_null_keys(spark, sf_dir):
    """Customers whose key is null on both sides: nulls never match."""
    cust = table(spark, sf_dir, "customer")
    keyed = cust.select(
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("C_CUSTKEY"),
        F.col("c_name").alias("C_NAME"), F.col("c_nationkey").alias("C_NATIONKEY"),
        F.col("c_acctbal").alias("C_ACCTBAL"))
    target = stamp_audit(keyed.where(F.col("C_NATIONKEY") < 15), RUN_ID, NOW)
    source = keyed.where(F.col("C_NATIONKEY") >= 10).withColumn("C_ACCTBAL", F.col("C_ACCTBAL") + 1.0)
    return upsert(target, source, ["C_CUSTKEY"], run_id=RUN_ID_2, now=NOW_2)


def full_replace(spark, sf_dir):
    """Part: old contents fully replaced; the rows-written metric comes back as a column."""
    part = table(spark, sf_dir, "part")
    t = LayerTable(spark, scratch_dir(spark, "gold_part"))
    old = part.select("p_partkey", "p_name", (F.col("p_retailprice") * 2).alias("p_retailprice"))
    t.replace(stamp_audit(old, RUN_ID, NOW))
    schema = t.schema
    assert load_mode("UPSERT", 1) == "replace"
    written = t.replace(replace(part, schema, run_id=RUN_ID_2, now=NOW_2))
    return t.read().withColumn("ROWS_WRITTEN", F.lit(written).cast("long"))


def dedupe_latest_q(spark, sf_dir):
    """Lineitem on (order, line): newest ship date, ties broken by the other columns."""
    return dedupe_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


QUERIES = {
    "upsert_silver": upsert_silver,
    "upsert_gold": upsert_gold,
    "upsert_null_keys": upsert_null_keys,
    "full_replace": full_replace,
    "dedupe_latest": dedupe_latest_q,
}

_O = ("o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus AS O_ORDERSTATUS, "
      "o_totalprice AS O_TOTALPRICE, o_orderdate AS O_ORDERDATE")

ORACLE = {
    "upsert_silver": f"""
        WITH t AS (SELECT {_O} FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
             s AS (SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY,
                          lower(o_orderstatus) AS O_ORDERSTATUS, o_totalprice + 1.0 AS O_TOTALPRICE,
                          o_orderdate AS O_ORDERDATE
                   FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
        SELECT t.*, {audit_sql()} FROM t WHERE O_ORDERKEY NOT IN (SELECT O_ORDERKEY FROM s)
        UNION ALL
        SELECT s.*, {audit_sql(RUN_ID, NOW, RUN_ID_2, NOW_2)} FROM s JOIN t USING (O_ORDERKEY)
        UNION ALL
        SELECT s.*, {audit_sql(RUN_ID_2, NOW_2)} FROM s WHERE O_ORDERKEY NOT IN (SELECT O_ORDERKEY FROM t)""",
    "upsert_gold": f"""
        WITH t AS (SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY,
                          s_acctbal AS S_ACCTBAL FROM supplier WHERE s_nationkey < 15),
             s AS (SELECT s_suppkey AS S_SUPPKEY, s_name || '/v2' AS S_NAME, s_nationkey + 50 AS S_NATIONKEY,
                          s_acctbal + 100.0 AS S_ACCTBAL FROM supplier WHERE s_nationkey >= 10)
        SELECT t.*, {audit_sql()} FROM t WHERE S_SUPPKEY NOT IN (SELECT S_SUPPKEY FROM s)
        UNION ALL
        SELECT s.S_SUPPKEY, s.S_NAME, t.S_NATIONKEY, s.S_ACCTBAL, {audit_sql(RUN_ID, NOW, RUN_ID_2, NOW_2)}
        FROM s JOIN t ON s.S_SUPPKEY = t.S_SUPPKEY
        UNION ALL
        SELECT s.*, {audit_sql(RUN_ID_2, NOW_2)} FROM s WHERE S_SUPPKEY NOT IN (SELECT S_SUPPKEY FROM t)""",
    "upsert_null_keys": f"""
        WITH k AS (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS C_CUSTKEY,
                          c_name AS C_NAME, c_nationkey AS C_NATIONKEY, c_acctbal AS C_ACCTBAL FROM customer),
             t AS (SELECT * FROM k WHERE C_NATIONKEY < 15),
             s AS (SELECT C_CUSTKEY, C_NAME, C_NATIONKEY, C_ACCTBAL + 1.0 AS C_ACCTBAL FROM k WHERE C_NATIONKEY >= 10)
        SELECT t.*, {audit_sql()} FROM t
          WHERE t.C_CUSTKEY IS NULL OR NOT EXISTS (SELECT 1 FROM s WHERE s.C_CUSTKEY = t.C_CUSTKEY)
        UNION ALL
        SELECT s.*, {audit_sql(RUN_ID, NOW, RUN_ID_2, NOW_2)} FROM s
          WHERE EXISTS (SELECT 1 FROM t WHERE s.C_CUSTKEY = t.C_CUSTKEY)
        UNION ALL
        SELECT s.*, {audit_sql(RUN_ID_2, NOW_2)} FROM s
          WHERE s.C_CUSTKEY IS NULL OR NOT EXISTS (SELECT 1 FROM t WHERE s.C_CUSTKEY = t.C_CUSTKEY)""",
    "full_replace": f"""
        SELECT p_partkey, p_name, p_retailprice, {audit_sql(RUN_ID_2, NOW_2)},
               (SELECT count(*) FROM part) AS ROWS_WRITTEN
        FROM part""",
    "dedupe_latest": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
}
