"""Queries of merges: touched partitions only, batches in any order, batches taken in twice, counts by kind."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators.partitions import upsert_partitions
from strata.operators.transform import stamp_audit
from strata.operators.upsert import ROW_KINDS, upsert
from strata.plans.jobs import LoadContext, consumed_table, create_tables, run_silver
from strata.queries.common import NOW, NOW_2, RUN_ID, RUN_ID_2, audit_sql, table
from strata.queries.e2e import BRONZE, SILVER
from strata.queries.rerun import _MAPPING, _SILVER, _bronze_orders, _object, _text
from strata.schemas import OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION
from strata.session import scratch_dir
from strata.sources.partitioned import PartitionedTable
from strata.sources.tables import Lakehouse, LayerTable


def upsert_partitions_q(spark, sf_dir):
    """Orders partitioned by year; 1998 repriced, some of them moved to 1997. FILES_KEPT counts the
    partitions whose files are the same as before."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_custkey").alias("O_CUSTKEY"), F.col("o_totalprice").alias("O_TOTALPRICE"),
        F.col("o_orderdate").alias("O_ORDERDATE"), F.year("o_orderdate").alias("O_YEAR"))
    t = PartitionedTable(spark, scratch_dir(spark, "orders_by_year"), ["O_YEAR"])
    old = stamp_audit(o.where("O_ORDERDATE < '1998-06-01'"), RUN_ID, NOW)
    t.create(old.schema).replace(old)
    files = lambda: t.read().select("O_YEAR", F.col("_metadata.file_path").alias("f")).distinct()
    before = {tuple(r) for r in files().collect()}
    source = (o.where("O_YEAR >= 1998").withColumn("O_TOTALPRICE", F.col("O_TOTALPRICE") + 1.0)
              .withColumn("O_YEAR", F.when(F.col("O_CUSTKEY") % 10 == 0, F.lit(1997)).otherwise(F.col("O_YEAR"))))
    upsert_partitions(t, source, ["O_ORDERKEY"], run_id=RUN_ID_2, now=NOW_2)
    after = {tuple(r) for r in files().collect()}
    kept = {y for y, _ in before & after} - {y for y, _ in before ^ after}
    return t.read().withColumn("FILES_KEPT", F.lit(len(kept)).cast("long"))


def _silver(spark, tag):
    lake = Lakehouse(spark, f"{scratch_dir(spark, tag)}/tables")
    create_tables(lake, {("bronze", "ORDERS"): BRONZE[("bronze", "ORDERS")], ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    return (lake, spark.createDataFrame([_object("ORDERS", "ORDERS")], OBJECTS_CONFIGURATION),
            spark.createDataFrame(_MAPPING, OBJECTS_COLUMN_MAPPING))


def silver_out_of_order(spark, sf_dir):
    """The newer bronze batch reaches silver first; the older one brings its other keys, and its rows of
    known keys do not replace newer ones."""
    lake, objects, mapping = _silver(spark, "out_of_order")
    o = _bronze_orders(spark, sf_dir)
    newer = o.where(F.col("ORDER_DATE") >= "1995-01-01").withColumn("TOTAL_PRICE", F.col("TOTAL_PRICE") + 7.0)
    for run, some, stamped in ((RUN_ID, newer, NOW_2), (RUN_ID_2, o.where(F.col("ORDER_DATE") < "1997-01-01"), NOW)):
        lake.table("bronze", "ORDERS").append(stamp_audit(_text(some), run, stamped, ("ADDED_BY", "ADDED_ON")))
        run_silver(LoadContext(spark, lake, "", run, NOW), objects, mapping)
    return lake.table("silver", "ORDERS").read()


def silver_replay(spark, sf_dir):
    """A run dies after it published silver: its batch, null keys included, is taken in again and adds nothing."""
    lake, objects, mapping = _silver(spark, "replay")
    o = _bronze_orders(spark, sf_dir)
    o = o.withColumn("ORDER_KEY", F.when(F.col("CUST_KEY").cast("long") % 9 == 2, F.lit(None)).otherwise(F.col("ORDER_KEY")))
    lake.table("bronze", "ORDERS").append(stamp_audit(_text(o), RUN_ID, NOW, ("ADDED_BY", "ADDED_ON")))
    run_silver(LoadContext(spark, lake, "", RUN_ID, NOW), objects, mapping)
    ctx = LoadContext(spark, lake, "", RUN_ID_2, NOW_2)
    done = consumed_table(ctx, "ORDERS")
    done.create(done.schema)        # the record of the batch is lost
    # without the kept winners too: the upsert alone has to recognise the null-key row
    lake.table("silver_order", "ORDERS--ORDERS").create(lake.table("silver_order", "ORDERS--ORDERS").schema)
    run_silver(LoadContext(spark, lake, "", RUN_ID, NOW), objects, mapping)
    return lake.table("silver", "ORDERS").read()


def upsert_replay(spark, sf_dir):
    """Customers with null keys, each of those twice in the batch: both stay, and taking the batch in again adds none."""
    cust = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("C_CUSTKEY"),
        F.col("c_nationkey").alias("C_NATIONKEY"), F.col("c_mktsegment").alias("C_MKTSEGMENT"))
    twice = cust.unionByName(cust.where("C_CUSTKEY IS NULL"))
    t = LayerTable(spark, scratch_dir(spark, "upsert_replay"))
    t.replace(stamp_audit(cust.where("C_NATIONKEY < 5"), RUN_ID, NOW))
    for _ in range(2):
        t.replace(upsert(t.read(), twice, ["C_CUSTKEY"], run_id=RUN_ID_2, now=NOW_2, null_keys="missing"))
    return t.read()


def upsert_counts(spark, sf_dir):
    """Rows of an upsert by kind, observed while it is written."""
    cust = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("C_CUSTKEY"),
        F.col("c_nationkey").alias("C_NATIONKEY"), F.col("c_acctbal").alias("C_ACCTBAL"))
    t = LayerTable(spark, scratch_dir(spark, "upsert_counts"))
    t.replace(stamp_audit(cust.where("C_NATIONKEY < 15"), RUN_ID, NOW))
    seen = Observation()
    written = t.replace(upsert(t.read(), cust.where("C_NATIONKEY >= 10"), ["C_CUSTKEY"], run_id=RUN_ID_2, now=NOW_2, counts=seen))
    rows = t.read()
    return rows.groupBy(F.col("C_NATIONKEY").alias("NATION")).agg(F.count(F.lit(1)).alias("ROWS")).select(
        "*", F.lit(written).cast("long").alias("WRITTEN"), *[F.lit(seen.get[k]).cast("long").alias(k.upper()) for k in ROW_KINDS])


QUERIES = {"upsert_partitions": upsert_partitions_q, "silver_out_of_order": silver_out_of_order, "silver_replay": silver_replay,
           "upsert_replay": upsert_replay, "upsert_counts": upsert_counts}

_KEYED = "SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS C_CUSTKEY, c_nationkey AS C_NATIONKEY"

ORACLE = {
    "upsert_partitions": f"""
        WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'),
             s AS (SELECT * FROM orders WHERE year(o_orderdate) >= 1998),
             r AS (SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY,
                          o_totalprice + CASE WHEN o_orderkey IN (SELECT o_orderkey FROM s) THEN 1.0 ELSE 0.0 END AS O_TOTALPRICE,
                          o_orderdate AS O_ORDERDATE,
                          CASE WHEN o_orderkey IN (SELECT o_orderkey FROM s) AND o_custkey % 10 = 0 THEN 1997
                               ELSE CAST(year(o_orderdate) AS INTEGER) END AS O_YEAR,
                          o_orderkey IN (SELECT o_orderkey FROM t) AS old, o_orderkey IN (SELECT o_orderkey FROM s) AS new
                   FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01' OR year(o_orderdate) >= 1998)
        SELECT O_ORDERKEY, O_CUSTKEY, O_TOTALPRICE, O_ORDERDATE, CAST(O_YEAR AS INTEGER) AS O_YEAR,
               CASE WHEN old THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS ADDED_BY,
               CASE WHEN old THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{NOW_2}' END AS ADDED_ON,
               CASE WHEN new THEN '{RUN_ID_2}' ELSE '{RUN_ID}' END AS MODIFIED_BY,
               CASE WHEN new THEN TIMESTAMP '{NOW_2}' ELSE TIMESTAMP '{NOW}' END AS MODIFIED_ON,
               (SELECT count(DISTINCT year(o_orderdate)) FROM t WHERE year(o_orderdate) < 1998
                  AND (year(o_orderdate) <> 1997 OR NOT EXISTS (SELECT 1 FROM s WHERE o_custkey % 10 = 0))) AS FILES_KEPT
        FROM r""",
    "silver_out_of_order": f"""
        SELECT {_SILVER.format(price="o_totalprice + CASE WHEN late THEN 7.0 ELSE 0.0 END")},
               r AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON, r AS MODIFIED_BY, TIMESTAMP '{NOW}' AS MODIFIED_ON
        FROM (SELECT *, o_orderdate >= TIMESTAMP '1995-01-01' AS late,
                     CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS r FROM orders)""",
    "silver_replay": f"""
        SELECT CASE WHEN o_custkey % 9 = 2 THEN NULL ELSE CAST(o_orderkey AS BIGINT) END AS ORDER_ID,
               CAST(o_custkey AS BIGINT) AS CUSTOMER_ID, o_orderstatus AS STATUS, CAST(o_totalprice AS DOUBLE) AS AMOUNT,
               CAST(o_orderdate AS TIMESTAMP) AS ORDER_DATE, {audit_sql()}
        FROM orders
        QUALIFY o_custkey % 9 <> 2 OR row_number() OVER (
            PARTITION BY o_custkey % 9 ORDER BY CAST(o_custkey AS BIGINT) DESC, o_orderstatus DESC, CAST(o_totalprice AS DOUBLE) DESC,
                     o_orderdate DESC) = 1""",
    "upsert_replay": f"""
        WITH k AS ({_KEYED}, c_mktsegment AS C_MKTSEGMENT FROM customer),
             b AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE C_CUSTKEY IS NULL),
             t AS (SELECT * FROM k WHERE C_NATIONKEY < 5),
             tn AS (SELECT *, row_number() OVER (PARTITION BY C_NATIONKEY, C_MKTSEGMENT) AS i FROM t WHERE C_CUSTKEY IS NULL),
             bn AS (SELECT *, row_number() OVER (PARTITION BY C_NATIONKEY, C_MKTSEGMENT) AS i FROM b WHERE C_CUSTKEY IS NULL)
        SELECT C_CUSTKEY, C_NATIONKEY, C_MKTSEGMENT, {audit_sql(RUN_ID, NOW, RUN_ID_2, NOW_2)} FROM t WHERE C_CUSTKEY IS NOT NULL
        UNION ALL
        SELECT C_CUSTKEY, C_NATIONKEY, C_MKTSEGMENT, {audit_sql()} FROM tn
        UNION ALL
        SELECT C_CUSTKEY, C_NATIONKEY, C_MKTSEGMENT, {audit_sql(RUN_ID_2, NOW_2)} FROM bn
          WHERE NOT EXISTS (SELECT 1 FROM tn WHERE tn.C_NATIONKEY = bn.C_NATIONKEY AND tn.C_MKTSEGMENT = bn.C_MKTSEGMENT AND tn.i = bn.i)
        UNION ALL
        SELECT C_CUSTKEY, C_NATIONKEY, C_MKTSEGMENT, {audit_sql(RUN_ID_2, NOW_2)} FROM k
          WHERE C_CUSTKEY IS NOT NULL AND C_NATIONKEY >= 5""",
    "upsert_counts": f"""
        WITH k AS ({_KEYED} FROM customer),
             t AS (SELECT * FROM k WHERE C_NATIONKEY < 15), s AS (SELECT * FROM k WHERE C_NATIONKEY >= 10),
             n AS (SELECT (SELECT count(*) FROM t WHERE C_CUSTKEY IN (SELECT C_CUSTKEY FROM s WHERE C_CUSTKEY IS NOT NULL)) AS u,
                          (SELECT count(*) FROM t) AS t,
                          (SELECT count(*) FROM s WHERE C_CUSTKEY NOT IN (SELECT C_CUSTKEY FROM t WHERE C_CUSTKEY IS NOT NULL)) AS i,
                          (SELECT count(*) FROM s WHERE C_CUSTKEY IS NULL) AS z),
             r AS (SELECT C_NATIONKEY FROM t UNION ALL
                   SELECT C_NATIONKEY FROM s WHERE C_CUSTKEY IS NULL OR C_CUSTKEY NOT IN (SELECT C_CUSTKEY FROM t WHERE C_CUSTKEY IS NOT NULL))
        SELECT C_NATIONKEY AS NATION, count(*) AS ROWS, any_value(n.t + n.i + n.z) AS WRITTEN, any_value(n.u) AS UPDATED,
               any_value(n.t - n.u) AS UNCHANGED, any_value(n.i) AS INSERTED, any_value(n.z) AS NULL_KEY
        FROM r, n GROUP BY C_NATIONKEY""",
}
