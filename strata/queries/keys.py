"""Key queries: scaled dense numbering (W1) and key retention across batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.keys import assign_keys, dense_number
from strata.queries.common import table


def dense_keys(spark, sf_dir):
    """Orders numbered 1..N by (order date, order key) by range partitions;
    the order is unique, so one table is staged."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return dense_number(o, ["o_orderdate", "o_orderkey"], "ORDER_KEY", total_order=True)


def key_retention(spark, sf_dir):
    """Orders before 1998 keyed first; all orders keyed again: old keys kept, new ones max + n."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderdate").alias("O_ORDERDATE"))
    first = dense_number(o.where(F.col("O_ORDERDATE") < "1998-01-01"), ["O_ORDERKEY"], "ORDER_KEY", total_order=True)
    return assign_keys(o, first.select("O_ORDERKEY", "ORDER_KEY"), ["O_ORDERKEY"], "ORDER_KEY",
                       order_by=["O_ORDERKEY"])


QUERIES = {"dense_keys": dense_keys, "key_retention": key_retention}

ORACLE = {
    "dense_keys": """
        SELECT o_orderkey, o_orderdate, o_totalprice,
               CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS ORDER_KEY
        FROM orders""",
    "key_retention": """
        WITH old AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k
                     FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
             mx AS (SELECT max(k) AS m FROM old),
             fresh AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + (SELECT m FROM mx) AS k
                       FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old))
        SELECT o.o_orderkey AS O_ORDERKEY, o.o_orderdate AS O_ORDERDATE,
               CAST(coalesce(old.k, fresh.k) AS BIGINT) AS ORDER_KEY
        FROM orders o LEFT JOIN old USING (o_orderkey) LEFT JOIN fresh USING (o_orderkey)""",
}
