"""Queries of loads that run more than once: late and odd files, changed layouts, repeated
entities, kept keys, bad keys, shared targets and hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.marts import DimensionLookup, build_dimension, build_fact
from strata.operators.transform import stamp_audit
from strata.operators.upsert import upsert
from strata.plans.jobs import GoldBuilder, LoadContext, create_tables, run_bronze, run_gold, run_silver
from strata.queries.common import NOW, NOW_2, RUN_ID, RUN_ID_2, audit_sql, table
from strata.queries.e2e import BRONZE, CUSTOMER_STREAM_TARGET, GOLD, SILVER
from strata.schemas import EDW_CONFIG, OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION
from strata.session import scratch_dir
from strata.sources.csv import REJECTS, load_csv_folder, write_csv
from strata.sources.tables import Lakehouse, LayerTable
from strata.streaming.ingest import ingest_into_table


def drop_files(spark, df, folder: str, name: str, days_old: int = 0) -> None:
    """Write ``df`` as headed CSV files named ``name`` with ``{i}`` counted, optionally with an old file time."""
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(write_csv(df, scratch_dir(spark, "drop")))
    fs = tmp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    for i, f in enumerate(s for s in fs.listStatus(tmp) if s.getPath().getName().endswith(".csv")):
        to = jvm.org.apache.hadoop.fs.Path(folder, name.replace("{i}", str(i)))
        fs.rename(f.getPath(), to)
        if days_old:
            fs.setTimes(to, f.getModificationTime() - days_old * 86_400_000, -1)


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("C Name"),
        F.col("c_nationkey").alias("C NationKey"), F.col("c_acctbal").alias("C AcctBal"),
        F.col("c_mktsegment").alias("C MktSegment"))


def incremental_late_files(spark, sf_dir):
    """Customers in three drops: files a month older than those loaded, and files without the
    usual suffix, are loaded by the run that first sees them."""
    root = scratch_dir(spark, "late")
    src, bronze = f"{root}/in", LayerTable(spark, f"{root}/bronze").create(CUSTOMER_STREAM_TARGET)
    c = _customers(spark, sf_dir)
    kw = dict(checkpoint_dir=f"{root}/_checkpoint", archive_dir=f"{root}/archive")
    drop_files(spark, c.where("`C NationKey` < 10"), src, "part {i}.csv")
    ingest_into_table(spark, src, bronze, run_id=RUN_ID, now=NOW, **kw)
    drop_files(spark, c.where("`C NationKey` BETWEEN 10 AND 17"), src, "OLD {i}.CSV", days_old=30)
    drop_files(spark, c.where("`C NationKey` > 17"), src, "late{i}.txt", days_old=12)
    ingest_into_table(spark, src, bronze, run_id=RUN_ID_2, now=NOW_2, **kw)
    ingest_into_table(spark, src, bronze, run_id="run-0003", now=NOW_2, **kw)  # nothing new
    return bronze.read()


def csv_layout_change(spark, sf_dir):
    """Customers under three headers (reordered, wider, narrower) and odd file names, loaded plain and incrementally."""
    root = scratch_dir(spark, "layouts")
    c = _customers(spark, sf_dir)
    target = T.StructType([f for f in CUSTOMER_STREAM_TARGET if f.name != "C_MKTSEGMENT"])
    kw = dict(run_id=RUN_ID, now=NOW)

    def first(folder):
        drop_files(spark, c.where("`C NationKey` < 8"), folder, "Sales Day [{i}].csv")
        drop_files(spark, c.where("`C NationKey` BETWEEN 8 AND 12").select("C Name", "C AcctBal", "C Custkey", "C NationKey", "C MktSegment"),
                   folder, "S{x}%20{i}+a.csv")

    def second(folder):
        drop_files(spark, c.where("`C NationKey` BETWEEN 13 AND 18").withColumn("Extra", F.lit("e")), folder, "wide {i}.csv")
        drop_files(spark, c.where("`C NationKey` > 18").drop("C MktSegment"), folder, "narrow{i}.data")

    plain = LayerTable(spark, f"{root}/plain").create(target)
    first(f"{root}/a")
    second(f"{root}/a")
    load_csv_folder(spark, f"{root}/a", plain, **kw)
    step = LayerTable(spark, f"{root}/step").create(target)
    first(f"{root}/b")
    ingest_into_table(spark, f"{root}/b", step, f"{root}/_checkpoint", **kw)
    second(f"{root}/b")
    ingest_into_table(spark, f"{root}/b", step, f"{root}/_checkpoint", **kw)
    return (plain.read().withColumn("HOW", F.lit("plain"))
            .unionByName(step.read().withColumn("HOW", F.lit("incremental"))))


def csv_nested_folders(spark, sf_dir):
    """Customers in subfolders two deep and under hidden names, in three layouts, loaded plain and incrementally."""
    root = scratch_dir(spark, "nested")
    c = _customers(spark, sf_dir)
    target = T.StructType([f for f in CUSTOMER_STREAM_TARGET if f.name != "C_MKTSEGMENT"])
    kw = dict(run_id=RUN_ID, now=NOW, hidden=True)

    def first(folder):
        drop_files(spark, c.where("`C NationKey` < 5"), folder, "top {i}.csv")
        drop_files(spark, c.where("`C NationKey` BETWEEN 5 AND 9").select("C AcctBal", "C NationKey", "C Name", "C Custkey"), f"{folder}/day=1/[a]", "deep{i}.csv")
        drop_files(spark, c.where("`C NationKey` BETWEEN 10 AND 13"), f"{folder}/day=1", "_late{i}.csv")

    def second(folder):
        drop_files(spark, c.where("`C NationKey` BETWEEN 14 AND 18").withColumn("Extra", F.lit("e")), f"{folder}/day=2", "x{i}.csv")
        drop_files(spark, c.where("`C NationKey` > 18"), f"{folder}/_held/more", ".z{i}.csv")

    plain = LayerTable(spark, f"{root}/plain").create(target)
    first(f"{root}/a")
    second(f"{root}/a")
    load_csv_folder(spark, f"{root}/a", plain, **kw)
    step = LayerTable(spark, f"{root}/step").create(target)
    for drop in (first, second, lambda folder: None):
        drop(f"{root}/b")
        ingest_into_table(spark, f"{root}/b", step, f"{root}/_checkpoint", **kw)
    return (plain.read().withColumn("HOW", F.lit("plain"))
            .unionByName(step.read().withColumn("HOW", F.lit("incremental"))))


def csv_rejects(spark, sf_dir):
    """Suppliers as lines of which some have a value too many or too few: the surplus goes to the reject
    table whole, the short lines are padded; two layouts, loaded plain and incrementally."""
    root = scratch_dir(spark, "rejects")
    sup = table(spark, sf_dir, "supplier")
    quoted = F.concat(F.lit('"'), F.col("s_name"), F.lit(', Ltd"'))
    tail = F.when(F.col("s_suppkey") % 7 == 3, ",surplus").otherwise("")
    wide = F.concat_ws(",", "s_suppkey", quoted, F.when(F.col("s_suppkey") % 5 != 1, F.col("s_nationkey").cast("string")))
    turned = F.concat_ws(",", "s_nationkey", "s_suppkey", quoted)
    for name, some, line, head in (("a", sup.where("s_suppkey % 2 = 0"), F.concat(wide, F.when(F.col("s_suppkey") % 5 != 1, tail).otherwise("")), "S Suppkey,S Name,S NationKey"),
                                   ("b", sup.where("s_suppkey % 2 = 1"), F.concat(turned, tail), "S NationKey,S Suppkey,S Name")):
        lines = spark.createDataFrame([(head,)], "value string").unionByName(some.select(line.alias("value")))
        lines.coalesce(1).write.text(f"{root}/in/{name}")
    target = T.StructType([T.StructField("S_SUPPKEY", T.LongType()), T.StructField("S_NAME", T.StringType()),
                           T.StructField("S_NATIONKEY", T.IntegerType())])
    out = []
    for how in ("plain", "incremental"):
        t, bad = LayerTable(spark, f"{root}/{how}").create(target), LayerTable(spark, f"{root}/{how}-rejects").create(REJECTS)
        if how == "plain":
            load_csv_folder(spark, f"{root}/in", t, run_id=RUN_ID, now=NOW, rejects=bad)
        else:
            ingest_into_table(spark, f"{root}/in", t, f"{root}/_checkpoint", run_id=RUN_ID, now=NOW, rejects=bad)
        out += [t.read().withColumn("HOW", F.lit(how)), bad.read().select("HEADER", "VALUE_COUNT", "RECORD", "ADDED_BY").withColumn("HOW", F.lit(how))]
    return out[0].unionByName(out[1], True).unionByName(out[2], True).unionByName(out[3], True)


def dim_rerun(spark, sf_dir):
    """A dimension over a natural key that repeats in the source, built and merged three times."""
    gold = LayerTable(spark, scratch_dir(spark, "dim_rerun"))
    schema = T.StructType([T.StructField("PART_KEY", T.LongType()), T.StructField("BRAND", T.StringType()), T.StructField("KIND", T.StringType()),
                           *[f for f in CUSTOMER_STREAM_TARGET if f.name.startswith("ADDED")],
                           T.StructField("MODIFIED_BY", T.StringType()), T.StructField("MODIFIED_ON", T.TimestampType())])
    gold.create(schema)
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("BRAND"), F.col("p_type").alias("KIND"))
    for run, now in ((RUN_ID, NOW), (RUN_ID_2, NOW_2), ("run-0003", NOW_2)):
        some = part.where("BRAND < 'Brand#4'") if run == RUN_ID else part      # the later runs bring new brands
        dim = build_dimension(some, ["BRAND", "KIND"], "PART_KEY", ["BRAND", "KIND"], run_id=run, now=now, schema=schema,
                              existing=gold.read(), natural_key=["BRAND", "KIND"])
        gold.replace(upsert(gold.read(), dim, ["BRAND", "KIND"], run_id=run, now=now, update_columns=[]))
    return gold.read()


def _dim(ctx):
    return build_dimension(
        ctx.lake.table("silver", "CUSTOMER").read(), ["CUSTOMER_ID", "CUSTOMER_NAME", "SEGMENT"], key="CUSTOMER_KEY",
        order_by=["CUSTOMER_ID"], run_id=ctx.run_id, now=ctx.now, schema=GOLD[("gold", "DIM_CUSTOMER")],
        existing=ctx.lake.table("gold", "DIM_CUSTOMER").read(), natural_key=["CUSTOMER_ID"])


def _fact(ctx):
    return build_fact(
        ctx.lake.table("silver", "ORDERS").read(), ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "AMOUNT"],
        [DimensionLookup(ctx.lake.table("gold", "DIM_CUSTOMER").read(), "CUSTOMER_ID", "CUSTOMER_ID", "CUSTOMER_KEY")],
        key="ORDER_KEY", order_by=["ORDER_ID"], run_id=ctx.run_id, now=ctx.now, schema=GOLD[("gold", "FACT_ORDERS")],
        existing=ctx.lake.table("gold", "FACT_ORDERS").read(), natural_key=["ORDER_ID"])


def gold_rerun(spark, sf_dir):
    """A dimension and a fact merged twice by the gold job on natural keys: old rows keep their
    surrogate keys and ADDED_*; new customers and orders sort before old ones."""
    lake = Lakehouse(spark, f"{scratch_dir(spark, 'gold_rerun')}/tables")
    create_tables(lake, {**GOLD, ("silver", "CUSTOMER"): SILVER[("silver", "CUSTOMER")], ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CUSTOMER_ID"), F.col("c_name").alias("CUSTOMER_NAME"),
        F.col("c_nationkey").cast("int").alias("NATION_ID"), F.col("c_acctbal").alias("BALANCE"), F.col("c_mktsegment").alias("SEGMENT"))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"), F.col("o_custkey").alias("CUSTOMER_ID"), F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").alias("AMOUNT"), F.col("o_orderdate").alias("ORDER_DATE"))
    edw = spark.createDataFrame([
        ("DIM_CUSTOMER", "upsert", "CUSTOMER_ID", "gold", "edw", "CUSTOMER_KEY, CUSTOMER_ID, CUSTOMER_NAME, SEGMENT", 0, 1),
        ("FACT_ORDERS", "upsert", "ORDER_ID", "gold", "edw", "", 0, 1)], EDW_CONFIG)
    builders = [GoldBuilder("DIM_CUSTOMER", _dim, "dimension", "CUSTOMER_KEY"), GoldBuilder("FACT_ORDERS", _fact, "fact", "ORDER_KEY")]
    late = F.col("ORDER_DATE") >= "1996-01-01"
    for run, now, cust, orders in ((RUN_ID, NOW, c.where("NATION_ID >= 8"), o.where(late)),
                                   (RUN_ID_2, NOW_2, c, o.withColumn("AMOUNT", F.when(late, F.col("AMOUNT") + 8.0).otherwise(F.col("AMOUNT"))))):
        lake.table("silver", "CUSTOMER").replace(stamp_audit(cust, run, now))
        lake.table("silver", "ORDERS").replace(stamp_audit(orders, run, now))
        run_gold(LoadContext(spark, lake, "", run, now), edw, builders)
    dim = lake.table("gold", "DIM_CUSTOMER").read().select("CUSTOMER_KEY", F.col("ADDED_BY").alias("DIM_ADDED_BY"), F.col("CUSTOMER_ID").alias("CUST"))
    return lake.table("gold", "FACT_ORDERS").read().join(dim, "CUSTOMER_KEY", "left")


_MAPPING = [("erp", "ORDERS", "ORDER_KEY", "ORDER_ID", "bigint", None), ("erp", "ORDERS", "CUST_KEY", "CUSTOMER_ID", "bigint", None),
            ("erp", "ORDERS", "ORDER_STATUS", "STATUS", "string", None), ("erp", "ORDERS", "TOTAL_PRICE", "AMOUNT", "double", None),
            ("erp", "ORDERS", "ORDER_DATE", "ORDER_DATE", "timestamp", None)]


def _bronze_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("ORDER_KEY"), F.col("o_custkey").cast("string").alias("CUST_KEY"),
                    F.col("o_orderstatus").alias("ORDER_STATUS"), F.col("o_totalprice").alias("TOTAL_PRICE"), F.col("o_orderdate").alias("ORDER_DATE"))


def _text(df):
    return df.withColumn("TOTAL_PRICE", F.col("TOTAL_PRICE").cast("string")).withColumn("ORDER_DATE", F.col("ORDER_DATE").cast("string"))


def _object(name, bronze):
    return (name, "erp", name.lower(), name.lower(), None, bronze, "ORDERS", "upsert", "ORDER_ID", 0, 1)


def silver_bad_keys(spark, sf_dir):
    """Orders with keys that are no numbers: good rows reach silver, the others the reject table, none is lost."""
    lake = Lakehouse(spark, f"{scratch_dir(spark, 'bad_keys')}/tables")
    create_tables(lake, {("bronze", "ORDERS"): BRONZE[("bronze", "ORDERS")], ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    o = _bronze_orders(spark, sf_dir)
    o = o.withColumn("ORDER_KEY", F.when(F.col("CUST_KEY").cast("long") % 7 == 3, F.concat(F.lit("x"), "ORDER_KEY")).otherwise(F.col("ORDER_KEY")))
    lake.table("bronze", "ORDERS").append(stamp_audit(_text(o), RUN_ID, NOW, ("ADDED_BY", "ADDED_ON")))
    run_silver(LoadContext(spark, lake, "", RUN_ID, NOW), spark.createDataFrame([_object("ORDERS", "ORDERS")], OBJECTS_CONFIGURATION),
               spark.createDataFrame(_MAPPING, OBJECTS_COLUMN_MAPPING))
    rejected = lake.table("silver_rejects", "ORDERS").read().agg(F.count(F.lit(1)).alias("REJECTED"))
    return lake.table("silver", "ORDERS").read().join(rejected)      # one row


def two_sources_one_silver(spark, sf_dir):
    """Two objects with one silver table, four workers: loaded in config order, the later one wins."""
    lake = Lakehouse(spark, f"{scratch_dir(spark, 'two_sources')}/tables")
    create_tables(lake, {("bronze", "A"): BRONZE[("bronze", "ORDERS")], ("bronze", "B"): BRONZE[("bronze", "ORDERS")],
                         ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    o = _bronze_orders(spark, sf_dir)
    audit = ("ADDED_BY", "ADDED_ON")
    lake.table("bronze", "A").append(stamp_audit(_text(o.where(F.col("ORDER_DATE") < "1997-01-01")), RUN_ID, NOW, audit))
    later = o.where(F.col("ORDER_DATE") >= "1995-01-01").withColumn("TOTAL_PRICE", F.col("TOTAL_PRICE") + 5.0)
    lake.table("bronze", "B").append(stamp_audit(_text(later), RUN_ID, NOW, audit))
    mapping = [(a, n, *rest) for n in ("ORDERS_A", "ORDERS_B") for a, _, *rest in _MAPPING]
    run_silver(LoadContext(spark, lake, "", RUN_ID, NOW, workers=4),
               spark.createDataFrame([_object("ORDERS_A", "A"), _object("ORDERS_B", "B")], OBJECTS_CONFIGURATION).coalesce(1),
               spark.createDataFrame(mapping, OBJECTS_COLUMN_MAPPING))
    return lake.table("silver", "ORDERS").read()


def bronze_two_runs(spark, sf_dir):
    """Silver takes in bronze batches, not timestamps: a second batch with the same time is loaded too."""
    lake = Lakehouse(spark, f"{scratch_dir(spark, 'same_time')}/tables")
    create_tables(lake, {("bronze", "ORDERS"): BRONZE[("bronze", "ORDERS")], ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    o = _text(_bronze_orders(spark, sf_dir))
    objects = spark.createDataFrame([_object("ORDERS", "ORDERS")], OBJECTS_CONFIGURATION)
    mapping = spark.createDataFrame(_MAPPING, OBJECTS_COLUMN_MAPPING)
    for run, some in ((RUN_ID, o.where("ORDER_STATUS = 'F'")), (RUN_ID_2, o.where("ORDER_STATUS <> 'F'"))):
        lake.table("bronze", "ORDERS").append(stamp_audit(some, run, NOW, ("ADDED_BY", "ADDED_ON")))
        run_silver(LoadContext(spark, lake, "", run, NOW), objects, mapping)
    return lake.table("silver", "ORDERS").read()


def upsert_hot_key(spark, sf_dir):
    """Line items keyed by supplier, a third of them on one key, updated from suppliers."""
    line = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_orderkey") % 11 == 0, F.lit(None))
        .otherwise(F.col("l_suppkey")).cast("long").alias("K"),
        F.col("l_orderkey").alias("ORDER_ID"), F.col("l_linenumber").cast("int").alias("LINE"), F.col("l_quantity").alias("V"))
    sup = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 1").select(F.col("s_suppkey").cast("long").alias("K"), F.col("s_acctbal").alias("V"))
    target = stamp_audit(line, RUN_ID, NOW)
    return upsert(target, sup, ["K"], run_id=RUN_ID_2, now=NOW_2)


QUERIES = {f.__name__: f for f in (incremental_late_files, csv_layout_change, csv_nested_folders, csv_rejects, dim_rerun, gold_rerun, silver_bad_keys,
                                   two_sources_one_silver, bronze_two_runs, upsert_hot_key)}

_CUST = ("c_custkey AS C_CUSTKEY, c_name AS C_NAME, CAST(c_nationkey AS INTEGER) AS C_NATIONKEY, "
         "CAST(c_acctbal AS DOUBLE) AS C_ACCTBAL")
_SILVER = ("CAST(o_orderkey AS BIGINT) AS ORDER_ID, CAST(o_custkey AS BIGINT) AS CUSTOMER_ID, o_orderstatus AS STATUS, "
           "CAST({price} AS DOUBLE) AS AMOUNT, CAST(o_orderdate AS TIMESTAMP) AS ORDER_DATE")

ORACLE = {
    "incremental_late_files": f"""
        SELECT {_CUST}, c_mktsegment AS C_MKTSEGMENT,
               CASE WHEN c_nationkey < 10 THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS ADDED_BY,
               CASE WHEN c_nationkey < 10 THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{NOW_2}' END AS ADDED_ON
        FROM customer""",
    "csv_layout_change": f"""
        SELECT {_CUST}, '{RUN_ID}' AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON, HOW
        FROM customer, (VALUES ('plain'), ('incremental')) AS h(HOW)""",
    "csv_nested_folders": f"""
        SELECT {_CUST}, '{RUN_ID}' AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON, HOW
        FROM customer, (VALUES ('plain'), ('incremental')) AS h(HOW)""",
    "csv_rejects": f"""
        WITH s AS (SELECT *, s_suppkey % 2 = 0 AS wide, s_suppkey % 7 = 3 AND (s_suppkey % 2 = 1 OR s_suppkey % 5 <> 1) AS bad,
                          '"' || s_name || ', Ltd"' AS q FROM supplier)
        SELECT CASE WHEN bad THEN NULL ELSE CAST(s_suppkey AS BIGINT) END AS S_SUPPKEY,
               CASE WHEN bad THEN NULL ELSE s_name || ', Ltd' END AS S_NAME,
               CASE WHEN bad OR (wide AND s_suppkey % 5 = 1) THEN NULL ELSE CAST(s_nationkey AS INTEGER) END AS S_NATIONKEY, HOW,
               CASE WHEN bad THEN CASE WHEN wide THEN 'S Suppkey,S Name,S NationKey' ELSE 'S NationKey,S Suppkey,S Name' END END AS HEADER,
               CASE WHEN bad THEN CAST(4 AS INTEGER) END AS VALUE_COUNT,
               CASE WHEN bad THEN CASE WHEN wide THEN s_suppkey || ',' || q || ',' || s_nationkey || ',surplus'
                                       ELSE s_nationkey || ',' || s_suppkey || ',' || q || ',surplus' END END AS RECORD,
               CASE WHEN bad THEN '{RUN_ID}' END AS ADDED_BY
        FROM s, (VALUES ('plain'), ('incremental')) AS h(HOW)""",
    "dim_rerun": f"""
        WITH d AS (SELECT DISTINCT p_brand AS BRAND, p_type AS KIND, p_brand < 'Brand#4' AS early FROM part)
        SELECT CAST(row_number() OVER (ORDER BY CASE WHEN early THEN 0 ELSE 1 END, BRAND, KIND) AS BIGINT) AS PART_KEY,
               BRAND, KIND,
               CASE WHEN early THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS ADDED_BY,
               CASE WHEN early THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{NOW_2}' END AS ADDED_ON,
               'run-0003' AS MODIFIED_BY, TIMESTAMP '{NOW_2}' AS MODIFIED_ON
        FROM d""",
    "gold_rerun": f"""
        WITH c AS (SELECT c_custkey, c_nationkey >= 8 AS early,
                          row_number() OVER (ORDER BY CASE WHEN c_nationkey >= 8 THEN 0 ELSE 1 END, c_custkey) AS k FROM customer),
             o AS (SELECT *, o_orderdate >= TIMESTAMP '1996-01-01' AS early FROM orders)
        SELECT CAST(row_number() OVER (ORDER BY CASE WHEN o.early THEN 0 ELSE 1 END, o_orderkey) AS BIGINT) AS ORDER_KEY,
               o_orderkey AS ORDER_ID, CAST(c.k AS BIGINT) AS CUSTOMER_KEY, CAST(o_orderdate AS TIMESTAMP) AS ORDER_DATE,
               CAST(o_totalprice + CASE WHEN o.early THEN 8.0 ELSE 0.0 END AS FLOAT) AS AMOUNT,
               CASE WHEN o.early THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS ADDED_BY,
               CASE WHEN o.early THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{NOW_2}' END AS ADDED_ON,
               '{RUN_ID_2}' AS MODIFIED_BY, TIMESTAMP '{NOW_2}' AS MODIFIED_ON,
               CASE WHEN c.k IS NULL THEN NULL WHEN c.early THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS DIM_ADDED_BY, c.c_custkey AS CUST
        FROM o LEFT JOIN c ON o_custkey = c_custkey""",
    "silver_bad_keys": f"""
        SELECT {_SILVER.format(price="o_totalprice")}, {audit_sql()},
               (SELECT count(*) FROM orders WHERE o_custkey % 7 = 3) AS REJECTED
        FROM orders WHERE o_custkey % 7 <> 3""",
    "two_sources_one_silver": f"""
        SELECT {_SILVER.format(price="o_totalprice + CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' THEN 5.0 ELSE 0.0 END")},
               {audit_sql()}
        FROM orders""",
    "bronze_two_runs": f"""
        SELECT {_SILVER.format(price="o_totalprice")},
               r AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON, r AS MODIFIED_BY, TIMESTAMP '{NOW}' AS MODIFIED_ON
        FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS r FROM orders)""",
    "upsert_hot_key": f"""
        WITH t AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_suppkey END AS K,
                          l_orderkey AS ORDER_ID, CAST(l_linenumber AS INTEGER) AS LINE, CAST(l_quantity AS DOUBLE) AS V FROM lineitem),
             s AS (SELECT s_suppkey AS K, CAST(s_acctbal AS DOUBLE) AS V FROM supplier WHERE s_suppkey % 2 = 1)
        SELECT CAST(t.K AS BIGINT) AS K, ORDER_ID, LINE, CASE WHEN s.K IS NULL THEN t.V ELSE s.V END AS V,
               '{RUN_ID}' AS ADDED_BY, TIMESTAMP '{NOW}' AS ADDED_ON,
               CASE WHEN s.K IS NULL THEN '{RUN_ID}' ELSE '{RUN_ID_2}' END AS MODIFIED_BY,
               CASE WHEN s.K IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{NOW_2}' END AS MODIFIED_ON
        FROM t LEFT JOIN s ON t.K = s.K
        UNION ALL
        SELECT CAST(K AS BIGINT), NULL, NULL, V, '{RUN_ID_2}', TIMESTAMP '{NOW_2}', '{RUN_ID_2}', TIMESTAMP '{NOW_2}'
        FROM s WHERE K NOT IN (SELECT K FROM t WHERE K IS NOT NULL)""",
}
