"""Plan shapes that the design relies on at scale."""

from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest
from strata.operators.keys import dense_number
from strata.operators.transform import conform, stamp_audit
from strata.operators.upsert import upsert
from strata.queries.upsert import ORDER_COLS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_aggregates_map_side(spark):
    p = plan(dedupe_latest(spark.read.parquet(f"{SF}/lineitem.parquet"), ["l_orderkey", "l_linenumber"],
                           ["l_shipdate"]))
    assert "partial_max" in p and "Window" not in p


def test_upsert_has_no_full_outer_join(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(*ORDER_COLS)
    p = plan(upsert(stamp_audit(o, "a"), o.where(F.col("o_orderdate") > "1999-01-01"), ["o_orderkey"],
                    run_id="b", check=False))
    assert "FullOuter" not in p and "LeftAnti" in p and "LeftSemi" in p


def test_range_numbering_has_no_global_window(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(dense_number(o, ["o_orderdate", "o_orderkey"], "K", deterministic_input=True))
    assert "row_number" not in p  # positions come from the range-partitioned, sorted write


def test_filters_and_columns_reach_the_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])
    p = plan(conform(o.where(F.col("o_totalprice") > 1000), schema))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_incremental_silver_reads_new_batches_only(spark, workdir):
    from strata.sources.tables import LayerTable

    bronze = LayerTable(spark, f"{workdir}/b").create(spark.range(0).schema)
    bronze.append(spark.range(3))
    old = bronze.batches()
    bronze.append(spark.range(5))
    new = [x for x in bronze.batches() if x not in old]
    rows = bronze.read_batches(new)
    assert rows.count() == 5 and all(new[0] in f for f in rows.inputFiles())
    assert bronze.read_batches(bronze.batches()).count() == 8 and bronze.read_batches([]).count() == 0


def test_hot_key_of_an_upsert_is_split(spark):
    """AQE may split the hot key of the target (its keys alone compress too well to pass a threshold here)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).selectExpr("IF(id % 3 = 0, 1, id) AS k", "concat('v', id * 7919) AS v")
        target = stamp_audit(rows.repartition(16), "a")
        out = upsert(target, spark.range(1, 500).selectExpr("id AS k", "'new' AS v"), ["k"], run_id="b", check=False)
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_upsert_reads_one_shuffle_of_a_deduplicated_source(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(*ORDER_COLS)
    src = dedupe_latest(stamp_audit(o, "b", None, ("ADDED_BY", "ADDED_ON")), ["o_orderkey"], ["ADDED_ON"])
    out = upsert(stamp_audit(o.where(F.col("o_orderdate") < "1996-01-01"), "a"),
                 src.drop("ADDED_BY", "ADDED_ON"), ["o_orderkey"], run_id="b", check=False)
    with_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert out.count() == o.count()
        out.collect()  # the dataset's own adaptive plan is final after an action on it
        assert "ReusedExchange" in plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast)


def test_rows_of_a_run_prune_other_folders(spark, workdir):
    from strata.sources.tables import LayerTable, read_run

    t = LayerTable(spark, f"{workdir}/runs").create(spark.createDataFrame([], "a int, ADDED_BY string").schema)
    row = lambda a, run: spark.createDataFrame([(a, run)], "a int, ADDED_BY string")
    for a, run in ((1, "r1"), (2, "r2"), (3, "r1")):
        t.append(row(a, run), run)
    t.append(row(4, "r1"))              # without a mark: the column decides
    t.append(row(5, "r3"))
    rows = read_run(t, "r1")
    p = plan(rows)
    assert "PartitionFilters: [" in p and "StartsWith(batch" in p
    assert sorted(r.a for r in rows.collect()) == [1, 3, 4]
    t.replace(t.read())                 # rows beside the batches
    t.append(row(6, "r1"), "r1")
    assert sorted(r.a for r in read_run(t, "r1").collect()) == [1, 3, 4, 6] and read_run(t, "r9").count() == 0
    empty = LayerTable(spark, f"{workdir}/none").create(t.schema)
    assert read_run(empty, "r1").count() == 0
