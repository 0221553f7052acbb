import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.keys import assign_keys, dense_number
from strata.operators.upsert import DuplicateKeyError
from strata.sources.tables import LayerTable


def test_dense_number_matches_window_with_ties_nulls_copies(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice(["a", "b", None])) for _ in range(500)]
    rows += [(2, "b")] * 300  # a hot group of identical rows
    df = spark.createDataFrame(rows, "x int, y string").repartition(5)
    out = dense_number(df, ["x", "y"], "K", rows_per_partition=50).collect()
    keys = sorted(r.K for r in out)
    assert keys == list(range(1, len(rows) + 1))
    # numbers follow the order: sorting by key gives a non-decreasing (x, y) sequence, nulls first
    norm = lambda v: (v is not None, v)
    seq = [(norm(r.x), norm(r.y)) for r in sorted(out, key=lambda r: r.K)]
    assert seq == sorted(seq)


@pytest.mark.parametrize("how", [{}, {"deterministic_input": True}, {"total_order": True}])
def test_dense_number_equals_row_number_on_total_order(spark, how):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("a"), (F.col("id") % 3).alias("b"))
    ours = {(r.a, r.b): r.K for r in
            dense_number(df, ["b", "a"], "K", **how).collect()}
    ref = {(r.a, r.b): r.K for r in df.withColumn("K", F.row_number().over(Window.orderBy("b", "a"))).collect()}
    assert ours == ref


def test_distinct_rows_are_numbered_by_one_join(spark):
    """No second pass over the rows looks for equal ones where the staged names show that there are none."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    df = spark.range(50).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    out = dense_number(df, ["a"], "K")
    assert "Union" not in plan(out) and sorted(r.K for r in out.collect()) == list(range(1, 51))
    twice = dense_number(df.union(df), ["a"], "K")
    assert "Union" in plan(twice) and sorted(r.K for r in twice.collect()) == list(range(1, 101))


@pytest.mark.parametrize("total_order", [False, True])
def test_dense_number_empty(spark, total_order):
    df = spark.createDataFrame([], "a int")
    out = dense_number(df, ["a"], "K", total_order=total_order)
    assert out.count() == 0 and out.columns == ["a", "K"]


def test_assign_keys_keeps_existing(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "n string, K long")
    batch = spark.createDataFrame([("b",), ("c",), (None,), ("a",), ("d",)], "n string")
    got = {r.n: r.K for r in assign_keys(batch, existing, ["n"], "K", ["n"]).collect()}
    assert got == {"a": 1, "b": 2, None: 3, "c": 4, "d": 5}


def test_assign_keys_wants_one_row_per_entity(spark):
    batch = spark.createDataFrame([("a",), ("b",)], "n string")
    with pytest.raises(DuplicateKeyError):
        assign_keys(batch.union(batch), spark.createDataFrame([], "n string, K long"), ["n"], "K", ["n"])
    with pytest.raises(DuplicateKeyError):
        assign_keys(batch, spark.createDataFrame([(None, 1), (None, 2)], "n string, K long"), ["n"], "K", ["n"])


def test_layer_table_versions_and_readers(spark, workdir):
    t = LayerTable(spark, workdir)
    assert t.versions() == []
    t.create(spark.createDataFrame([], "a int").schema)
    assert t.append(spark.createDataFrame([(1,), (2,)], "a int")) == 2
    old = t.read()
    # replacing from a plan that reads the table itself is safe: it writes a new version
    assert t.replace(old.select((F.col("a") * 10).alias("a"))) == 2
    assert sorted(r.a for r in t.read().collect()) == [10, 20]
    assert sorted(r.a for r in old.collect()) == [1, 2]
    assert t.versions() == [1, 2]


def test_table_without_version_raises(spark, workdir):
    with pytest.raises(FileNotFoundError):
        LayerTable(spark, workdir).read()


def test_failed_version_is_skipped(spark, workdir):
    t = LayerTable(spark, workdir)
    t.replace(spark.createDataFrame([(1,)], "a int"))
    # a version folder without _SUCCESS, as a write that died leaves it
    spark.createDataFrame([(99,)], "a int").write.parquet(f"{workdir}/v=000002")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{workdir}/v=000002/_SUCCESS")
    fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, False)
    assert t.versions() == [1] and [r.a for r in t.read().collect()] == [1]
    t.replace(spark.createDataFrame([(2,)], "a int"))
    assert t.versions() == [1, 3] and [r.a for r in t.read().collect()] == [2]


def test_purge_scratch_only_old_folders(spark, workdir):
    from strata.session import purge_scratch

    root = f"{workdir}/scratch"
    spark.range(1).write.parquet(f"{root}/old")
    assert purge_scratch(spark, 3600, root) == []          # younger than an hour: kept
    removed = purge_scratch(spark, -1, root)                 # everything older than "the future"
    assert len(removed) == 1 and removed[0].endswith("/old")


def test_vacuum_keeps_newest_versions(spark, workdir):
    from strata.sources.tables import Lakehouse

    lake = Lakehouse(spark, workdir)
    t = lake.table("silver", "x")
    for i in range(4):
        t.replace(spark.createDataFrame([(i,)], "a int"))
    assert t.vacuum(keep=2) == [1, 2]
    assert t.versions() == [3, 4] and [r.a for r in t.read().collect()] == [3]
    lake.table("gold", "y").replace(spark.createDataFrame([(1,)], "a int"))
    assert lake.vacuum(keep=1) == {"silver/x": [3], "gold/y": []}
