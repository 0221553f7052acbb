"""Results stay whole and exact when one key holds a third of all rows."""

from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest
from strata.operators.keys import dense_number
from strata.operators.transform import stamp_audit
from strata.operators.upsert import upsert


def _hot(spark, n=3000):
    # a third of the rows share key 0
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 2).alias("v"))


def test_dedupe_hot_key(spark):
    out = {r.k: (r.ts, r.v) for r in dedupe_latest(_hot(spark), ["k"], ["ts"]).collect()}
    assert out[0] == (2997, 5994) and len(out) == 2001


def test_upsert_hot_target_key(spark):
    target = stamp_audit(_hot(spark).drop("ts"), "old", "2020-01-01 00:00:00")
    source = spark.createDataFrame([(0, -1), (5000, -2)], "k long, v long")
    out = upsert(target, source, ["k"], run_id="new")
    rows = out.collect()
    assert len(rows) == 3000 + 1
    hot = [r for r in rows if r.k == 0]
    assert len(hot) == 1000 and {r.v for r in hot} == {-1} and {r.MODIFIED_BY for r in hot} == {"new"}


def test_numbering_hot_copies_spread(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = dense_number(df, ["k"], "KEY_NO", rows_per_partition=100)
    assert sorted(r.KEY_NO for r in out.collect()) == list(range(1, 3001))
    # the 1,000 copies of key 0 are numbered 1..1000 and spread over several partitions
    hot = out.where("k = 0")
    assert sorted(r.KEY_NO for r in hot.collect()) == list(range(1, 1001))
    assert hot.select(F.spark_partition_id().alias("p")).distinct().count() > 1
