import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators.partitions import upsert_partitions
from strata.operators.upsert import missing_rows, upsert
from strata.sources.partitioned import PartitionedTable, in_partitions

SCHEMA = "K long, REGION string, YEAR int, V double, ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet")}


def _rows(spark, rows):
    return spark.createDataFrame([(*r, "r0", None, "r0", None) for r in rows], SCHEMA)


def _plain(df):
    return sorted(((r.K, r.REGION, r.YEAR, r.V, r.ADDED_BY, r.MODIFIED_BY) for r in df.collect()), key=repr)


@pytest.fixture()
def filled(spark, workdir):
    t = PartitionedTable(spark, workdir.removeprefix("file:"), ["YEAR", "REGION"]).create(spark.createDataFrame([], SCHEMA).schema)
    t.replace(_rows(spark, [(1, "a", 2020, 1.0), (2, "a", 2020, 2.0), (3, "b=/ %", 2020, 3.0), (4, None, 2021, 4.0), (5, "c", None, 5.0), (None, "a", 2021, 6.0)]))
    return t


def test_only_touched_partitions_change(spark, filled):
    before = _files(filled.root)
    rows = filled.read()
    source = spark.createDataFrame([(2, "a", 2020, 20.0), (3, "z", 2022, 30.0), (9, "a", 2020, 90.0)], "K long, REGION string, YEAR int, V double")
    want = _plain(upsert(rows, source, ["K"], run_id="r1"))
    seen = Observation()
    assert upsert_partitions(filled, source, ["K"], run_id="r1", counts=seen) == 4
    assert _plain(filled.read()) == want
    after = _files(filled.root)
    gone = {d for d in (os.path.dirname(f) for f in before) if d not in {os.path.dirname(f) for f in after}}
    assert len(gone) == 1 and "2020" in gone.pop()      # row 3 left its partition empty
    assert {f: m for f, m in before.items() if "YEAR=2021" in f or "HIVE" in f}.items() <= after.items()
    assert {k: seen.get[k] for k in ("updated", "unchanged", "inserted", "null_key")} == {"updated": 2, "unchanged": 1, "inserted": 1, "null_key": 0}
    assert not os.listdir(f"{filled.root}/_pending")


def test_filter_reaches_the_folders(spark, filled):
    rows = filled.read()
    one = rows.where("K = 4").select("YEAR", "REGION")
    plan = rows.where(in_partitions(rows, ["YEAR", "REGION"], one))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert rows.where(in_partitions(rows, ["YEAR", "REGION"], one)).count() == 1      # the null region counts as a value


def test_dead_loads(spark, filled, monkeypatch):
    source = spark.createDataFrame([(1, "q", 2030, 10.0), (7, "a", 2020, 70.0)], "K long, REGION string, YEAR int, V double")
    want = _plain(upsert(filled.read(), source, ["K"], run_id="r1"))
    before = _plain(filled.read())

    def die(*a, **kw):
        raise RuntimeError("lost")

    # before publishing: nothing happened
    with monkeypatch.context() as m:
        m.setattr("strata.sources.partitioned._folder", die)
        with pytest.raises(RuntimeError):
            upsert_partitions(filled, source, ["K"], run_id="r1")
    assert _plain(filled.read()) == before and not os.listdir(f"{filled.root}/_pending")
    # while publishing: the next read finishes it
    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, "_publish", die)
        with pytest.raises(RuntimeError):
            upsert_partitions(filled, source, ["K"], run_id="r1")
    assert os.listdir(f"{filled.root}/_pending")
    assert _plain(filled.read()) == want and not os.listdir(f"{filled.root}/_pending")


def test_odd_tables(spark, workdir):
    empty = spark.createDataFrame([], SCHEMA)
    t = PartitionedTable(spark, workdir.removeprefix("file:"), ["REGION"]).create(empty.schema)
    assert t.read().count() == 0 and t.read().schema == empty.schema
    assert upsert_partitions(t, empty.select("K", "REGION", "V"), ["K"], run_id="r") == 0
    assert t.append(_rows(spark, [(1, "a", 1, 1.0)])) == 1 and t.append(_rows(spark, [(2, "a", 1, 1.0)])) == 1
    with pytest.raises(Exception, match="empty text"):
        t.append(_rows(spark, [(3, "", 1, 1.0)]))
    assert t.read().count() == 2
    assert t.replace(empty) == 0 and t.read().count() == 0
    with pytest.raises(ValueError, match="has type"):
        PartitionedTable(spark, workdir + "x", ["V"]).create(empty.schema)


def test_null_key_rows_are_inserted_once(spark):
    cols = "K long, REGION string, YEAR int, V double"
    target = _rows(spark, [(None, "a", 1, 1.0), (None, "a", 1, 1.0), (1, "b", 1, 1.0)])
    source = spark.createDataFrame([(None, "a", 1, 1.0)] * 3 + [(None, None, None, None)] * 2 + [(1, "b", 2, 2.0)], cols)
    once = upsert(target, source, ["K"], run_id="r1", null_keys="missing")
    assert once.where("K IS NULL").count() == 5 and once.where("REGION = 'a'").count() == 3
    again = upsert(once, source, ["K"], run_id="r1", null_keys="missing")
    assert _plain(again) == _plain(once)
    assert upsert(target, source, ["K"], run_id="r1").where("K IS NULL").count() == 7


def test_missing_rows_of_a_hot_row(spark):
    rows = spark.range(250_000).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert missing_rows(rows, rows.limit(3)).groupBy("a", "b").count().collect() == [(1, None, 249_997)]
    assert missing_rows(rows, rows.union(rows)).count() == 0
