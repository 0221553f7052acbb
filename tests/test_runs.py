"""Runs side by side, scratch tables that go with their load, numbering without staged rows, order of batches."""

import itertools
import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest, newer_rows
from strata.operators.keys import dense_number
from strata.operators.transform import CAST_ERRORS, cast_with_errors
from strata.plans.control import ControlTables, gated_run
from strata.plans.jobs import LoadContext, create_tables, run_silver
from strata.queries.e2e import BRONZE, SILVER
from strata.queries.rerun import _MAPPING, _object
from strata.schemas import OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION
from strata.session import checkpoint_root, owned_scratch, stage
from strata.sources.tables import Lakehouse, LayerTable


def test_two_runs_that_start_together(spark, workdir):
    c = ControlTables(LayerTable(spark, f"{workdir}/s"), LayerTable(spark, f"{workdir}/a")).create()
    c.register("p", True)
    inside, go = threading.Event(), threading.Event()
    states = {}

    def work():
        inside.set()
        assert go.wait(60)

    first = threading.Thread(target=lambda: states.update(a=gated_run(c, "p", "run-a", work)))
    first.start()
    assert inside.wait(60) and c.holder("p") == "run-a"
    states["b"] = gated_run(c, "p", "run-b", work)
    go.set()
    first.join(60)
    assert states == {"a": "completed", "b": "skipped"} and c.holder("p") is None
    assert c.audit.read().count() == 1


def test_only_one_of_many_claims(spark, workdir):
    c = ControlTables(LayerTable(spark, f"{workdir}/s"), LayerTable(spark, f"{workdir}/a")).create()
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(c.claim("p", f"r{i}"))) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False] * 11 + [True]
    assert c.claim("other", "r") and not c.claim("p", "late")
    c.register("p", False)
    c.reset("p")        # a run that died: flag and lease
    assert c.last_run_completed("p") and c.claim("p", "next")


def test_a_failed_run_gives_the_lease_back(spark, workdir):
    c = ControlTables(LayerTable(spark, f"{workdir}/s"), LayerTable(spark, f"{workdir}/a")).create()
    c.register("p", True)
    with pytest.raises(ZeroDivisionError):
        gated_run(c, "p", "r1", lambda: 1 / 0)
    assert c.holder("p") is None and not c.last_run_completed("p")
    with pytest.raises(KeyError):
        gated_run(c, "unknown", "r1", lambda: None)
    assert c.holder("unknown") is None


def _scratch(spark):
    root = checkpoint_root(spark).removeprefix("file:") + "/strata-work"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_scratch_goes_with_its_load(spark):
    before = _scratch(spark)
    with owned_scratch(spark):
        df, n = stage(spark.range(5), "mine")
        assert n == 5 and len(_scratch(spark) - before) == 1
    assert _scratch(spark) == before
    with pytest.raises(ValueError):
        with owned_scratch(spark):
            stage(spark.range(5), "mine")
            raise ValueError
    assert _scratch(spark) == before
    stage(spark.range(5), "kept")
    assert len(_scratch(spark) - before) == 1


def _silver(spark, workdir):
    lake = Lakehouse(spark, f"{workdir}/tables")
    create_tables(lake, {("bronze", "ORDERS"): BRONZE[("bronze", "ORDERS")], ("silver", "ORDERS"): SILVER[("silver", "ORDERS")]})
    return (lake, spark.createDataFrame([_object("ORDERS", "ORDERS")], OBJECTS_CONFIGURATION),
            spark.createDataFrame(_MAPPING, OBJECTS_COLUMN_MAPPING))


def _bronze(spark, rows, hour):
    return spark.createDataFrame([(k, "7", "F", price, "1995-01-01 00:00:00", f"r{hour}") for k, price in rows],
                                 "ORDER_KEY string, CUST_KEY string, ORDER_STATUS string, TOTAL_PRICE string, ORDER_DATE string, ADDED_BY string").withColumn(
        "ADDED_ON", F.lit(f"2024-01-01 0{hour}:00:00").cast("timestamp"))


def test_silver_leaves_no_scratch_and_keeps_cast_errors(spark, workdir):
    lake, objects, mapping = _silver(spark, workdir)
    lake.table("bronze", "ORDERS").append(_bronze(spark, [("1", "2.5"), ("2", "x"), ("z", "1")], 1))
    before = _scratch(spark)
    run_silver(LoadContext(spark, lake, "", "run", "2024-02-02"), objects, mapping)
    assert _scratch(spark) == before
    assert [tuple(r)[:6] for r in lake.table("silver_cast_errors", "ORDERS").read().collect()] == [
        ("ORDERS", '{"ORDER_ID":"2"}', "AMOUNT", "x", "double", "run")]
    assert lake.table("silver_rejects", "ORDERS").read().count() == 1


def test_any_order_of_batches(spark, workdir):
    batches = [_bronze(spark, [("1", "1"), ("2", "1")], 1), _bronze(spark, [("1", "2"), ("3", "2"), (None, "2")], 2),
               _bronze(spark, [("2", "3"), ("3", "1"), (None, "3")], 2)]
    whole = None
    for i, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2)]):
        lake, objects, mapping = _silver(spark, f"{workdir}/{i}")
        for b in order:
            lake.table("bronze", "ORDERS").append(batches[b])
            run_silver(LoadContext(spark, lake, "", f"run-{b}", "2024-02-02"), objects, mapping)
        got = sorted((r.ORDER_ID, r.AMOUNT) for r in lake.table("silver", "ORDERS").read().where("ORDER_ID IS NOT NULL").collect())
        if whole is None:
            lake, objects, mapping = _silver(spark, f"{workdir}/whole")
            for b in batches:
                lake.table("bronze", "ORDERS").append(b)
            run_silver(LoadContext(spark, lake, "", "all", "2024-02-02"), objects, mapping, incremental=False)
            whole = sorted((r.ORDER_ID, r.AMOUNT) for r in lake.table("silver", "ORDERS").read().where("ORDER_ID IS NOT NULL").collect())
        assert got == whole == [(1, 2.0), (2, 3.0), (3, 2.0)]


def test_newer_rows_in_every_order(spark):
    parts = [[(1, 5, "a"), (2, 5, None), (None, 1, "n")], [(1, 5, "b"), (3, None, "x")], [(1, 4, "z"), (2, 5, "c"), (None, 2, "m"), (3, None, "x")]]
    schema = "k int, ADDED_ON int, v string"
    want = sorted(map(tuple, dedupe_latest(spark.createDataFrame(sum(parts, []), schema), ["k"]).collect()), key=repr)
    for order in itertools.permutations(range(3)):
        held = spark.createDataFrame([], schema)
        for i in order:
            won = newer_rows(dedupe_latest(spark.createDataFrame(parts[i], schema), ["k"]), held, ["k"])
            held = spark.createDataFrame(held.collect() + won.collect(), schema)
        assert sorted(map(tuple, dedupe_latest(held, ["k"]).collect()), key=repr) == want
    assert newer_rows(spark.createDataFrame(parts[0], schema), spark.createDataFrame(parts[0], schema), ["k"]).count() == 0
    old = spark.createDataFrame([(1, 3)], "k int, ADDED_ON int")       # without a column that is new
    assert newer_rows(spark.createDataFrame([(1, 3, "v")], schema), old, ["k"]).count() == 1


@pytest.mark.parametrize("fixed", [False, True])
def test_numbering_stages_rows_at_most_once(spark, workdir, fixed):
    wide = spark.range(400).select((F.col("id") % 50).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("b"),
                                   F.array(F.lit("x"), F.lit(None), (F.col("id") % 2).cast("string")).alias("list"), F.lit("wide").alias("w"))
    wide.write.parquet(f"{workdir}/wide")
    df = spark.read.parquet(f"{workdir}/wide")
    before = _scratch(spark)
    out = dense_number(df, ["b"], "K", deterministic_input=fixed, rows_per_partition=60)
    staged = _scratch(spark) - before
    widths = [set(spark.read.parquet(f"{checkpoint_root(spark)}/strata-work/{s}").columns) for s in staged]
    assert sum("w" in w for w in widths) == (0 if fixed else 1) and len(widths) == (2 if fixed else 3)
    rows = out.collect()
    assert sorted(r.K for r in rows) == list(range(1, 401))
    assert sorted((r.a, r.b is not None, r.b, r.list, r.w) for r in rows) == sorted((r.a, r.b is not None, r.b, r.list, r.w) for r in df.collect())
    seq = [(r.b is not None, r.b) for r in sorted(rows, key=lambda r: r.K)]
    assert seq == sorted(seq)


def test_numbering_refuses_ties_and_changed_rows(spark):
    with pytest.raises(Exception, match="tie"):
        dense_number(spark.createDataFrame([(1, 2), (1, 3)], "a int, b int"), ["a"], "K", total_order=True).count()
    random = spark.range(20).select("id", F.rand().alias("r"))
    assert dense_number(random, ["r"], "K").count() == 20
    ticket = F.udf(lambda: __import__("uuid").uuid4().hex).asNondeterministic()
    with pytest.raises(Exception, match="changed while it was numbered"):
        dense_number(spark.range(20).withColumn("u", ticket()), ["id"], "K", deterministic_input=True).collect()


def test_cast_errors(spark):
    df = spark.createDataFrame([("1", "x", None), ("a", None, "2024-13-01"), (None, "2", "2024-01-01")], "A string, `b.c` string, D string")
    out = cast_with_errors(df, {"a": "int", "b.c": "double", "d": "date", "none": "int", "A2": ""}).collect()
    assert [[tuple(e) for e in r[CAST_ERRORS]] for r in out] == [
        [("b.c", "x", "double")], [("A", "a", "int"), ("D", "2024-13-01", "date")], []]
    assert [r["A"] for r in out] == [1, None, None]
    assert cast_with_errors(df, {}).collect()[0][CAST_ERRORS] == []
