import pytest
from pyspark.sql import types as T

from strata.plans.jobs import GoldBuilder, LoadContext, run_gold, run_silver
from strata.schemas import EDW_CONFIG, OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION, with_audit
from strata.sources.tables import Lakehouse

SCHEMA = with_audit(T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.StringType())]))


def _ctx(spark, workdir):
    lake = Lakehouse(spark, workdir)
    lake.table("bronze", "OBJ").create(T.StructType([T.StructField("K", T.StringType()),
                                                     T.StructField("V", T.StringType()),
                                                     T.StructField("ADDED_ON", T.TimestampType())]))
    lake.table("silver", "OBJ").create(SCHEMA)
    return LoadContext(spark, lake, f"{workdir}/src", "r1", "2024-01-01 00:00:00")


def _objects(spark, op="upsert", full=0):
    return spark.createDataFrame([("OBJ", "erp", "p", "f", "", "OBJ", "OBJ", op, "K", full, 1)],
                                 OBJECTS_CONFIGURATION)


def test_unknown_operation_type_raises(spark, workdir):
    ctx = _ctx(spark, workdir)
    mapping = spark.createDataFrame([("erp", "OBJ", "K", "K", "bigint", None)], OBJECTS_COLUMN_MAPPING)
    with pytest.raises(ValueError, match="operation type"):
        run_silver(ctx, _objects(spark, "append"), mapping)


def test_missing_mapping_raises(spark, workdir):
    ctx = _ctx(spark, workdir)
    mapping = spark.createDataFrame([("erp", "OTHER", "K", "K", "bigint", None)], OBJECTS_COLUMN_MAPPING)
    with pytest.raises(ValueError, match="no mappings"):
        run_silver(ctx, _objects(spark), mapping)


def test_gold_unknown_object_and_dimension_first(spark, workdir):
    ctx = _ctx(spark, workdir)
    order = []

    def build(name):
        def fn(c):
            order.append(name)
            return c.spark.createDataFrame([(1, "x")], "K long, V string")
        return fn

    for n in ("F1", "D1"):
        ctx.lake.table("gold", n).create(SCHEMA)
    edw = spark.createDataFrame([
        ("F1", "upsert", "K", "g", "s", "K, V", 1, 1),
        ("D1", "upsert", "K", "g", "s", "K, V", 1, 1),
        ("OFF", "upsert", "K", "g", "s", "K, V", 1, 0),
    ], EDW_CONFIG)
    builders = [GoldBuilder("F1", build("F1"), "fact"), GoldBuilder("D1", build("D1"), "dimension")]
    assert run_gold(ctx, edw, builders) == {"D1": 1, "F1": 1}
    assert order == ["D1", "F1"]
    bad = edw.unionByName(spark.createDataFrame([("NOPE", "upsert", "K", "g", "s", "K", 1, 1)], EDW_CONFIG))
    with pytest.raises(ValueError, match="no gold builder"):
        run_gold(ctx, bad, builders)


def test_an_upsert_reads_a_staged_build(spark, workdir, monkeypatch):
    """A gold build is computed once, not by every branch of the upsert that reads it."""
    import strata.plans.jobs as J
    from strata.schemas import EDW_CONFIG, with_audit
    from strata.sources.tables import Lakehouse

    lake = Lakehouse(spark, workdir)
    lake.table("gold", "D").create(with_audit(spark.createDataFrame([], "K long, V long").schema))
    seen, load = [], J.load_table

    def watched(table, df, **kw):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return load(table, df, **kw)

    monkeypatch.setattr(J, "load_table", watched)
    built = spark.range(20).selectExpr("id % 5 AS K", "id AS V").groupBy("K").sum("V").withColumnRenamed("sum(V)", "V")
    edw = spark.createDataFrame([("D", "upsert", "K", "gold", "edw", "K, V", 0, 1)], EDW_CONFIG)
    J.run_gold(J.LoadContext(spark, lake, "", "r1", "2024-01-01 00:00:00"), edw, [J.GoldBuilder("D", lambda ctx: built)])
    assert "Aggregate" not in seen[0] and "Relation" in seen[0]
    assert {r.K: r.V for r in lake.table("gold", "D").read().collect()} == {k: 30 + 4 * k for k in range(5)}


def test_winners_pass_counts_bad_keys_and_lossy_casts(spark):
    """Where no row is bad, rejects and cast errors need no pass of their own."""
    from types import SimpleNamespace

    from strata.plans.jobs import split_bad_keys, stage_winners

    m = SimpleNamespace(types={"K": "bigint", "V": "int"})
    rows = spark.createDataFrame([("1", "5", "a"), ("1", "6", "b"), ("x", "q", "c"), ("2", "no", "d"), (None, None, "e")], "K string, V string, ADDED_ON string")
    won, counts = stage_winners(rows, m, ["K"])
    assert counts == {"bad": 1, "lossy": 1} and split_bad_keys(rows, m, ["K"])[1].count() == 1
    assert sorted((r.K or 0, r.V or 0) for r in won.collect()) == [(0, 0), (1, 6), (2, 0)]
    assert stage_winners(rows.where("V = '5' OR V IS NULL"), m, ["K"])[1] == {"bad": 0, "lossy": 0}
