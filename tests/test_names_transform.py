import pytest
from pyspark.sql import types as T

from strata.functions.names import normalize_name, normalize_names, split_list
from strata.operators.transform import (
    cast_columns, conform, drop_columns, fill_nulls, normalize_headers, rename_columns, stamp_audit,
)


@pytest.mark.parametrize("raw,expected", [
    ("Price ($)", "PRICE"), (" yard-id ", "YARD_ID"), ("__a__b__", "A_B"), ("_c3", "C3"),
    ("Invoice  Grand Total", "INVOICE_GRAND_TOTAL"), ("ok", "OK"),
])
def test_normalize_name(raw, expected):
    assert normalize_name(raw) == expected


def test_normalize_collision_and_empty():
    with pytest.raises(ValueError, match="collide"):
        normalize_names(["Yard ID", "Yard-ID"])
    with pytest.raises(ValueError, match="nothing"):
        normalize_names(["$$$"])


def test_split_list():
    assert split_list(" a, b ,c,,") == ["a", "b", "c"]
    assert split_list(None) == []


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Price ($)` int, `yard id` int")
    assert normalize_headers(df).columns == ["PRICE", "YARD_ID"]


def test_rename_swap_and_onto_existing(spark):
    df = spark.createDataFrame([(1, "x", 2.0, "stale")], "a int, b string, c double, d string")
    out = rename_columns(df, [("a", "b"), ("b", "a"), ("c", "D"), ("missing", "z"), ("A", "a")])
    # a<->b swapped simultaneously; c renamed onto existing d, which is dropped
    assert out.columns == ["b", "a", "D"]
    assert out.first().asDict() == {"b": 1, "a": "x", "D": 2.0}


def test_rename_conflict_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        rename_columns(df, [("a", "z"), ("b", "z")])


def test_fill_nulls_casts_text_default(spark):
    df = spark.createDataFrame([(None, None, 3), (1, "v", None)], "i int, s string, k int")
    out = fill_nulls(df, {"I": "7", "s": "dflt"}).orderBy("k").collect()
    assert [r.i for r in out] == [1, 7] and [r.s for r in out] == ["v", "dflt"]
    assert [r.k for r in out] == [None, 3]


def test_fill_nulls_bad_default_raises(spark):
    df = spark.createDataFrame([(None,)], "i int")
    with pytest.raises(Exception):
        fill_nulls(df, {"i": "abc"}).collect()


def test_cast_columns_try_cast(spark):
    df = spark.createDataFrame([("1", "x"), (" 2 ", "3.5")], "a string, b string")
    out = cast_columns(df, {"a": "int", "B": "double", "nope": "int"}).collect()
    assert [(r.a, r.b) for r in out] == [(1, None), (2, 3.5)]


def test_conform_orders_casts_drops_and_raises(spark):
    schema = T.StructType([T.StructField("A", T.LongType()), T.StructField("B", T.StringType())])
    df = spark.createDataFrame([("x", "5", 1)], "b string, a string, extra int")
    out = conform(df, schema)
    assert out.schema == schema and out.first().asDict() == {"A": 5, "B": "x"}
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("b"), schema)


def test_float_conversions_from_text(spark):
    texts = ["1.5", "1,234.5", "", " 2 ", "$3", "1e3", None]
    df = spark.createDataFrame([(t,) for t in texts], "PRICE string")
    got = [r.PRICE for r in conform(df, T.StructType([T.StructField("PRICE", T.FloatType())]), safe=True).collect()]
    assert got == [1.5, None, None, 2.0, None, 1000.0, None]


def test_stamp_audit_one_timestamp(spark):
    out = stamp_audit(spark.range(3), "r1").collect()
    assert {r.ADDED_ON for r in out} == {r.MODIFIED_ON for r in out} and len({r.ADDED_ON for r in out}) == 1
    assert {r.ADDED_BY for r in out} == {"r1"}


def test_drop_columns_case_insensitive(spark):
    assert drop_columns(spark.createDataFrame([(1, 2)], "a int, B int"), "b", "zz").columns == ["a"]


def test_register_view_and_filters(spark):
    from strata.operators.transform import active, equals, iequals, not_null
    from strata.sources.tables import register_view

    df = spark.createDataFrame([("Erp", "A", 1, "x"), ("other", "a", 0, None)], "s string, o string, IS_RUN int, v string")
    register_view(df, "cfg_view")
    assert spark.sql("select count(*) c from cfg_view").first().c == 2
    assert df.where(iequals("s", "ERP") & equals("o", "A") & not_null("v")).count() == 1
    assert active(df).count() == 1


def test_rename_case_only(spark):
    df = spark.createDataFrame([(1, 2)], "yard_id int, b int")
    assert rename_columns(df, [("yard_id", "YARD_ID"), ("b", "b")]).columns == ["YARD_ID", "b"]


def test_operators_accept_dotted_names(spark):
    from strata.operators.dedupe import dedupe_latest
    from strata.operators.keys import dense_number
    from strata.operators.upsert import upsert

    df = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (None, "z", 1)], "`a.b` int, `c d` string, `e.f` int")
    assert rename_columns(df, {"a.b": "AB"}).columns == ["AB", "c d", "e.f"]
    assert fill_nulls(df, {"a.b": "9"}).where("`a.b` = 9").count() == 1
    assert cast_columns(df, {"a.b": "string"}).schema["a.b"].dataType == T.StringType()
    assert dedupe_latest(df, ["a.b"], ["e.f"]).count() == 2
    assert sorted(r["K"] for r in dense_number(df, ["e.f"], "K").collect()) == [1, 2, 3]
    t = stamp_audit(df, "t")
    out = upsert(t, df.where("`e.f` = 3"), ["a.b"], run_id="s").collect()
    assert len(out) == 3


def test_audit_time_with_offset_is_exact(spark):
    import datetime as dt

    from strata.functions.values import as_timestamp

    aware = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    got = spark.range(1).select(as_timestamp(aware).alias("t"),
                                as_timestamp("2024-01-01 10:00:00+00:00").alias("u")).first()
    assert got.t == got.u
