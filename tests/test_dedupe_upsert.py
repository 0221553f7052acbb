import pytest

from strata.operators.dedupe import dedupe_latest
from strata.operators.upsert import DuplicateKeyError, load_mode, replace, upsert
from strata.operators.transform import stamp_audit

T_SCHEMA = "k int, v string, ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"


def _target(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    return stamp_audit(df, "old", "2020-01-01 00:00:00")


def test_dedupe_latest_newest_and_total_order(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (1, "2024-02-01", "c"), (None, "2024-01-01", "n1"),
         (None, "2024-03-01", "n2"), (2, "2024-01-01", "z")], "k int, ts string, v string")
    out = {r.k: r.v for r in dedupe_latest(df, ["k"], ["ts"]).collect()}
    assert out == {1: "c", None: "n2", 2: "z"}


def test_dedupe_with_map_column(spark):
    df = spark.sql("select 1 k, 1 ts, map('a', 1) m union all select 1, 2, map('b', 2)")
    assert dedupe_latest(df, ["k"], ["ts"]).first().m == {"b": 2}


def test_upsert_cases(spark):
    target = _target(spark, [(1, "t1"), (2, "t2"), (None, "tnull")])
    source = spark.createDataFrame([(2, "s2"), (3, "s3"), (None, "snull")], "k int, v string")
    out = upsert(target, source, ["K"], run_id="new", now="2024-01-01 00:00:00")
    rows = sorted(out.collect(), key=lambda r: (r.v,))
    got = {r.v: (r.k, r.ADDED_BY, r.MODIFIED_BY) for r in rows}
    assert got == {
        "t1": (1, "old", "old"),          # target only: unchanged
        "s2": (2, "old", "new"),          # matched: value updated, ADDED_* kept
        "s3": (3, "new", "new"),          # source only: inserted
        "tnull": (None, "old", "old"),    # null key never matches
        "snull": (None, "new", "new"),
    }
    assert out.columns == target.columns
    assert out.count() == target.count() + 2  # target + unmatched source rows


def test_upsert_duplicate_source_keys_raise(spark):
    target = _target(spark, [(1, "a")])
    source = spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, ["k"], run_id="r")


def test_upsert_twice_changes_only_modified(spark):
    target = _target(spark, [(1, "a"), (2, "b")])
    source = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, source, ["k"], run_id="r1", now="2024-01-01 00:00:00").collect()
    twice = upsert(spark.createDataFrame(once, T_SCHEMA), source, ["k"], run_id="r2",
                   now="2024-02-01 00:00:00").collect()
    strip = lambda rows: sorted((r.k, r.v, r.ADDED_BY, str(r.ADDED_ON)) for r in rows)
    assert strip(once) == strip(twice)


def test_upsert_composite_key_and_update_list(spark):
    target = stamp_audit(spark.createDataFrame([(1, "x", "a", 1.0)], "k1 int, k2 string, v string, w double"),
                         "old", "2020-01-01 00:00:00")
    source = spark.createDataFrame([(1, "x", "A", 9.0), (1, "y", "B", 2.0)], "k1 int, k2 string, v string, w double")
    out = upsert(target, source, ["k1", "k2"], run_id="n", update_columns=["v", "ADDED_BY", "k1"]).collect()
    got = {(r.k1, r.k2): (r.v, r.w, r.ADDED_BY) for r in out}
    assert got == {(1, "x"): ("A", 1.0, "old"), (1, "y"): ("B", 2.0, "n")}


def test_upsert_composite_key_with_a_null_part_never_matches(spark):
    schema = "k1 int, k2 string, v string, w double"
    target = stamp_audit(spark.createDataFrame([(1, None, "t", 1.0), (2, "x", "t", 2.0)], schema),
                         "old", "2020-01-01 00:00:00")
    source = spark.createDataFrame([(1, None, "s", 3.0), (None, "x", "s", 4.0), (2, "x", "s", 5.0)], schema)
    out = upsert(target, source, ["k1", "k2"], run_id="n", check=False).collect()
    got = sorted(((r.k1, r.k2, r.v, r.w, r.ADDED_BY, r.MODIFIED_BY) for r in out), key=repr)
    assert got == sorted([
        (1, None, "t", 1.0, "old", "old"),  # target row with a null key part is kept as it is
        (2, "x", "s", 5.0, "old", "n"),     # matched on both parts
        (1, None, "s", 3.0, "n", "n"),      # null key part: inserted, never matched
        (None, "x", "s", 4.0, "n", "n"),
    ], key=repr)

def test_replace_and_load_mode(spark):
    schema = _target(spark, [(1, "a")]).schema
    out = replace(spark.createDataFrame([(" 4 ", "d")], "k string, v string"), schema, run_id="r").collect()
    assert out[0].k == 4 and out[0].ADDED_BY == "r" and out[0].MODIFIED_BY == "r"
    assert load_mode("UpSert", 1) == "replace" and load_mode("upsert", "0") == "upsert"
    with pytest.raises(ValueError):
        load_mode("append", 1)
