"""Properties of the upsert and numbering against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.keys import dense_number
from strata.operators.transform import stamp_audit
from strata.operators.upsert import upsert

keys = st.one_of(st.none(), st.integers(0, 12))
target_rows = st.lists(st.tuples(keys, st.integers(0, 99)), max_size=25)
source_rows = st.lists(st.tuples(keys, st.integers(100, 199)), max_size=25).map(
    lambda rows: list({k: (k, v) for k, v in rows if k is not None}.values())
    + [(None, v) for k, v in rows if k is None])


def model(target, source):
    """MERGE semantics: null keys never match; matched rows take the source value."""
    src = {k: v for k, v in source if k is not None}
    tkeys = {k for k, _ in target if k is not None}
    out = [(k, src[k], "old", "new") if k in src else (k, v, "old", "old") for k, v in target]
    out += [(k, v, "new", "new") for k, v in source if k is None or k not in tkeys]
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target_rows, source_rows)
def test_upsert_matches_model(spark, target, source):
    t = stamp_audit(spark.createDataFrame(target, "k int, v int"), "old", "2020-01-01 00:00:00")
    s = spark.createDataFrame(source, "k int, v int")
    got = sorted(((r.k, r.v, r.ADDED_BY, r.MODIFIED_BY) for r in upsert(t, s, ["k"], run_id="new").collect()),
                 key=repr)
    assert got == model(target, source)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), min_size=1, max_size=60))
def test_numbering_is_dense_and_ordered(spark, rows):
    df = spark.createDataFrame(rows, "x int, y string")
    out = dense_number(df, ["x", "y"], "K", rows_per_partition=7).collect()
    assert sorted(r.K for r in out) == list(range(1, len(rows) + 1))
    norm = lambda v: (v is not None, v)
    seq = [(norm(r.x), norm(r.y)) for r in sorted(out, key=lambda r: r.K)]
    assert seq == sorted(seq)
