import hashlib
from collections import defaultdict

import pytest

from strata.llm.exact_dedup import exact_dedup
from tests.oracle_check import compare


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", ["op9_exact_dedup"], verbose=False)["op9_exact_dedup"].startswith("OK")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_edge_rows(edge_docs):
    rows = exact_dedup(edge_docs).collect()
    groups = defaultdict(list)
    for r in edge_docs.select("doc_id", "text").collect():
        groups[lower(r.text)].append(r.doc_id)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == edge_docs.count()
    kept = defaultdict(int)
    for r in rows:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}    # one row of each group, also where the largest id is there twice


def test_rows_that_stay_keep_their_columns(edge_docs):
    out = exact_dedup(edge_docs, with_rows=True)
    assert out.columns == edge_docs.columns
    got = sorted((r.doc_id or 0, r.text or "", r["a.b"]) for r in out.collect())
    assert len(got) == len({lower(t) for _, t, _ in got}) == 8
    assert (4, "", 4) in got and (2, "same text HERE for all of us", 2) in got


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).count() == 0 and exact_dedup(no_docs, with_rows=True).count() == 0


@pytest.mark.parametrize("parts", [3, 40])
def test_group_over_many_partitions(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.range(600).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'HOT copy', concat('t', id % 150)) AS text")
        rows = {r.doc_id: r for r in exact_dedup(docs).collect()}
        assert len(rows) == 600
        for i, r in rows.items():
            same = [j for j in range(600) if (j % 3 == 0) == (i % 3 == 0) and (i % 3 == 0 or j % 150 == i % 150)]
            assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), i == max(same))
        assert sorted(r.doc_id for r in exact_dedup(docs, with_rows=True).collect()) == sorted(i for i, r in rows.items() if r.kept)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
