"""The pipeline's stages against brute force on the smallest tables."""

import re

import pytest

import corpus_pipeline as C
from strata.session import scratch_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in C.STAGES:
        path = scratch_dir(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def test_columns(stages):
    want = stages["documents"].columns
    assert all(stages[n].columns == want for n, _ in C.STAGES[:-1])
    assert [n for n, _ in C.STAGES] == ["quality", "exact", "near", "repeats", "pack"]


def test_quality_keeps_clean_documents(spark, stages):
    kept = set(rows(stages["quality"]))
    labels = rows(spark.read.parquet(f"{SF}/labels.parquet"))
    good = [d for d in labels if labels[d].quality == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good)
    before, after = rows(stages["documents"]), rows(stages["quality"])
    assert all(after[d] == before[d] for d in after) and len(after) < len(before)


def test_exact_keeps_the_largest_of_each_text(stages):
    best = {}
    for d, r in rows(stages["quality"]).items():
        best[lower(r.text)] = max(d, best.get(lower(r.text), d))
    assert set(rows(stages["exact"])) == set(best.values())


def test_near_keeps_the_smallest_of_each_group(stages):
    docs = rows(stages["exact"])
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", lower(r.text)) for d, r in docs.items()}
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for d, w in words.items()}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if words[a] and words[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(rows(stages["near"])) == {find(d) for d in ids}


def test_repeats_are_cut(stages):
    from tests.llm.test_suffix_dedup import brute

    before, after = rows(stages["near"]), rows(stages["repeats"])
    ids = sorted(before)
    assert sorted(after) == ids
    for d, left in zip(ids, brute([before[d].text.encode() for d in ids], 200), strict=True):
        assert after[d].text == left.decode("utf-8", "ignore")
        assert after[d].n_chars == len(after[d].text)


def test_pack_covers_every_document(stages):
    pieces = stages["pack"].collect()
    assert {r.doc_id for r in pieces} == set(rows(stages["repeats"]))
    assert all(r.offset + r.length <= 4096 for r in pieces)


def test_empty_and_odd_tables(spark, stages, edge_docs):
    empty = stages["documents"].limit(0)
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
    odd = edge_docs.selectExpr("*", "n AS n_chars", "k1 AS source")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() > 0, name
    packed = C.pack(spark, odd, SF)
    assert packed.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    assert packed.filter("offset + length > 4096").count() == 0
    # names that the stages use inside
    clash = stages["exact"].limit(20).selectExpr("*", "lang AS `__spans`", "source AS `__kept`", "n_chars AS `__n_bytes`", "lang AS spans", "lang AS `sequence.id`")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, clash, SF)
        assert out.columns == clash.columns and out.filter("`__spans` != lang").count() == 0, name


def test_near_with_null_and_repeated_ids(spark):
    from strata.llm.ngram_join import similar_groups

    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base + " a"), (4, base + " b"), (7, base + " c"), (7, "another text that stands alone with its words"), (9, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in similar_groups(docs, words=5, percent=80).collect()}
    assert got == {(None, 4), (4, 4), (7, 4), (7, 7), (9, 9)}
    assert {tuple(r) for r in C.near(spark, docs, SF).collect()} == {rows[0], rows[1], rows[3], rows[4]}


def test_stages_leave_little_staged(spark, stages):
    """Disk is counted over all stages: what a stage does not read again goes before it returns."""
    from tests.llm.test_suffix_dedup import staged

    for name, left in (("near", ["near-out"]), ("repeats", ["suffix-repeats"])):
        before = staged(spark)
        dict(C.STAGES)[name](spark, stages["exact"].limit(60), SF)
        assert [n.rsplit("-", 1)[0] for n in staged(spark) - before] == left, name
    before = staged(spark)
    C.run(spark, SF)
    assert sorted(n.rsplit("-", 1)[0] for n in staged(spark) - before) == sorted(f"pipeline-{n}" for n, _ in C.STAGES)
