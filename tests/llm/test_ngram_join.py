import re
from itertools import combinations

import numpy as np
import pytest

from strata.llm.components import components
from strata.llm.ngram_join import similar_groups


def sets_of(texts, words):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    return out


def roots(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(("words", "percent", "small", "block"), [(3, 90, 16, 512), (2, 80, 2, 5), (5, 80, 256, 512)])
def test_against_all_pairs(spark, monkeypatch, words, percent, small, block):
    monkeypatch.setattr("strata.llm.ngram_join.BLOCK", block)      # 5: large clusters are cut
    rng = np.random.default_rng(words)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(6):                       # groups of near copies around a base, all sharing a passage
        base = ["the", "shared", "passage", "of", "all"] * 2 + list(rng.choice(vocabulary, int(rng.integers(3, 90))))
        for _ in range(14):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(0, len(t)))] = str(rng.choice(vocabulary))
            texts.append(" ".join(t) if rng.random() < 0.7 else "\n".join(t).upper())
    texts += ["one", "ONE", "one two", "", None, " \t", texts[0], "one two three"]
    sets = sets_of(texts, words)
    links = [(i, j) for i, j in combinations(range(len(sets)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = roots(len(texts), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in similar_groups(docs, words=words, percent=percent, small=small, common_from=small, bits=1 << 20).collect()}
    assert len(got) == len(texts)
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == [(len(s), r) for s, r in zip(sets, want, strict=True)]


def test_edge_rows(edge_docs, no_docs):
    rows = similar_groups(edge_docs, bits=1 << 16).collect()
    assert len(rows) == edge_docs.count()
    got = {r.doc_id: r for r in rows}
    assert got[2].component_id == 1 and got[8].component_id == 7
    assert got[3].n_shingles == got[4].n_shingles == got[5].n_shingles == 0
    assert [got[i].component_id for i in (3, 4, 5)] == [3, 4, 5] and got[None].component_id is None
    assert similar_groups(no_docs, bits=1 << 16).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 340)]
    want = roots(400, links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    seen = {i for ab in links if ab[0] != ab[1] for i in ab}
    assert got == {i: want[i] for i in seen}


def test_sets_are_built_from_few_bytes_at_a_time(monkeypatch):
    """Slices of texts are bounded by bytes too, not only by rows; sets do not depend on them."""
    import pyarrow as pa

    from strata.llm import ngram_join

    texts = pa.array([None, "", "a b", "one two three four " * 30, "x", None, "Ä b c d e f " * 50] * 20)
    whole = [(i, t.tolist()) for i, t in ngram_join.token_sets(texts)]
    seen, real = [], ngram_join.utf8
    monkeypatch.setattr(ngram_join, "utf8", lambda a: seen.append(a) or real(a))
    monkeypatch.setattr(ngram_join, "TEXT_BYTES", 1000)
    assert [(i, t.tolist()) for i, t in ngram_join.token_sets(texts)] == whole
    assert [i for i, _ in whole] == list(range(len(texts)))
    assert len(seen) > 1 and all(len(a) == 1 or len(real(a)[0]) <= 1000 for a in seen)


def test_sets_are_one_file_per_bucket(spark, monkeypatch):
    # the driver holds every file of the table: a file for every task and bucket grows with the square of the input
    from strata.llm import ngram_join

    tables = []
    monkeypatch.setattr(ngram_join, "bucketed", lambda *a, own=ngram_join.bucketed, **b: tables.append(own(*a, **b)) or tables[-1])
    texts = [f"a passage of text that number {i // 2} has but for one word at its very end {i % 2}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    got = {r.doc_id: r.component_id for r in similar_groups(docs, words=2, percent=80, bits=1 << 16).collect()}
    assert got == {i: i // 2 * 2 for i in range(300)}
    files = [t.inputFiles() for t in tables]
    assert [len(f) <= int(spark.conf.get("spark.sql.shuffle.partitions")) for f in files] == [True]
    assert tables[0].select("c1", "c2").distinct().count() == 300
