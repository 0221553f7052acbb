import numpy as np
import pytest

from strata.llm.ann import SEARCH_BEAM, SHARD_ROWS, beam_for, beam_search, build_graph, nearest, pivots, robust_prune


def exact(ids, vecs, query, k):
    """(id, score) of the k nearest by brute force."""
    q = vecs[ids.index(query)]
    got = sorted(((-float(np.dot(v, q) / np.sqrt(np.dot(v, v) * np.dot(q, q))), i) for i, v in zip(ids, vecs, strict=True) if i != query))
    return [(i, -s) for s, i in got[:k]]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(8)
    n = 3000
    vecs = rng.normal(size=(n, 24)).astype(np.float32)
    vecs[::3] = vecs[0]                        # a third of all rows is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    rows = nearest(df, df.filter("vec_id % 50 = 0"), shard_rows=500, block_rows=16).collect()
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = total = 0
    for q in range(0, n, 50):
        want = exact(list(range(n)), vecs.astype(float), q, 5)
        assert len(got[q]) == 5 and q not in dict(got[q])
        for i, s in got[q]:
            a, b = vecs[i].astype(float), vecs[q].astype(float)
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        hit += len({i for i, _ in got[q]} & {i for i, _ in want})
        total += 5
        if q % 3 == 0:                          # ties of copies go to the smaller ids
            assert [i for i, _ in got[q]] == [i for i in range(0, 21, 3) if i != q][:5]
    assert hit / total >= 0.9


@pytest.mark.parametrize("dims, kind", [(64, "random"), (384, "random"), (64, "clusters"), (384, "clusters"), (64, "many"), (384, "many")])
def test_recall_of_a_full_shard(dims, kind):
    """Recall at 5 of one production shard, by brute force."""
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(SHARD_ROWS, dims)).astype(np.float32)
    if kind != "random":
        groups = {"clusters": 40, "many": 700}[kind]
        x = (x * 0.3 + rng.normal(size=(groups, dims))[rng.integers(0, groups, SHARD_ROWS)]).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, entry = build_graph(x)
    q = np.arange(0, SHARD_ROWS, 50)
    found, _ = beam_search(x, graph, pivots(x, entry), x[q], beam_for(dims, SEARCH_BEAM, 5))
    best = np.argsort(-(x[q] @ x.T), axis=1)[:, :6]
    hit = sum(len(set(f[:6]) & set(b)) - 1 for f, b in zip(found, best, strict=True))
    print(dims, kind, hit / (5 * len(q)))
    assert hit / (5 * len(q)) >= 0.9, hit / (5 * len(q))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (50, [1.0, 1.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0, 0.0]), (0, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, k1 int, score int")
    got = nearest(df, df.filter("vec_id % 50 = 0")).collect()
    assert {r.vec_id for r in got} <= {0, 7, 50}
    assert sorted((r["rank"], r.vec_id) for r in got if r.query_id == 50) == [(1, 0), (2, 0), (3, 7)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest(df, df.limit(0)).count() == 0


def test_pruning_keeps_diverse_edges():
    x = np.array([[1, 0], [0.999, 0.045], [0.998, 0.063], [0, 1]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = robust_prune(x, np.array([0]), np.array([[1, 2, 3, 1, -1, 0]]), 3, 1.2)[0]
    assert out[0] == 1 and 2 not in out and 3 in out
    graph, entry = build_graph(x)
    assert graph.shape[0] == 4 and 0 <= entry < 4
