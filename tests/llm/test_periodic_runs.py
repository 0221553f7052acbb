import hashlib
import random
import re
import zlib

import numpy as np

from strata.llm.periodic_runs import LastEnds, find_runs, op12_periodic_runs, periodic_runs, suffix_automaton


def brute(w):
    """All runs by definition: every period, maximal stretches, smallest period by trying the smaller ones."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def damaged(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(w):
    runs = brute(w)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def random_words(rnd):
    out = []
    while len(out) < rnd.randint(0, 90):
        part = [rnd.randint(0, rnd.choice([1, 2, 5, 40])) for _ in range(rnd.randint(1, 7))]
        out += part * rnd.choice([1, 1, 2, 3, 4, 5, 9]) + part[:rnd.randint(0, len(part))]
    return out


def test_runs_against_brute_force_with_and_without_gate():
    rnd = random.Random(3)
    texts = [random_words(rnd) for _ in range(1500)]
    texts += [[], [1], [1] * 5, [1] * 6, [1, 2] * 3, [1, 2] * 4, [1, 2, 3] * 4, [1, 2, 3] * 4 + [1, 2, 3] * 4, [1] * 300, [0, 0, 1] * 60]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    texts += fib
    codes = np.array([x for t in texts for x in t])
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    want = [brute(t) for t in texts]
    assert sum(map(len, want)) > 300
    assert find_runs(codes, offs) == want
    assert find_runs(codes, offs, gate=False) == want


def test_access_meets_last_ends():
    rnd = random.Random(5)
    for _ in range(40):
        w = [rnd.randint(0, 2) for _ in range(60)]
        link, longest, ends = suffix_automaton(w)
        tree = LastEnds(link)
        for i, state in enumerate(ends):
            got = [(j, longest[s]) for j, s in tree.access(state, i)]
            want, reach = [], 0     # the nearest earlier ends by how far they agree to the left
            for j in range(i - 1, -1, -1):
                k = 0
                while k <= j and w[j - k] == w[i - k]:
                    k += 1
                if k > reach:
                    want.append((j, k))
                    reach = k
            assert sorted(g for g in got if g[1]) == sorted(want)


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        w = damaged(d.doc_id, d.text)
        if len(w) < 1200:
            assert got[d.doc_id] == expected(w), d.doc_id


def test_words_of_any_text(spark, tmp_path):
    cases = ["", None, " \t\n\x0b\x0c\r", "a a a a a a", "\ta  a\na\x0ba\x0ca\ra ", "a\x1ca\x85a\xa0a a a", "é 日本 " * 5, "x", "ab " * 5000,
             "a b c a b c a b c a b c x y x y x y x y", "a b a b a b a b a a a a a a", "\x00 \x00 \x00 \x00 \x00 \x00"]
    rows = [(i, t) for i, t in enumerate(cases * 30)] + [(None, "z z z z z z z"), (5, "q"), (5, "q")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    memo = {}
    want = []
    for i, t in rows:
        w = damaged(i, t)
        if (key := " ".join(w)) not in memo:
            memo[key] = expected(w) if len(w) < 1000 else None
        if memo[key] is None:       # one run over everything, found by hand
            sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
            memo[key] = (1, 0, 5000, 1, 5_000_000, sha("0,5000,1\n"), sha("ab"))
        want.append((i, *memo[key]))
    assert got == sorted(want, key=repr)


def test_odd_tables(spark, edge_docs, no_docs):
    got = periodic_runs(edge_docs)
    assert got.count() == edge_docs.count() and got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert periodic_runs(no_docs).count() == 0
    clash = edge_docs.selectExpr("doc_id", "text", "k1 AS runs", "n AS n_words", "k1 AS collapsed")
    assert sorted(r.n_words for r in periodic_runs(clash).collect()) == sorted(r.n_words for r in got.collect())
