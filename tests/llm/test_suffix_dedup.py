from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm.suffix_dedup import anchors, remove_repeats, repeated_starts


def brute(texts, size):
    """Bytes left of each text when every byte covered by a repeated string goes."""
    seen = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


def test_bwt_intervals_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        size = int(rng.integers(3, 18))
        base = bytes(rng.integers(97, 97 + int(rng.integers(1, 5)), 200, dtype=np.uint8))
        windows, origin = [], []
        for i in range(int(rng.integers(1, 10))):
            s = int(rng.integers(0, 180))
            windows.append(base[s:s + int(rng.integers(0, 25))])
            # some windows overlap in one text, others are texts of their own
            origin.append((i << 40) if rng.random() < 0.6 else (99 << 40) + s)
        at = defaultdict(set)
        for w, o in zip(windows, origin, strict=True):
            for p in range(len(w) - size + 1):
                at[w[p:p + size]].add(o + p)
        want = [(i, p) for i, w in enumerate(windows) for p in range(len(w) - size + 1) if len(at[w[p:p + size]]) > 1]
        owner, place = repeated_starts(windows, np.array(origin), size)
        assert list(zip(owner.tolist(), place.tolist(), strict=True)) == want


def test_intervals_before_which_one_symbol_stands_move_as_they_are(monkeypatch):
    """Many windows that share a long string: symbols are tried only where several stand before an interval."""
    from strata.llm import suffix_dedup

    rng = np.random.default_rng(12)
    shared = bytes(rng.integers(97, 123, 120, dtype=np.uint8))
    windows = [bytes(rng.integers(97, 123, 20, dtype=np.uint8)) + shared + bytes([97 + i % 2]) * 9
               + bytes(rng.integers(97, 123, 20, dtype=np.uint8)) for i in range(300)]
    x = np.frombuffer(b"\xff".join(windows) + b"\xff", np.uint8)
    order = suffix_dedup.rotation_order(x, 100)
    wrapped = bytes(x) + bytes(x[:200])
    assert order.tolist() == sorted(range(len(x)), key=lambda i: (wrapped[i:i + 160], i))
    calls, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **kw: calls.append(1) or search(*a, **kw))
    border = suffix_dedup.expand_intervals(x[order - 1], 100)
    monkeypatch.undo()
    same = [wrapped[i:i + 100] == wrapped[j:j + 100] for i, j in zip(order.tolist(), order[1:].tolist(), strict=False)]
    assert border[1:-1].tolist() == [not s for s in same]
    assert len(calls) < 60                          # not at each of 100 levels


def test_every_string_has_an_anchor_whose_window_holds_it():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 10, 39, 40, 41, 500)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    spans = defaultdict(list)
    for d, p, before, size, _, _ in anchors(raw, offs, 40, 8):
        for x in zip(d.tolist(), (p - before).tolist(), size.tolist(), strict=True):
            spans[x[0]].append((x[1], x[1] + x[2]))
    for d, t in enumerate(texts):
        for i in range(len(t) - 39):
            assert any(a <= i and i + 40 <= b for a, b in spans[d])
        assert all(0 <= a and b <= len(t) for a, b in spans[d])


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_against_brute_force(spark, hot):
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abcdeé "), n))
    passage, other = word(90), word(70)
    texts = [word(int(rng.integers(0, 60))) + passage + word(int(rng.integers(0, 40))) for _ in range(14)]
    texts += [word(50) + other[k:] + word(20) for k in range(8)] + [word(120), word(120) * 2, "", "abc", "z" * 300, texts[0], texts[0][:100]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs, min_len=40, seed=8, hot_windows=hot).collect()}
    for i, left in enumerate(brute([t.encode() for t in texts], 40)):
        assert bytes(got[i]["__kept"]) == left, i
        assert got[i]["__n_bytes"] == len(texts[i].encode())
        assert sum(s.e - s.s for s in got[i]["__spans"]) == len(texts[i].encode()) - len(left)
        assert all(a.e < b.s for a, b in zip(got[i]["__spans"], got[i]["__spans"][1:], strict=False))


def test_edge_rows(edge_docs, no_docs):
    out = remove_repeats(edge_docs)
    assert out.columns[:len(edge_docs.columns)] == edge_docs.columns
    left = {(r.doc_id, r.n): bytes(r["__kept"]).decode("utf-8", "ignore") for r in out.collect()}
    assert left[3, 4] == left[4, 4] == "" and left[9, 9] == "x"
    assert left[7, 7] == ""                      # all of it is in the longer text too
    assert len(left[8, 8]) < 200 and left[8, 8].endswith("tail")
    assert remove_repeats(no_docs).count() == 0


def test_remove_repeats_replaces_columns_of_its_names(spark):
    df = spark.createDataFrame([(1, "a" * 450, "s", "n"), (2, "b", "s", None)], "doc_id long, text string, `__spans` string, `__n_bytes` string")
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert (got[1]["__n_bytes"], bytes(got[1]["__kept"]), got[2]["__n_bytes"]) == (450, b"", 1)


def staged(spark):
    """Scratch folders that hold rows."""
    from strata.session import checkpoint_root

    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/strata-work")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()


def test_only_the_spans_stay_staged(spark):
    docs = spark.createDataFrame([(i, "word " * 60 + str(i)) for i in range(5)], "doc_id long, text string")
    before = staged(spark)
    out = remove_repeats(docs)
    assert [n.rsplit("-", 1)[0] for n in staged(spark) - before] == ["suffix-repeats"]
    assert out.filter("size(__spans) > 0").count() == 5
