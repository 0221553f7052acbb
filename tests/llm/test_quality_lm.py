import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import quality_lm
from strata.llm.quality_lm import QualityModel, grams, kneser_ney, op3_quality_classifier, symbols


def test_symbols_and_grams():
    texts = [b"ab ab ab cd", b"", b"x", b"x x\n x", b"  q  q"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    out, to = symbols(raw, offs)
    assert [bytes(out[a:b]) for a, b in zip(to, to[1:], strict=False)] == [b"ab\x01\x01 cd", b"", b"x", b"x\x01\x01", b"  q\x01"]
    g = grams(out, to, 3)
    code = lambda s: int.from_bytes(s, "big")
    assert g[:7].tolist() == [code(b"a"), code(b"ab"), code(b"ab\x01"), code(b"ab\x01"), code(b"ab "), code(b"b c"), code(b" cd")]


def brute(counts, order):
    """Modified Kneser-Ney, read off the definition."""
    level = {order: dict(counts)}
    for k in range(order - 1, 0, -1):
        level[k] = Counter(g & ((1 << 8 * k) - 1) for g in level[k + 1])

    def discounts(c):
        n = [sum(v == j for v in c.values()) for j in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        out = []
        for j in (1, 2, 3):
            d = 0.5 * j if y is None or not n[j - 1] else j - (j + 1) * y * n[j] / n[j - 1]
            out.append(max(0.05, min(j - 0.05, d)))
        return out

    tables = {}
    for k, c in level.items():
        h = defaultdict(list)
        for g, v in c.items():
            h[g >> 8].append(v)
        tables[k] = (c, h, discounts(c))

    def p(g, k):
        if not k:
            return 1 / 256
        c, h, d = tables[k]
        g &= (1 << 8 * k) - 1
        low = p(g, k - 1)
        if g >> 8 not in h:
            return low
        all_ = h[g >> 8]
        back = sum(d[min(v, 3) - 1] for v in all_) / sum(all_)
        v = c.get(g, 0)
        return (max(v - d[min(v, 3) - 1], 0) if v else 0) / sum(all_) + back * low

    return lambda g: p(g, order)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_probabilities_against_brute_force(spark, order):
    text = b"the cat sat on the mat and the rat sat on the cat " * 3 + b"a quick brown fox"
    raw = np.frombuffer(text, np.uint8)
    g = Counter(grams(raw, np.array([0, len(raw)]), order).tolist())
    asked = [*g, *[x ^ 5 for x in g], 0, (1 << 8 * order) - 1]
    counts = spark.createDataFrame([(7, k, v) for k, v in g.items()], "m long, g long, c long")
    got = {r.g: r.p for r in kneser_ney(counts, spark.createDataFrame([(7, x) for x in set(asked)], "m long, g long"), order).collect()}
    want = brute(g, order)
    for x in set(asked):
        assert math.isclose(got[x], want(x), rel_tol=1e-9), x
    if order == 2:                       # a seen context's probabilities add up to 1
        every = spark.createDataFrame([(7, (ord("t") << 8) + b) for b in range(256)], "m long, g long")
        assert math.isclose(sum(r.p for r in kneser_ney(counts, every, order).collect()), 1.0, rel_tol=1e-9)


def test_held_out_accuracy(spark):
    """The other half of the labels is not shown to the model."""
    from strata.llm.common import table

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    half = table(spark, sf, "labels").filter("quality = 1 AND toxic = 0 AND doc_id % 2 = 0").select("doc_id")
    model = QualityModel(table(spark, sf, "documents"), half)
    got = {r.id: r.keep for r in model.scores.collect() if r.lang == "en" and r.id % 2}
    good = [got[d] for d in got if labels.get(d) == 1]
    bad = [got[d] for d in got if labels.get(d) == 0]
    assert len(good) > 30 and sum(good) / len(good) >= 0.95
    assert len(bad) > 10 and sum(bad) / len(bad) <= 0.2


def test_edge_rows(spark, edge_docs, no_docs):
    trusted = spark.createDataFrame([(1,), (7,), (None,)], "doc_id long")
    model = QualityModel(edge_docs, trusted)
    rows = model.scores.collect()
    assert len(rows) == edge_docs.count()
    assert all(r.keep for r in rows if r.n == 0 or r.threshold is None)
    kept = model.kept_rows()
    assert kept.columns == edge_docs.columns
    key = lambda r: (r.doc_id or -1, r.text or "", r.n)
    got, whole = sorted(kept.collect(), key=key), sorted(edge_docs.collect(), key=key)
    assert len(got) == sum(r.keep for r in rows) and all(r in whole for r in got)
    assert any(r.doc_id == 3 and r.text is None for r in got)      # null stays null
    empty = QualityModel(no_docs, trusted)
    assert empty.scores.count() == 0 and empty.kept_rows().count() == 0


def test_query(spark):
    rows = op3_quality_classifier(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and len({r.doc_id for r in rows}) == 200


def test_four_symbols_of_context(spark):
    """Crossed endings differ from the trusted texts only by the symbol four places back."""
    plain, crossed = "qabcx---zabcy---" * 10, "qabcy---zabcx---" * 10
    rows = [(i, crossed if i >= 100 else plain, "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = QualityModel(docs, spark.createDataFrame([(i,) for i in range(80)], "doc_id long"))
    bits = {r.id: r.bits for r in model.scores.collect()}
    assert min(bits[i] for i in range(100, 120)) > 1.5 * max(bits[i] for i in range(80, 100))


def test_query_against_brute_force(spark, tmp_path):
    """Bits, thresholds and decisions of every row, read off the definition: folds, models, shrinking and quantiles."""
    rng = np.random.default_rng(9)
    words = ["the", "river", "runs", "to", "a", "wide", "sea", "under", "stone", "and"]
    rows = []
    for i in range(60):
        w = list(rng.choice(words, int(rng.integers(0, 25))))
        if i % 7 == 3:
            w = ["zq" + "".join(chr(int(c)) for c in rng.integers(33, 120, 12)) for _ in w]
        rows.append((i, " ".join(w) + (" and and and" if i % 5 == 0 else ""), ["en", "de", None][i % 3]))
    rows += [(60, None, "en"), (61, "", "en"), (62, "lonely", "fr"), (5, rows[5][1], rows[5][2])]
    trusted = [r[0] for r in rows if r[0] < 62 and r[0] % 7 != 3 and r[0] % 4]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1 if i in trusted else 0, 0) for i in range(62)] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    folds = {(r.doc_id, r.text): r.f for r in spark.createDataFrame(rows, "doc_id long, text string, lang string")
             .selectExpr("doc_id", "text", "xxhash64(3, doc_id, text) & 1 AS f").collect()}

    def own_grams(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        out, offs = symbols(raw, np.array([0, len(raw)]))
        return grams(out, offs, 5).tolist() if len(out) else []

    counts = defaultdict(Counter)
    for d, text, lang in rows:
        if d in trusted:            # a row trains the model that scores the other fold
            counts[lang, folds[d, text] ^ 1].update(own_grams(text))
    models = {k: brute(c, 5) for k, c in counts.items()}
    bits, size = [], []
    for d, text, lang in rows:
        g = own_grams(text)
        p = models.get((lang, folds[d, text]), lambda _: 1 / 256) if g else None
        low = (lambda x, p=p: p(x)) if p else None
        bits.append(sum(-math.log2(low(x)) for x in g))
        size.append(len(g))
    got = sorted((tuple(r) for r in op3_quality_classifier(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for lang in {r[2] for r in rows}:
        own = [i for i, r in enumerate(rows) if r[2] == lang]
        known = [i for i in own if rows[i][0] in trusted]
        total = sum(size[i] for i in known)
        mean = sum(bits[i] for i in known) / total if total else None
        value = {i: (bits[i] + 200 * mean) / (size[i] + 200) if size[i] and mean is not None else None for i in own}
        ranked = sorted(value[i] for i in known if size[i])
        limit = None
        if ranked:
            half, high = (ranked[max(math.ceil(q * len(ranked)) - 1, 0)] for q in (0.5, 0.95))
            limit = high + 6 * (high - half)
        for i in own:
            keep = True if limit is None or value[i] is None else value[i] <= limit
            want.append((rows[i][0], lang, size[i], value[i] and 2 ** value[i], limit and 2 ** limit, keep))
    want.sort(key=repr)
    assert len(got) == len(want) and {r[5] for r in want} == {True, False}
    for a, b in zip(sorted(got, key=lambda r: (r[0], repr(r[1]))), sorted(want, key=lambda r: (r[0], repr(r[1]))), strict=True):
        assert a[:3] == b[:3] and a[5] == b[5], (a, b)
        assert all((x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-4)) for x, y in zip(a[3:5], b[3:5], strict=True)), (a, b)


def test_answers_travel_packed_and_levels_go(spark, monkeypatch):
    """Few parcels come back to a block instead of a row per question; of the model's tables only the scores stay."""
    import os

    from strata.session import checkpoint_root

    folder = f"{checkpoint_root(spark)}/strata-work".removeprefix("file:")
    tables = lambda: {f for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith("quality-")}
    before, seen = tables(), {}
    answers = QualityModel._answers

    def spy(self, learn, order):
        out = answers(self, learn, order)
        seen["parcels"] = out.count()
        return out

    monkeypatch.setattr(QualityModel, "_answers", spy)
    docs = spark.createDataFrame([(i, f"text number {i * 7919} of some words {i}", "en") for i in range(300)], "doc_id long, text string, lang string").coalesce(1)
    model = QualityModel(docs, spark.createDataFrame([(i,) for i in range(0, 300, 2)], "doc_id long"))
    assert seen["parcels"] <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {f.rsplit("-", 1)[0] for f in tables() - before} <= {"quality-scores", "quality-limits"}
    assert model.scores.count() == 300


def test_parcels_keep_every_answer(monkeypatch):
    monkeypatch.setattr(quality_lm, "PARCEL_ROWS", 50)
    monkeypatch.setattr(quality_lm, "PARCELS", 3)
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(-2**62, 2**62)) if i % 3 else -4, int(rng.integers(0, 2**40)), float(np.float32(rng.random())), sorted(rng.choice(9, int(rng.integers(1, 5)), replace=False).tolist()))
            for i in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 20], strict=True), [pa.int64(), pa.int64(), pa.float32(), pa.list_(pa.int64())], strict=True)],
                                          names=["m", "g", "bits", "asked"]) for k in range(0, 200, 20)]
    got = []
    for b in quality_lm._parcels(iter(batches)):
        assert b.num_rows <= 3
        for block, parcel in zip(b.column("block").to_pylist(), b.column("parcel"), strict=True):
            got += [(block, *r) for r in zip(*(c.tolist() for c in quality_lm._unpacked([parcel])), strict=True)]
    assert sorted(got) == sorted((block, m, g, x) for m, g, x, asked in rows for block in asked)


def test_questions_leave_in_parts(monkeypatch):
    monkeypatch.setattr(quality_lm, "PART", 100)
    rows = pa.table({"text": ["".join(map(chr, range(40, 120))) * 2, "other words"], "m": [2, 5]})
    out = quality_lm._ask(5)(7, rows, pa.table({"row": [0]}))
    assert out.num_rows > 100 and max(b.num_rows for b in out.to_batches()) <= 100
    assert quality_lm._ask(5)(None, None, None).num_rows == 0


def test_counts_are_merged_as_they_come(monkeypatch):
    monkeypatch.setattr(quality_lm, "LOOSE", 50)
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 300, 40) for _ in range(200)]
    for counted in (False, True):
        counts = quality_lm.Counts(counted)
        for p in parts:
            counts.add(p)
            assert sum(len(x[0]) for x in counts.parts) <= 2 * 300 + 50 + 40
        g, *n = counts.merge()
        want = Counter(np.concatenate(parts).tolist())
        assert g.tolist() == sorted(want) and (not counted or n[0].tolist() == [want[x] for x in sorted(want)])


def test_asking_holds_little_beside_its_answer(monkeypatch):
    """A block's repeated n-grams do not pile up piece by piece."""
    import tracemalloc

    monkeypatch.setattr(quality_lm, "PIECE", 1 << 14)
    monkeypatch.setattr(quality_lm, "LOOSE", 1 << 10)
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, rng.integers(97, 123, 7))) for _ in range(20)]
    rows = pa.table({"text": [" ".join(rng.choice(words, 500)) for _ in range(500)], "m": pa.array([2] * 500)})
    tracemalloc.start()
    out = quality_lm._ask(5)(7, rows, pa.table({"row": np.arange(0, 500, 2)}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 << 20, peak
    n = np.asarray(out.column("n"))
    raw, offs = quality_lm.utf8(rows.column("text"))
    g = grams(*symbols(raw, offs), 5)
    assert sorted(np.asarray(out.column("g"))[n == 0].tolist()) == sorted(set(g.tolist()))
    assert set(np.asarray(out.column("m"))[n > 0].tolist()) == {3}


def test_smaller_blocks_score_alike(spark):
    docs = spark.createDataFrame([(i, f"text number {i * 7919} of some words {i}" * (i % 4), "en" if i % 3 else None) for i in range(200)],
                                 "doc_id long, text string, lang string").coalesce(2)
    trusted = spark.createDataFrame([(i,) for i in range(0, 200, 2)], "doc_id long")
    got = [{r.id: (r.n, r.bits, r.keep) for r in QualityModel(docs, trusted, **kw).scores.collect()} for kw in ({}, {"block_bytes": 900})]
    assert got[0].keys() == got[1].keys()
    for i, (n, bits, keep) in got[0].items():
        assert got[1][i][0] == n and got[1][i][2] == keep and got[1][i][1] == pytest.approx(bits, rel=1e-9)
