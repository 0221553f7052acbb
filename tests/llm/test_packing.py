import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from strata.llm.packing import FitTree, WordTokenizer, best_fit_plan, op2_packing, pack, place, sequences, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for _ in range(60):
        window = int(rng.integers(4, 40))
        items = sorted(rng.integers(1, window + 1, int(rng.integers(0, 80))).tolist(), reverse=True)
        room: list[int] = []
        for n in items:                     # item by item: the tightest open window
            fit = min((r for r in room if r >= n), default=None)
            if fit is None:
                room.append(window - n)
            else:
                room[room.index(fit)] -= n
        used: Counter = Counter()
        done: Counter = Counter()
        for n, a, b, first, per, offset in best_fit_plan(Counter(items), window).tolist():
            for k in range(b - a):
                assert used[first + k // per] == offset + (k % per) * n
                used[first + k // per] += n
            done[n] += b - a
        assert done == Counter(items) and sorted(window - u for u in used.values()) == sorted(room)


def test_fit_tree():
    rng = np.random.default_rng(4)
    tree, open_ = FitTree(50), set()
    for _ in range(2000):
        i = int(rng.integers(0, 51))
        (open_.discard if i in open_ else open_.add)(i)
        tree.set(i, i in open_)
        need = int(rng.integers(0, 51))
        assert tree.tightest(need) == min((x for x in open_ if x >= need), default=-1)


def test_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    texts = ["It's DON'T I'll you've''s 'S a's,'re", "é É ß ﬁ ½ ² x² 3½ ªº µ", "İstanbul ǅ Σίσυφος ΟΔΟΣ", "é 日本 \x85 \xa0 a​b", "<|endoftext|> hi", "", "  ",
             "!!'s !'t", "Ŀ ŀ ŉ Ĳ ſ", "a\x1cb", "×÷¿¡«»", "a­b", "word " * 2000]
    import pyarrow.parquet as pq

    texts += pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()[::7]
    tok = Tokenizer.from_file(PATH)
    for t, got in zip(texts, WordTokenizer(PATH).encode(texts), strict=True):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids, t[:80]


def check(rows, window):
    """Every id in exactly one piece, windows gapless."""
    for doc in {r.doc_id for r in rows}:
        own = [r for r in rows if r.doc_id == doc]
        total = {r.doc_tokens for r in own}
        assert sum(r.length for r in own) % min(total) == 0
    at: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0) and 0 < r.length <= window
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= window
    return at


def test_query(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    rows = op2_packing(spark, "/root/testdata/sf0.001").collect()
    at = check(rows, 4096)
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    for r in rows:
        ids = np.array([*tok.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert {r.doc_id for r in rows} == set(docs)
    assert sum(4096 - n for n in at.values()) < 0.1 * sum(at.values())


@pytest.mark.parametrize("parts", [1, 7])
def test_edge_rows(spark, edge_docs, no_docs, parts):
    rows = pack(edge_docs.repartition(parts), PATH, window=64).collect()
    check(rows, 64)
    by = Counter((r.doc_id, r.start) for r in rows)
    assert by[2, 0] == 2 and by[None, 0] == 1                 # a repeated row is packed twice
    assert {r.doc_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert pack(no_docs, PATH).count() == 0


def test_padding(spark):
    pieces = spark.createDataFrame([(i, 0, n, n, bytes([i, 0, 0, 0]) * n) for i, n in enumerate([7, 4, 3, 2, 1, 8, 6])],
                                   "doc_id long, start long, length long, doc_tokens long, ids binary")
    out = {r.sequence_id: r for r in sequences(place(pieces, 8), 8).collect()}
    assert sorted(r.length for r in out.values()) == [7, 8, 8, 8]
    assert all(len(r.ids) == 32 for r in out.values())
    lone = {r.length: len(r.ids) for r in sequences(place(pieces.filter("doc_id = 1"), 8), 8).collect()}
    assert lone == {4: 16}                                     # a power of two is not padded
    assert token_pieces(pieces.selectExpr("doc_id", "'' AS text"), PATH).count() == 7


def test_place_replaces_columns_of_its_names(spark):
    pieces = spark.createDataFrame([(1, 4096, "x", "y"), (2, 9, "x", "y"), (3, 9, None, None)], "doc_id long, length long, sequence_id string, offset string")
    got = place(pieces).collect()
    assert {(r.doc_id, r.offset) for r in got} in ({(1, 0), (2, 0), (3, 9)}, {(1, 0), (2, 9), (3, 0)}) and len(got[0]) == 4


def test_words_are_encoded_once_per_worker(spark):
    """The next task of a worker, and the next batch, know the words; ids are those of the library."""
    from strata.llm.packing import word_tokenizer

    assert word_tokenizer(PATH) is word_tokenizer(PATH)
    tok, asked = WordTokenizer(PATH), []
    learn = tok._learn
    tok._learn = lambda words: (asked.extend(words), learn(words))[1]
    texts = ["It's a naïve café, isn't it? 12 ways", "", "日本 text", "a <|b", "it's it's"]
    for _ in range(2):
        for t, ids in zip(texts, tok.encode(texts), strict=True):
            assert ids.tolist() == tok.tok.encode(t, add_special_tokens=False).ids
    tok.old, tok.new = tok.new, {}
    assert tok.encode(texts[:1])[0].tolist() == tok.tok.encode(texts[0], add_special_tokens=False).ids
    assert asked and len(asked) == len(set(asked)) and all(isinstance(v, bytes) for v in tok.new.values())


def test_words_are_cut_by_the_rules_and_looked_up_once():
    """Texts are cut together; the dictionary sees each distinct word of them once, not every word of every text."""
    rng = np.random.default_rng(11)
    letters = list("'''''sStTrRvVeEmMlLdDaz09 \n\t.,!éÉßÿŸŁłªº²½×÷¿¡Àſ")
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(1500)]
    tok, asked = WordTokenizer(PATH), []
    known = tok._known
    tok._known = lambda words: asked.append(words) or known(words)
    got = tok.encode(texts * 2)
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0]))
    assert all(WordTokenizer.PLAIN.fullmatch(t) for t in texts)
    for t, one, again in zip(texts, got[:len(texts)], got[len(texts):], strict=True):
        assert one.tolist() == again.tolist() == tok.tok.encode(t, add_special_tokens=False).ids, t


def test_words_do_not_outlive_their_task(spark):
    """Workers are used again by other steps, which need the memory."""
    from strata.llm.packing import word_tokenizer

    docs = spark.createDataFrame([(i, f"some words {i} and others{i}") for i in range(200)], "doc_id long, text string")
    path = PATH

    def kept(batches):
        import pyarrow as pa

        for b in batches:
            tok = word_tokenizer(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(tok.new) + len(tok.old)] * b.num_rows, pa.int64())], names=["n"])

    token_pieces(docs, PATH).write.format("noop").mode("overwrite").save()
    assert {r.n for r in docs.select("doc_id").mapInArrow(kept, "n long").collect()} == {0}


def test_memory_goes_back_after_large_batches_and_at_the_end(monkeypatch):
    import pyarrow as pa

    from strata.llm import common

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    batch = lambda n: pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64))], names=["n"])
    twice = common.lean(lambda batches: (x for b in batches for x in (b, b)))
    assert [b.num_rows for b in twice(iter([batch(1), batch(common.MUCH // 8), batch(2)]))] == [1, 1, common.MUCH // 8, common.MUCH // 8, 2, 2]
    assert len(calls) == 2
    group = common.lean_group(lambda tab: tab.slice(0, 1))
    assert group(pa.table({"n": np.zeros(common.MUCH, np.int64)})).num_rows == 1 and len(calls) == 3
    assert group(pa.table({"n": [1]})).num_rows == 1 and len(calls) == 3
