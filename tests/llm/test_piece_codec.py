import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from strata.llm.piece_codec import Units, Vocabulary, decode, decode_with, encode, encode_with

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b\nc\t d é 日本 x", "  lead and trail  ", "x" * 200, "ab" * 500 + "!" * 100, "mixed — “quotes” … 🙂🙃", "́ combining", "the quick-brown foxes' tails",
       "".join(chr(i) for i in range(33, 1000)), "1234567890" * 30, "</s> <unk> <0x41>", "internationalization" * 8]


@pytest.fixture(scope="module")
def model():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def test_ids_equal_the_library_and_decode_back(spark, model):
    texts = ODD + pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()[::5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in decode(encode(docs, PATH), PATH).collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == model.encode(t), t[:60]
        assert got[i].text == t


def test_long_units_are_merged_alike(model):
    v = Vocabulary.load(PATH)
    for t in ODD:
        units = Units(v)
        number, count = units.cut([t, "", t])
        words = {k: w for w, k in units.number.items()}
        assert "".join(words[k] for k in number[:count[0]]) == "▁" + t.replace(" ", "▁") and count[1] == 0
        ids = [i for k in number[:count[0]] for s in (v.merge(words[k]) if len(words[k]) > 1 else [words[k]]) for i in v.piece_ids(s)]
        assert ids == model.encode(t)


def test_a_unit_is_read_as_text_once():
    """Later parts find known units by two hashes; a clash of one hash goes by the texts."""

    class Counted(dict):
        calls = 0

        def setdefault(self, *a):
            self.calls += 1
            return super().setdefault(*a)

    units = Units(Vocabulary.load(PATH))
    units.number = Counted()
    first, _ = units.cut(ODD)
    calls = units.number.calls
    again, _ = units.cut(ODD[::-1])
    assert units.number.calls == calls == len(units.number) and sorted(first.tolist()) == sorted(again.tolist())
    more, count = units.cut([*ODD, "never seen before zebra"])
    assert more[:len(first)].tolist() == first.tolist()
    keys, checks, numbers = units.seen
    assert (keys[1:] > keys[:-1]).all() and len(keys) == len(units.number)
    units.seen = keys, checks ^ 1, numbers      # every hash meets another unit's
    assert units.cut([*ODD, "never seen before zebra"])[0].tolist() == more.tolist()


def test_viterbi_against_every_segmentation(spark):
    pieces = [(1, "▁", -3.0), (2, "a", -2.0), (3, "b", -2.1), (4, "ab", -2.5), (5, "▁a", -3.55), (6, "bab", -3.05), (7, "ba", -2.25), (8, "abba", -4.6)]
    v = Vocabulary(pieces, None, 0, 9)
    texts = ["abab ba", "aab", "abbaabba b", "bbbb", "c ab", "", None]

    def best(unit):
        if not unit:
            return (0.0, [])
        some = [(s + best(unit[len(p):])[0], [i, *best(unit[len(p):])[1]]) for i, p, s in pieces if unit.startswith(p)]
        return max(some, default=(-1e9, [0]))

    got = {r.doc_id: r.ids for r in encode_with(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), v, "doc_id", "text", "unigram").collect()}
    for i, t in enumerate(texts):
        if t and "c" not in t:
            assert got[i] == best("▁" + t.replace(" ", "▁"))[1], t
    assert got[4] == [1, 0, 1, 4] and got[5] == got[6] == []


def test_edge_rows(spark, edge_docs, no_docs, model):
    enc = encode(edge_docs, PATH)
    rows = decode(enc, PATH, to="back").collect()
    want = sorted(((r.doc_id or 0), r.text or "") for r in edge_docs.collect())
    assert sorted(((r.doc_id or 0), r.back) for r in rows) == want
    assert encode(no_docs, PATH).count() == 0
    v = Vocabulary.load(PATH)
    ids = spark.createDataFrame([(1, None), (2, []), (3, [3 + 0xC3]), (4, model.encode("ok"))], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in decode_with(ids, v, "ids", "text").collect()} == {1: "", 2: "", 3: "�", 4: "ok"}


def test_decode_replaces_a_column_of_its_name(spark, model):
    df = spark.createDataFrame([(1, model.encode("over there"), "old")], "doc_id long, ids array<int>, text string")
    assert decode(df, PATH).collect()[0].text == "over there"


def test_askers_do_not_travel_with_every_substring(spark):
    """Of a unit's substrings one carries its askers, and the groups need no exchange after that of the units."""
    from strata.llm.piece_codec import lattice

    v = Vocabulary.load(PATH)
    texts = ["international", "the▁quick", "zz", "ab", "qxzj"]
    units = spark.createDataFrame([(t, 0, [7, 8 + i]) for i, t in enumerate(texts)], "unit string, salt long, asked array<long>")
    out = lattice(units.repartition(3, "unit", "salt"), v, "bpe", ["unit", "salt"], ["asked"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CASE WHEN (len" in plan and "asked" in plan.split("CASE WHEN (len", 1)[1]
    got = {r.unit: r for r in out.collect()}
    for i, t in enumerate(texts):
        if t not in got:       # no piece fits
            assert v.merge(t) == list(t)
            continue
        cuts = [k for k in range(len(t) + 1) if got[t].cuts >> k & 1]
        assert [t[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] == v.merge(t)
        assert got[t].asked == [7, 8 + i] and got[t].salt == 0


def test_units_are_spelled_together(model, monkeypatch):
    """Ids of many units at once: only symbols without a piece, each once, go one by one."""
    from strata.llm.piece_codec import unit_ids

    v = Vocabulary.load(PATH)
    units = Units(v)
    units.cut([*ODD, "the international zoo of a thousand words"])
    words = list(units.number)
    masks = np.zeros(len(words), np.int64)
    for k, w in enumerate(words):
        if k % 3 and 1 < len(w) <= 60:      # the others are split here
            masks[k] = sum(1 << int(e) for e in np.cumsum([0, *map(len, v.merge(w))]))
    want = [[i for s in (v.merge(w) if len(w) > 1 else [w]) for i in v.piece_ids(s)] for w in words]
    asked = []
    real = Vocabulary.piece_ids
    monkeypatch.setattr(Vocabulary, "piece_ids", lambda self, s: (asked.append(s), real(self, s))[1])
    ids, size = unit_ids(v, words, masks, "bpe")
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == want
    assert len(asked) == len(set(asked)) and not set(asked) & set(v.ids)
    spans = v.spans     # another piece stands where a hash says: the characters decide
    spans.begin, spans.ids = np.roll(spans.begin, 1), np.roll(spans.ids, 1)
    ids, size = unit_ids(v, words, masks, "bpe")
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == want


def test_equal_units_have_one_number():
    units = Units(Vocabulary.load(PATH))
    text = "a word, a WORD and é中\U0001f600 again a word"
    number, count = units.cut([text, "", text, "other"])
    words = {k: w for w, k in units.number.items()}
    assert count[0] == count[2] and count[1] == 0
    assert number[:count[0]].tolist() == number[count[0]:2 * count[0]].tolist()
    assert "".join(words[k] for k in number) == ("▁" + text.replace(" ", "▁")) * 2 + "▁other"
    assert len(words) == len(units.number) == len(set(number.tolist()))
