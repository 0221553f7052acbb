"""SentencePiece encoding and decoding (operator 10): a relational lattice over distinct units.

*Units.* A text (dummy space in front, spaces as U+2581) is cut wherever no piece
holds the two neighbouring characters, so no piece can span a cut and a unit's
pieces do not depend on its surroundings.

*Lattice.* Blocks of texts ask for their distinct units once. A unit's substrings of
at most the longest piece's length are exploded and equi-joined with the piece table
(a vocabulary file, so its size is fixed; it is broadcast); the edges are grouped by
unit and folded with a higher-order aggregate. The answer is a bit mask of the cuts
inside the unit. It goes back to the blocks that asked; askers are grouped by unit
and salt, so a unit that every block holds is no unbounded group. Units longer than
60 characters do not fit the mask; they are merged in the task that holds the text.

*Fold.* Pieces of a unigram model are chosen by Viterbi (best sum of scores). A BPE
model is different: its scores are merge ranks and the best sum of ranks is not what
its merges give. For BPE files the fold applies the edges by rank, each when exactly
two symbols span it, which gives the merges' result. ``kind`` says which.

Characters without a piece become byte pieces (byte fallback). Decoding joins
pieces, turns byte pieces into bytes and drops the dummy space; it undoes encoding
exactly, except that U+2581 itself reads as a space.

Defined results: null and empty texts have no ids; decoding no ids gives the empty
text; repeated rows are encoded row by row; other columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.blocks import Blocks, unpack_rows
from strata.llm.common import table
from strata.llm.suffix_dedup import C1, C2, SpanHash, mix

SPACE = "▁"
#: characters in a unit whose cuts fit a 64-bit mask
LONGEST = 60
BLOCK_BYTES = 16 << 20
TEXTS = 1 << 18
#: distinct units of a block that are spelled together
UNITS = 1 << 15
#: block numbers that differ below this bit are answered together (blocks of 512 input partitions)
SALT_BIT = 29
#: an asker is one number: its block's number below SALT_BIT, then the unit's number in the block
U_BITS = 32


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int] | None, unknown: int, size: int):
        self.pieces = pieces                       # normal pieces: id, text, score
        self.byte_ids, self.unknown, self.size = byte_ids, unknown, size
        self.ids = {p: i for i, p, _ in pieces}
        self.scores = {p: s for _, p, s in pieces}
        self.longest = max((len(p) for _, p, _ in pieces), default=1)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        normal = [(i, m.id_to_piece(i), m.get_score(i)) for i in range(n)
                  if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        byte_ids = [i for i in range(n) if m.is_byte(i)]
        return cls(normal, byte_ids if len(byte_ids) == 256 else None, m.unk_id(), n)

    @cached_property
    def joins(self) -> tuple[np.ndarray, np.ndarray]:
        """Class of each code point, and which classes stand next to each other in some piece."""
        pairs = {(a, b) for _, p, _ in self.pieces for a, b in zip(p, p[1:], strict=False)}
        chars = sorted({c for ab in pairs for c in ab})
        cls = np.zeros(0x110000, np.int16 if len(chars) < 32000 else np.int32)
        for k, c in enumerate(chars):
            cls[ord(c)] = k + 1
        joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            joined[cls[ord(a)], cls[ord(b)]] = True
        return cls, joined

    @cached_property
    def spans(self) -> Pieces:
        return Pieces(self.ids)

    @cached_property
    def speller(self) -> Speller:
        return Speller(self)

    def piece_ids(self, symbol: str) -> list[int]:
        i = self.ids.get(symbol)
        if i is not None:
            return [i]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in symbol.encode("utf-8", "surrogatepass")]

    def merge(self, unit: str) -> list[str]:
        """BPE merges of a long unit with a heap of pairs, by rank then place."""
        sym: list[str | None] = list(unit)
        prev, nxt = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        heap: list = []

        def push(a, b):
            if a >= 0 and b >= 0 and (s := self.scores.get(sym[a] + sym[b])) is not None:
                heapq.heappush(heap, (-s, a, b, sym[a], sym[b]))

        for i in range(len(sym) - 1):
            push(i, i + 1)
        while heap:
            _, a, b, x, y = heapq.heappop(heap)
            if sym[a] != x or sym[b] != y or nxt[a] != b:
                continue
            sym[a], sym[b] = x + y, None
            nxt[a] = nxt[b]
            if nxt[b] >= 0:
                prev[nxt[b]] = a
            push(prev[a], a)
            push(a, nxt[a])
        return [s for s in sym if s is not None]

    def viterbi(self, unit: str) -> list[str]:
        """Best sum of scores for a long unit; a character without a piece costs more than any piece."""
        low = min((s for _, _, s in self.pieces), default=0.0) - 10.0
        best: list[tuple[float, int]] = [(0.0, 0)]
        for e in range(1, len(unit) + 1):
            got = (best[e - 1][0] + self.scores.get(unit[e - 1], low), e - 1)
            for s in range(max(0, e - self.longest), e - 1):
                sc = self.scores.get(unit[s:e])
                if sc is not None and best[s][0] + sc > got[0]:
                    got = (best[s][0] + sc, s)
            best.append(got)
        out, e = [], len(unit)
        while e:
            out.append(unit[best[e][1]:e])
            e = best[e][1]
        return out[::-1]


class Pieces:
    """Ids of spans of an array of code points: pieces are found by a hash and then compared, character by character."""

    def __init__(self, ids: dict[str, int]):
        texts = list(ids)
        self.code = _code("".join(texts))
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size) - size
        h = self._hash(self.code)(begin, begin + size)
        by = np.argsort(h)
        # of two pieces with one hash the first is found; the other goes by its text
        self.h, self.begin, self.size = h[by], begin[by], size[by]
        self.ids = np.array(list(ids.values()), np.int64)[by]

    @staticmethod
    def _hash(code: np.ndarray) -> SpanHash:
        return SpanHash(code, _mixed(code, 0))

    def spell(self, vocab: Vocabulary, text: str, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the spans, which follow each other in ``text``, in a row, and how many each span has."""
        count = np.ones(len(start), np.int64)
        if not len(start):
            return count, count
        n = end - start
        found, ids = np.zeros(len(start), bool), np.zeros(len(start), np.int64)
        if len(self.h):
            h = self._hash(code)(start, end)
            at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            found = (self.h[at] == h) & (self.size[at] == n)
            each = np.flatnonzero(found)
            size = n[each]
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = code[np.repeat(start[each], size) + inside] == self.code[np.repeat(self.begin[at[each]], size) + inside]
            wrong = np.repeat(each, size)[~same]
            found[wrong] = False
            ids = self.ids[at]
        rest = np.flatnonzero(~found)
        if not len(rest):
            return ids, count
        spelled: dict[str, list[int]] = {}
        lists = []
        for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True):
            symbol = text[a:b]
            if symbol not in spelled:
                spelled[symbol] = vocab.piece_ids(symbol)
            lists.append(spelled[symbol])
        count[rest] = [len(x) for x in lists]
        own = np.repeat(~found, count)
        ids = np.repeat(ids, count)
        ids[own] = [i for x in lists for i in x]
        return ids, count


def _code(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


#: code points whose random words are kept in a table
TABLED = 1 << 14
SEEDS = (C1, np.uint64(0)), (C2, np.uint64(9))
WORDS = [mix((np.arange(TABLED, dtype=np.uint64) + np.uint64(1)) * c + d) for c, d in SEEDS]


def _mixed(code: np.ndarray, seed: int) -> np.ndarray:
    """A random word per code point."""
    out = WORDS[seed].take(code, mode="clip")
    far = np.flatnonzero(code >= TABLED)
    if len(far):
        c, d = SEEDS[seed]
        out[far] = mix((code[far].astype(np.uint64) + np.uint64(1)) * c + d)
    return out


def unit_ids(vocab: Vocabulary, words: list[str], masks: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units in a row, and how many each has; ``masks`` hold the cuts inside, 0 where the unit is split here."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    text = "".join(words)
    code = _code(text)
    begin = np.cumsum(size) - size
    cut = np.zeros(len(code), bool)
    cut[begin] = True
    bits = np.unpackbits(masks.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    unit, place = np.nonzero(bits)
    inside = place < size[unit]
    cut[begin[unit[inside]] + place[inside]] = True
    split = vocab.merge if kind == "bpe" else vocab.viterbi
    for k in np.flatnonzero((masks == 0) & (size > 1)).tolist():
        parts = split(words[k])
        cut[begin[k] + np.cumsum([0, *map(len, parts[:-1])])] = True
    start = np.flatnonzero(cut)
    ids, count = vocab.spans.spell(vocab, text, code, start, np.append(start[1:], len(code)))
    return ids.astype(np.int32), np.add.reduceat(count, np.searchsorted(start, begin)).astype(np.int32)


class Units:
    """Cuts texts into units and numbers the distinct ones by first sight."""

    def __init__(self, vocab: Vocabulary):
        self.cls, self.joined = vocab.joins
        self.number: dict[str, int] = {}
        # two hashes and the number of units seen, by the first hash: a unit is looked up as text once
        self.seen = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Unit numbers of the texts in a row, and how many each text has."""
        full = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        text = "".join(full)
        size = np.array([len(t) for t in full], np.int64)
        if not text:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        code = _code(text)
        number = self.number
        c = self.cls[code]
        cut = np.append(True, ~self.joined.take(c[:-1].astype(np.int64) * len(self.joined) + c[1:]))
        ends = np.cumsum(size)
        cut[(ends - size)[size > 0]] = True
        start = np.flatnonzero(cut)
        # equal units become one; only the distinct ones are hashed
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(code)) * 4), pa.py_buffer(code)]).dictionary_encode()
        inverse = coded.indices.to_numpy()
        _, offs, body = coded.dictionary.buffers()
        offs = np.frombuffer(offs, np.int64, len(coded.dictionary) + 1) // 4
        some = np.frombuffer(body, np.uint32, int(offs[-1]))
        words = some.tobytes().decode("utf-32-le", "surrogatepass")
        h, again = (SpanHash(some, _mixed(some, k))(offs[:-1], offs[1:]) for k in (0, 1))
        by = np.argsort(h)
        keys, check = h[by], again[by]
        seen, checks, numbers = self.seen
        at = np.searchsorted(seen, keys)
        known = np.append(seen, np.uint64(0))[at] == keys
        known[at == len(seen)] = False
        own = np.append(numbers, 0)[at]
        clash = (keys[1:] == keys[:-1]).any() or (checks[at[known]] != check[known]).any()
        new = np.arange(len(by)) if clash else np.flatnonzero(~known)       # two units with one hash: go by the texts
        which = by[new]
        own[new] = [number.setdefault(words[a:b], len(number)) for a, b in zip(offs[which].tolist(), offs[which + 1].tolist(), strict=True)]
        if not clash:
            self.seen = np.insert(seen, at[new], keys[new]), np.insert(checks, at[new], check[new]), np.insert(numbers, at[new], own[new])
        inverse = np.argsort(by)[inverse]
        return own[inverse], np.diff(np.searchsorted(start, np.append(0, ends)))


def _texts(rows: pa.Table):
    """Texts of a block in parts of about ``TEXTS`` bytes."""
    col = rows.column("text")
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy()
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXTS, side="right")))
        yield [t or "" for t in col.slice(at, to - at).to_pylist()]
        at = to


def _ask(vocab):
    def run(batches):
        for b in batches:
            for block, body in zip(b.column("block").to_pylist(), b.column("body"), strict=True):
                units = Units(vocab.value)
                for part in _texts(unpack_rows(body.as_py())):
                    units.cut(part)
                pa.default_memory_pool().release_unused()
                salt, low = block >> SALT_BIT, (block & (1 << SALT_BIT) - 1) << U_BITS
                words = list(units.number)      # in the order of their numbers
                for k in range(0, len(words), 100_000):
                    some = words[k:k + 100_000]
                    fits = np.fromiter((1 < len(w) <= LONGEST for w in some), bool, len(some))
                    u = np.flatnonzero(fits)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), salt)), pa.array(low | (u + k)), pa.array(some, pa.string()).filter(pa.array(fits))],
                        names=["salt", "ask", "unit"])

    return run


def lattice(units: DataFrame, vocab: Vocabulary, kind: str, keys: list[str], carry: list[str]) -> DataFrame:
    """``keys`` (unit first), ``carry`` and ``cuts`` (bit i: a symbol starts at character i) per row of ``units``.

    Rows that no piece fits are left out; so are units that a character without a piece breaks (unigram).
    ``carry`` goes with one substring of each row, which is too short for a piece, and a row's
    number leads the groups: the substrings of a row come one after the other, so that groups
    that are sorted find them in order.
    """
    spark = units.sparkSession
    own = [(p, i, s) for i, p, s in vocab.pieces if len(p) > 1 or kind == "unigram"]
    place = {s: k for k, s in enumerate(sorted({s for _, _, s in own}, reverse=True))}      # ranks fall with scores
    table_ = spark.createDataFrame([(*x, place[x[2]]) for x in own], "piece string, id int, score double, rank long")
    least = 1 if kind == "unigram" else 2
    n = F.length("unit")
    units = units.withColumn("__row", F.monotonically_increasing_id())
    starts = units.select("*", F.explode(F.sequence(F.lit(0), n - least)).alias("s"))
    shortest = F.when(F.col("s") == 0, least - 1).otherwise(least)
    sub = starts.select("*", F.explode(F.sequence(shortest, F.least(n - F.col("s"), F.lit(vocab.longest)))).alias("len"))
    short = F.col("len") < least
    sub = sub.select("__row", *keys, *[F.when(short, F.col(c)).alias(c) for c in carry], "s", (F.col("s") + F.col("len")).alias("e"),
                     F.when(~short, F.expr("substring(unit, s + 1, len)")).alias("piece"), short.alias("short"))
    edges = sub.join(F.broadcast(table_), "piece", "left").filter("short OR id IS NOT NULL")      # a vocabulary file: fixed size
    first = [F.first(c, ignorenulls=True).alias(c) for c in carry]
    if kind == "bpe":
        # an edge is one number: rank, start, end; as masks, its ends and what lies between them
        edge = F.expr("shiftleft(rank, 12) | shiftleft(s, 6) | e")
        grouped = edges.groupBy("__row", *keys).agg(F.sort_array(F.collect_list(F.when(~F.col("short"), edge))).alias("edges"), *first).filter("size(edges) > 0")
        masks = """transform(edges, x -> named_struct(
            'ends', shiftleft(1L, int(shiftright(x, 6) & 63)) | shiftleft(1L, int(x & 63)),
            'mid', shiftleft(1L, int(x & 63)) - shiftleft(2L, int(shiftright(x, 6) & 63))))"""
        # in order of rank and place; the second round takes what a later merge made possible
        fold = F.expr(f"""aggregate(flatten(array_repeat({masks}, 2)), shiftleft(2L, length(unit)) - 1,
            (c, x) -> IF((c & x.ends) = x.ends AND bit_count(c & x.mid) = 1, c & ~x.mid, c))""")
        return grouped.select(*keys, *carry, fold.alias("cuts"))
    edge = F.when(~F.col("short"), F.struct("e", "s", "score"))
    grouped = edges.groupBy("__row", *keys).agg(F.sort_array(F.collect_list(edge)).alias("edges"), *first).filter("size(edges) > 0")
    # Viterbi: best[e] is the best score of the first e characters and the cuts that give it; edges come by end
    fold = F.expr("""element_at(aggregate(edges,
        transform(sequence(0, length(unit)), i -> named_struct('score', IF(i = 0, 0D, NULL), 'cuts', 0L)),
        (best, x) -> IF(best[x.s].score IS NOT NULL AND (best[x.e].score IS NULL OR best[x.s].score + x.score > best[x.e].score),
            transform(best, (b, i) -> IF(i = x.e, named_struct('score', best[x.s].score + x.score, 'cuts', best[x.s].cuts | shiftleft(1L, x.s)), b)),
            best)), -1).cuts | shiftleft(1L, length(unit))""")
    return grouped.select(*keys, *carry, fold.alias("cuts"))


def _apply(vocab, kind, with_text):
    """Blocks (body, answers) -> ids per row, a part of the texts at a time."""
    def run(batches):
        v = vocab.value
        for b in batches:
            for body, answers in zip(b.column("body"), b.column("answers"), strict=True):
                yield from one(v, unpack_rows(body.as_py()), answers.values)

    def one(v, rows, answers):
        units = Units(v)
        parts = [(number.astype(np.int32), count.astype(np.int32)) for number, count in map(units.cut, _texts(rows))]
        names = rows.column("id")
        del rows
        cuts = np.zeros(len(units.number), np.int64)
        if answers is not None and len(answers):
            cuts[answers.field("u").to_numpy()] = answers.field("cuts").to_numpy()
        words = list(units.number)
        del units
        some = [unit_ids(v, words[k:k + UNITS], cuts[k:k + UNITS], kind) for k in range(0, len(words), UNITS)]
        del words, cuts
        ids, size = (np.concatenate(c) for c in zip((np.zeros(0, np.int32),) * 2, *some, strict=True))
        del some
        begin = np.cumsum(size, dtype=np.int64) - size
        at = 0
        parts.reverse()
        while parts:            # each part goes as its ids come
            number, count = parts.pop()
            n = size[number].astype(np.int64)
            place = np.repeat(begin[number] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(count)])]
            some = ids[place]
            cols = [names.slice(at, len(count)).combine_chunks(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(some, pa.int32()))]
            if with_text:
                cols.append(pa.array(v.speller.texts(some, ends), pa.string()))
            at += len(count)
            yield pa.RecordBatch.from_arrays(cols, names=["id", "ids", "text"][:len(cols)])
        pa.default_memory_pool().release_unused()

    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", kind: str = "bpe", with_text: bool = False) -> DataFrame:
    """id and ``ids`` (array of int) per row; ``with_text`` adds ``text``, decoded from the ids in the same task."""
    return encode_with(docs, Vocabulary.load(model), id_col, text_col, kind, with_text)


def encode_with(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str, kind: str, with_text: bool = False) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)       # the vocabulary file
    blocks = Blocks(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "text", BLOCK_BYTES)
    asks = blocks.table.select("block", "body").mapInArrow(_ask(shared), "salt long, ask long, unit string")
    # each unit once per salt, with the blocks that asked; no exchange between here and the fold
    distinct = asks.groupBy("unit", "salt").agg(F.collect_list("ask").alias("asked"))
    solved = lattice(distinct, vocab, kind, ["unit", "salt"], ["asked"])
    if kind != "bpe":       # merges always end; a filter would make the fold run twice
        solved = solved.filter("cuts IS NOT NULL")
    # a block's answers, at most one per distinct unit in it, meet it where its bucket is read
    block = F.shiftleft("salt", SALT_BIT).bitwiseOR(F.shiftright("a", U_BITS)).alias("block")
    answers = (solved.select("salt", "cuts", F.explode("asked").alias("a"))
               .select(block, F.col("a").bitwiseAND(F.lit((1 << U_BITS) - 1)).alias("u"), "cuts")
               .groupBy("block").agg(F.collect_list(F.struct("u", "cuts")).alias("answers")))
    both = blocks.table.select("block", "body").join(answers, "block", "left").select("body", "answers")
    out = both.mapInArrow(_apply(shared, kind, with_text), T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        *([T.StructField("text", T.StringType())] if with_text else [])]))
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """All columns and the text that the ids stand for; a column named ``to`` is replaced."""
    return decode_with(encoded, Vocabulary.load(model), ids_col, to)


class Speller:
    """Bytes of each id, and the texts that runs of ids stand for."""

    def __init__(self, vocab: Vocabulary):
        body = [b""] * vocab.size
        for i, p, _ in vocab.pieces:
            body[i] = p.replace(SPACE, " ").encode("utf-8", "surrogatepass")
        for k, i in enumerate(vocab.byte_ids or ()):
            body[i] = bytes([k])
        self.size = np.array([len(x) for x in body], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(body), np.uint8)

    def texts(self, ids: np.ndarray, ends: np.ndarray, some: int = 500) -> list[str]:
        """Texts of ``ids[ends[i]:ends[i + 1]]``, some at a time; the dummy space in front goes."""
        out = []
        for k in range(0, len(ends) - 1, some):
            cut = ends[k:k + some + 1]
            part = ids[cut[0]:cut[-1]]
            n = self.size[part]
            text = self.flat[np.repeat(self.begin[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()
            at = np.concatenate([[0], np.cumsum(n)])[cut - cut[0]].tolist()
            for a, b in zip(at, at[1:], strict=False):
                t = text[a:b].decode("utf-8", "replace")
                out.append(t[1:] if t.startswith(" ") else t)
        return out


def decode_with(encoded: DataFrame, vocab: Vocabulary, ids_col: str, to: str) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)      # the vocabulary file
    encoded = encoded.drop(to) if to != ids_col else encoded

    def run(batches):
        spell = shared.value.speller
        for b in batches:
            lists = b.column(ids_col)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            out = spell.texts(ids, np.concatenate([[0], np.cumsum(count, dtype=np.int64)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, to])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema, T.StructField(to, T.StringType())]))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = encode(table(spark, sf_dir, "documents"), model, with_text=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("text", 256).alias("text_sha256"))


QUERIES = {"op10_piece_codec": op10_piece_codec}
ORACLE = {}
