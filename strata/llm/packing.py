"""Packing (operator 2): best-fit decreasing over token counts.

1. Each task turns texts into token ids (cut at ``window`` ids: full windows and
   one rest), and numbers its pieces within each length.
2. Only a histogram (at most ``window`` lengths) reaches the driver. Best-fit
   decreasing runs on it: a segment tree indexed by remaining capacity finds the
   tightest open window for the next length, and all windows of one capacity take
   a length together. A capacity halves whenever windows are filled further
   (remaining < length <= remaining before), and each length splits at most two
   groups and opens at most two, so the plan has at most
   ``4 * window * log2(window)`` steps however many documents there are
   (about 200,000 for 4096; that is the proven bound of what is broadcast).
3. A piece's number within its length (its task's offset + its number in the
   task) tells its step, window and offset by binary search.

The result is that of best-fit decreasing over all pieces at once; nothing
is packed per partition. The only shuffle moves task x length counts.

Defined results: a null text is the empty text (its only id is the end id);
repeated rows are packed row by row; texts of any length are cut; an empty table
gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import lean, table
from strata.session import stage

WINDOW = 4096
END_ID = 2
#: words kept in a task's cache of encoded words (two generations of this size at most)
CACHE_WORDS = 400_000
#: characters of texts that are cut into words at once
TOGETHER = 1 << 23


class WordTokenizer:
    """Ids of a word-level BPE tokenizer file, with encoded words kept between texts.

    The file's own splitter cuts a text into words that are encoded one by one,
    so a word's ids do not depend on its neighbours. Texts in plain Latin letters
    (where lower-casing and composition act letter by letter) are cut here by the
    same rules, many texts at once: words become numbers of the distinct ones, only
    these are looked up, and ids are gathered by number. Any other text goes to the
    library whole.
    """

    PLAIN = re.compile("[\t\n\r -~¡-¬®-įĲ-ſ]*")
    CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # little-endian uint32 ids of a word, as bytes: joining many of them is one pass
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        merge, rest = self.tok.model.tokenize, []
        for w in words:
            if w.isascii():     # visible ASCII stands for itself in the file's alphabet: only its merges are left to do
                self.new[w] = array("I", [t.id for t in merge(w)]).tobytes()
            else:
                rest.append(w)
        for k in range(0, len(rest), 2000):         # many per call
            some = rest[k:k + 2000]
            enc = self.tok.encode(" ".join(some), add_special_tokens=False)
            ids, at = np.array(enc.ids, "<u4").tobytes(), enc.word_ids
            if at and at[-1] == len(some) - 1:
                cut = (4 * np.searchsorted(np.array(at), np.arange(len(some) + 1))).tolist()
                self.new.update(zip(some, map(ids.__getitem__, map(slice, cut, cut[1:])), strict=False))
            else:               # a word that the splitter cuts further when neighbours change
                for w in some:
                    self.new[w] = np.array(self.tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def forget(self) -> None:
        """Let the words go."""
        self.new, self.old = {}, {}

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        new, old = self.new, self.old
        got = list(map(new.get, words))
        missing = [w for w, g in zip(words, got, strict=True) if g is None]
        if missing:
            again = [w for w in missing if w in old]
            new.update(zip(again, map(old.__getitem__, again), strict=True))
            if len(missing) > len(again):
                self._learn([w for w in missing if w not in old])
            got = list(map(new.__getitem__, words))
        if len(new) > CACHE_WORDS:
            self.old, self.new = new, {}
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        held, size = [], 0
        for i, t in enumerate(texts):
            if "<|" in t or not self.PLAIN.fullmatch(t):
                out[i] = np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32)
                continue
            held.append(i)
            size += len(t)
            if size >= TOGETHER:
                self._plain(texts, held, out)
                held, size = [], 0
        if held:
            self._plain(texts, held, out)
        return out

    def _plain(self, texts: list[str], which: list[int], out: list) -> None:
        """Ids of the plain texts ``which``, put into ``out``."""
        parts = [texts[i].lower().encode() for i in which]
        begin = np.cumsum([0, *(len(p) + 1 for p in parts)])
        raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        start, solid = word_starts(raw)
        first = np.searchsorted(np.flatnonzero(start), begin).tolist()      # each text's first word
        packed, start = raw[solid], start[solid]
        edge = np.append(np.flatnonzero(start), len(packed)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(edge) - 1, pa.py_buffer(edge), pa.py_buffer(packed)).dictionary_encode()
        del raw, solid, start, packed, edge, parts
        ids = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        number = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        begin = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ids), "<u4")
        del ids, coded
        for k in range(0, len(which), 32):
            some, cut = which[k:k + 32], first[k:k + 33]
            own = number[cut[0]:cut[-1]]
            n = sizes[own]
            ends = np.cumsum(n)
            # a word's ids lie together in ``flat``: their places count on from the first
            got = flat[np.repeat(begin[own] - ends + n, n) + np.arange(int(n.sum()))]
            at = np.append(0, ends)[np.array(cut) - cut[0]].tolist()
            for i, x, y in zip(some, at, at[1:], strict=False):
                out[i] = got[x:y]


def word_starts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in lower-cased plain texts (UTF-8 bytes), and what is not white space.

    A word is a contraction (an apostrophe that no sign stands before, and its letters), a
    run of letters, one digit or a run of other signs; white space lies between words.
    """
    kind = KIND[raw]
    # characters of two bytes: both get the kind of the character
    two = np.flatnonzero(raw >= 0xC2)
    kind[two] = KIND_OF_TWO[(raw[two].astype(np.int64) & 7) << 6 | raw[two + 1] & 0x3F]
    kind[two + 1] = kind[two]
    start = np.append(True, kind[1:] != kind[:-1])[:len(raw)]
    quote = np.flatnonzero((raw == 0x27) & start)
    start |= kind == DIGIT
    start[two + 1] = False
    solid = kind != SPACE
    start &= solid
    if len(quote):
        rest = np.append(raw, np.zeros(2, np.uint8))
        after = [rest[quote + 1], rest[quote + 2]]
        length = np.zeros(len(quote), np.int64)
        for tail in WordTokenizer.CONTRACTIONS:
            fits = after[0] == tail[0]
            if len(tail) > 1:
                fits &= after[1] == tail[1]
            length[fits] = len(tail)
        own = length > 0
        quote, length = quote[own], length[own]
        start[quote + 1] = False
        end = quote + 1 + length
        inside = end < len(raw)
        # what follows it is a word of its own, unless white space follows
        start[end[inside]] |= solid[end[inside]]
    return start, solid


SPACE, LETTER, DIGIT, SIGN = range(4)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of one-byte characters, and of two-byte ones by the low bits of both bytes."""

    def kind(c: str) -> int:
        if c in "\t\n\r ":
            return SPACE
        if re.match("[a-zªµºß-öø-ſ]", c):
            return LETTER
        return DIGIT if re.match("[0-9²³¹¼-¾]", c) else SIGN

    one = np.full(256, SIGN, np.uint8)
    one[:128] = [kind(chr(c)) for c in range(128)]
    two = np.full(512, SIGN, np.uint8)
    for c in range(0x80, 0x180):
        a, b = chr(c).encode()
        two[(a & 7) << 6 | b & 0x3F] = kind(chr(c))
    return one, two


KIND, KIND_OF_TWO = _kinds()


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker."""
    return WordTokenizer(path)


class FitTree:
    """Segment tree over remaining capacities 0..n: the smallest capacity >= need that has open windows."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, i: int, value: bool) -> None:
        i += self.size
        while i and self.open[i] != value:
            self.open[i] = value
            i >>= 1
            if i:
                value = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int:
        """Smallest open capacity >= need, or -1."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Best-fit decreasing for ``counts`` pieces of each length.

    Rows (length, first number, end number, first window, pieces per window, offset):
    pieces ``first..end-1`` of a length fill windows from ``first window`` on, ``per
    window`` each, the first of each at ``offset``.
    """
    tree = FitTree(window)
    room: list[deque] = [deque() for _ in range(window + 1)]    # by remaining capacity: [first, end) of window numbers
    steps = []
    opened = 0

    def put(left: int, first: int, end: int) -> None:
        if end > first and left:
            if room[left] and room[left][-1][1] == first:
                room[left][-1] = (room[left][-1][0], end)
            else:
                room[left].append((first, end))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        todo, number = counts[length], 0
        while todo:
            left = tree.tightest(length)
            if left < 0:
                left, first, end = window, opened, opened + -(-todo // (window // length))
                opened = end
            else:
                first, end = room[left].popleft()
                if not room[left]:
                    tree.set(left, False)
            per = left // length
            full = min(end - first, todo // per)
            if full:
                steps.append((length, number, number + full * per, first, per, window - left))
                put(left - per * length, first, first + full)
                number += full * per
                todo -= full * per
                first += full
            if todo and first < end:        # fewer pieces than one more window could take
                steps.append((length, number, number + todo, first, per, window - left))
                put(left - todo * length, first, first + 1)
                number += todo
                todo, first = 0, first + 1
            if first < end:                 # untouched windows of the group
                room[left].appendleft((first, end))
                tree.set(left, True)
    return np.array(steps, np.int64).reshape(-1, 6)


PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``window`` ids: id, start, length, doc_tokens and ``ids`` (little-endian uint32)."""

    def cut(tok, batches):
        end = np.array([end_id], np.uint32)
        for b in batches:
            ids_col, texts = b.column(id_col), b.column(text_col)
            # some MB of text at a time, at least one row
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = [0]
            while cuts[-1] < b.num_rows:
                done = int(ends[cuts[-1] - 1]) if cuts[-1] else 0
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + TOGETHER, side="right"))))
            for k, to in zip(cuts, cuts[1:], strict=False):
                rows, start, length, total, blobs = [], [], [], [], []
                for i, ids in enumerate(tok.encode([t or "" for t in texts.slice(k, to - k).to_pylist()])):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for s in range(0, len(ids), window):
                        part = ids[s:s + window]
                        rows.append(k + i)
                        start.append(s)
                        length.append(len(part))
                        total.append(len(ids))
                        blobs.append(part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids_col.take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(total, pa.int64()), pa.array(blobs, pa.binary())],
                    names=[id_col, "start", "length", "doc_tokens", "ids"])

    def run(batches):
        tok = word_tokenizer(tokenizer)
        try:
            yield from cut(tok, batches)
        finally:        # other steps run in this worker after pack; its words would take their memory
            tok.forget()

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        lean(run), T.StructType([docs.schema[id_col], *PIECE]))


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` column (columns of these names are replaced); other columns pass through."""
    pieces = pieces.drop("sequence_id", "offset")

    def number(batches):
        seen = np.zeros(window + 1, np.int64)
        pid = TaskContext.get().partitionId()
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            order = np.argsort(length, kind="stable")
            sorted_len = length[order]
            first = np.flatnonzero(np.append(True, sorted_len[1:] != sorted_len[:-1])) if len(length) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(length)))
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(first, count) + seen[sorted_len]
            seen[sorted_len[first]] += count
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(length), pid, np.int32)), pa.array(rank)],
                names=[*b.schema.names, "__part", "__rank"])

    numbered, _ = stage(pieces.mapInArrow(number, T.StructType([
        *pieces.schema, T.StructField("__part", T.IntegerType()), T.StructField("__rank", T.LongType())])), "packing")
    per_task = numbered.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("__n"))
    # at most one row per length: the window size bounds what the driver sees
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    plan = best_fit_plan(counts, window)
    # a length has one row per task; the window sums over tasks, not over pieces
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    ranked = numbered.join(offsets, ["__part", "length"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast(plan)         # at most 4 * window * log2(window) rows
    names = pieces.columns

    def assign(batches):
        steps = shared.value
        # rows are by falling length, rising number: one key that sorts like the plan
        span = int(steps[:, 2].max()) + 1 if len(steps) else 1
        keys = (window - steps[:, 0]) * span + steps[:, 1]
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("__rank").to_numpy(zero_copy_only=False)
            s = steps[np.searchsorted(keys, (window - length) * span + rank, side="right") - 1]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(s[:, 3] + k // s[:, 4]),
                 pa.array(s[:, 5] + (k % s[:, 4]) * length)],
                names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(assign, T.StructType([
        *pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, **kw) -> DataFrame:
    """Pieces with their ids, sequence and offset."""
    return place(token_pieces(docs, tokenizer, window=window, **kw), window)


def place_digests(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces with the digest of their ids instead of them, sequence and offset."""
    # the digest is taken before the pieces are staged, so ids are not stored; staged before they are
    # numbered, or each task would hold a worker for either step
    digests, _ = stage(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "packing-pieces")
    return place(digests, window)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Materialised sequences: ids of a window in order, padded unless the length is a power of two.

    Every group holds at most ``window`` ids.
    """
    body = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(F.col("__parts"), F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    n = F.col("length")
    power = F.bitwise_not(n - 1).bitwiseAND(n) == n
    zero = F.lit(int(pad_id).to_bytes(4, "little"))
    return (packed.groupBy("sequence_id").agg(body.alias("__parts"), F.sum("length").alias("length"))
            .select("sequence_id", "length",
                    F.when(power, ids).otherwise(F.concat(ids, F.aggregate(
                        F.sequence(F.lit(1), F.greatest(F.lit(window) - n, F.lit(1))), F.lit(b""),
                        lambda a, _: F.concat(a, zero)))).alias("ids")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return place_digests(pieces)


QUERIES = {"op2_packing": op2_packing}
ORACLE = {}
