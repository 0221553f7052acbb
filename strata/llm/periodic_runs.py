"""Periodic run detection (operator 12): suffix automaton with link-cut access.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``max(6, 4 * q)`` long, that no neighbouring word extends.

Method, per stretch of words that can hold a run (see Gate):

1. A suffix automaton is built over the words. Its suffix links form a tree in
   which the path from the state of a prefix to the root holds the suffixes of
   that prefix.
2. Each state's colour is the end of its last occurrence. Appending word i
   recolours the path of prefix i. The tree is kept as preferred paths in splay
   trees (link-cut access): one path has one colour, so an access meets each
   last-occurrence segment once, amortised O(log n) of them per word.
3. A segment of colour j whose deepest state has length L says: the suffixes of
   prefix i up to length L last ended at j, and L is exactly how far words go on
   being equal to the left of i and j. If the distance q = i - j is within L,
   the last 2q words are a square; its root has no earlier copy in between, so
   it is primitive and q is the smallest period.
4. The square is extended to a run, to both sides over the whole text. A run is
   extended once: later squares of the same period inside it are skipped.

Gate. The automaton costs microseconds per word, and most words are in no run,
so stretches that cannot hold one are left out first, for many texts at once
with array operations. In a run of period q every three words from its word q on
have their previous copy at most q before, for at least max(3, 3q - 2) places in a row.
Places whose three words have no previous copy, or one further away than a third
of the stretch around them (rounded up), are struck until nothing changes. What
is left, with the words of one period before it, holds every run whole. The gate
strikes work, never runs: a test compares with and without it.

Each text is judged in the task that reads it (Arrow batches in pieces of some
MB): no shuffle, no join, so a hot source or copies cost nothing extra, and a
very long text costs its own length (n log n) in time and memory.

Defined results: null and empty texts have 0 words, no runs and an empty
collapsed text; repeated rows and ids are judged row by row; columns besides id
and text are ignored, whatever their name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table

LEAST = 6        # words of a run
REPEATS = 4      # periods of a run
PIECE_BYTES = 4 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of every state, and the state of every prefix."""
    step, link, longest, ends = [{}], [-1], [0], []
    last = 0
    for w in words:
        new = len(step)
        step.append({})
        longest.append(longest[last] + 1)
        at = last
        while at >= 0 and w not in step[at]:
            step[at][w] = new
            at = link[at]
        if at < 0:
            link.append(0)
        else:
            to = step[at][w]
            if longest[to] == longest[at] + 1:
                link.append(to)
            else:
                twin = len(step)
                link.append(twin)
                step.append(step[to].copy())
                longest.append(longest[at] + 1)
                link.append(link[to])
                link[to] = twin
                while at >= 0 and step[at].get(w) == to:
                    step[at][w] = twin
                    at = link[at]
        last = new
        ends.append(new)
    return link, longest, ends


class LastEnds:
    """The suffix-link tree as preferred paths; ``access`` recolours the path of a state to the root.

    Every splay tree is one preferred path, ordered by depth; its root carries
    the path's colour. ``up`` of a root points at the state above the path.
    """

    def __init__(self, link: list[int]):
        # state s is node s + 1; node 0 is "none"
        self.up = [0] + [p + 1 for p in link]
        self.less = [0] * (len(link) + 1)
        self.more = [0] * (len(link) + 1)
        self.colour = [-1] * (len(link) + 1)

    def _splay(self, x: int) -> None:
        up, less, more = self.up, self.less, self.more

        def rotate(x, p):
            g = up[p]
            if less[g] == p and g:
                less[g] = x
            elif more[g] == p and g:
                more[g] = x
            if less[p] == x:
                inner = more[x]
                less[p], more[x] = inner, p
            else:
                inner = less[x]
                more[p], less[x] = inner, p
            if inner:
                up[inner] = p
            up[p], up[x] = x, g

        top = x
        while (p := up[top]) and (less[p] == top or more[p] == top):
            top = p
        shade = self.colour[top]
        while (p := up[x]) and (less[p] == x or more[p] == x):
            g = up[p]
            if g and (less[g] == p or more[g] == p):
                if (less[g] == p) == (less[p] == x):
                    rotate(p, g)
                else:
                    rotate(x, p)
                    p = g
            rotate(x, p)
        self.colour[x] = shade

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """(old colour, deepest state) of every segment on the path, from the deepest; all get ``colour``."""
        out, below, x = [], 0, state + 1
        while x:
            self._splay(x)
            shade = self.colour[x]
            if shade >= 0:
                out.append((shade, x - 1))
            deeper = self.more[x]
            if deeper:
                self.colour[deeper] = shade      # the part below leaves the path with its colour
            self.more[x] = below
            if below:
                self.up[below] = x
            below, x = x, self.up[x]
        self.colour[below] = colour
        return out


def runs_between(words: np.ndarray, lo: int, hi: int) -> set[tuple[int, int, int]]:
    """Runs (start, length, period) that have a square within words lo to hi - 1; extended over all of ``words``."""
    link, longest, ends = suffix_automaton(words[lo:hi].tolist())
    tree = LastEnds(link)
    found, known, n = set(), {}, len(words)
    for i, state in enumerate(ends):
        for j, deepest in tree.access(state, i):
            q = i - j
            if longest[deepest] < q or known.get(q, -1) >= i:
                continue
            start = lo + j - longest[deepest] + 1
            while start > 0 and words[start - 1] == words[start - 1 + q]:
                start -= 1
            end = lo + i + 1
            while end < n and words[end] == words[end - q]:
                end += 1
            known[q] = end - 1 - lo
            if end - start >= max(LEAST, REPEATS * q):
                found.add((start, end - start, q))
    return found


def stretches(codes: np.ndarray, offs: np.ndarray) -> list[tuple[int, int]]:
    """Word stretches, none across texts, that hold every run whole. ``offs``: where each text starts, and the end."""
    n = len(codes)
    if n < LEAST:
        return []
    _, codes = np.unique(codes, return_inverse=True)
    pair = codes[:-1].astype(np.int64) * (int(codes.max()) + 1) + codes[1:]
    _, pair = np.unique(pair, return_inverse=True)
    three = pair[:-1].astype(np.int64) * (int(codes.max()) + 1) + codes[2:]
    first = np.repeat(offs[:-1], np.diff(offs))          # the text's first word, for every word
    last = np.repeat(offs[1:], np.diff(offs))
    at = np.arange(len(three))
    order = np.argsort(three, kind="stable")
    prev = np.full(len(three), -1)
    same = three[order[1:]] == three[order[:-1]]
    prev[order[1:][same]] = order[:-1][same]
    # within one text, and three words long
    at = at[(prev >= first[:-2]) & (at + 3 <= last[:-2])]
    gap = at - prev[at]
    for _ in range(8):      # more rounds would only strike more
        if not len(at):
            return []
        cut = np.flatnonzero((np.diff(at) > 1) | (first[at[1:]] != first[at[:-1]])) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
        size = end - begin
        near = np.repeat((size + 2) // 3, size)
        stay = (gap <= near) & np.repeat(size >= 3, size)
        if stay.all():
            break
        at, gap = at[stay], gap[stay]
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) > 1) | (first[at[1:]] != first[at[:-1]])) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
    lo = np.maximum(at[begin] - (end - begin + 2) // 3, first[at[begin]])
    hi = at[end - 1] + 3
    out = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_runs(codes: np.ndarray, offs: np.ndarray, gate: bool = True) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, by start, then period; ``codes`` are the words of all texts, one after another."""
    out = [set() for _ in range(len(offs) - 1)]
    whole = [(a, b) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True) if a < b]
    for lo, hi in stretches(codes, offs) if gate else whole:
        d = int(np.searchsorted(offs, lo, side="right")) - 1
        a, b = int(offs[d]), int(offs[d + 1])
        out[d] |= runs_between(codes[a:b], lo - a, hi - a)
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text starts (and the end)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(full)])
    offs = lists.offsets.to_numpy().astype(np.int64)
    return flat.filter(pa.array(full)), upto[offs - offs[0]]


def _piece(ids: pa.Array, texts: pa.Array, id_col: str) -> pa.RecordBatch:
    words, offs = _words(texts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    runs = find_runs(codes, offs)
    keep = np.ones(len(codes), bool)
    for d, found in enumerate(runs):
        for start, length, period in found:
            keep[offs[d] + start + period:offs[d] + start + length] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[offs]
    lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep)).cast(pa.string()))
    names = RUN.names
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(offs), pa.int64()),
         pa.array([[dict(zip(names, r, strict=True)) for r in found] for found in runs],
                  pa.list_(pa.struct([(n, pa.int64()) for n in names]))),
         pc.binary_join(lists, " ")], names=[id_col, "n_words", "runs", "collapsed"])


def _run_batches(id_col: str, text_col: str):
    def work(batches):
        for b in batches:
            texts = b.column(text_col)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            at = 0
            while at < b.num_rows:
                done = int(ends[at - 1]) if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
                yield _piece(b.column(id_col).slice(at, upto - at), texts.slice(at, upto - at), id_col)
                at = upto

    return work


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_words``, ``runs`` (start, length, period) and ``collapsed``: the text with one period of each run.

    ``collapsed`` keeps a word unless some run contains it after that run's
    first period; words are joined by one space.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(_run_batches(id_col, text_col), schema)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail in a tenth of the documents, chosen by the crc32 of the decimal id.

    A null id leaves the text alone, as does a text without words.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda x: x != "")

    def repeated(w):
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = F.floor((n - a) / (F.lit(3) + g % 8)).cast("long") + 1
        return F.array_join(F.transform(w, lambda _, i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # transform over a one-element array binds the words once
    damaged = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, damaged).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = periodic_runs(docs.select("doc_id", with_repeats(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("text")))
    # the greatest exact length / period; runs come by start, then period, so the first of equals stays
    best = F.expr("aggregate(runs, cast(null AS struct<start:bigint,length:bigint,period:bigint>), "
                  "(b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (d.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE = {}
