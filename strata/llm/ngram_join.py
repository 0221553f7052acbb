"""N-gram Jaccard join (operator 6): prefix filters under several global token orders.

Texts are sets of word shingles. Two sets link when ``100 * |x & y| >= percent * |x | y|``.
Texts with equal sets are one class, represented once.

*Orders.* Order 1 puts rare tokens first (a fixed-size bitmap of the tokens that
many texts have among their first ones; equal rarity by hash); orders 2 and 3 use
other hashes. Linked sets must share a token in their prefixes (length
``n - ceil(percent/100 n) + 1``) under *every* order: any global order gives an
exact filter, so candidates of order 1 are cut down by orders 2 and 3 before
verification. Size and position in the prefix filter pairs inside the join.

*Candidates.* (token, class) rows are range-partitioned and sorted; tokens of one
class only are dropped in the stream. Token groups of up to ``small`` classes
give their pairs, cut down by sizes, places in the prefix and the other orders. A
larger group gives one edge per class, to its leader (the class with the fewest rare
tokens), so no group's pairs are written out. Whatever links is then in one
component of these edges: a *cluster* of candidates.

*Verification.* Whole sets are fetched once per class and meet in their cluster. A
cluster of more than ``BLOCK`` classes is cut into overlapping bands of set size, a band
of more classes or tokens than a block holds into blocks by hash, and every two blocks
meet in a task of their own, so no task grows with a cluster. A task counts all
overlaps exactly, a range of tokens at a time, and puts out a spanning set of the links, not the pairs.
Classes that only common tokens tie together come here without the filters of sizes,
places and orders 2 and 3, and most of them have no link. So sketches of a large
cluster's sets meet first: counts of tokens by some bits of their hash, one counter
for about four tokens. Two sets share at most the sum of their lesser counts; the
components of the pairs that may link by that are the clusters whose sets then meet.

Defined results: null or empty texts and texts without words have an empty set and
link with nothing; texts with fewer words than a shingle are one shingle; repeated
rows are one class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import bitmaps
from strata.llm.blocks import bucketed
from strata.llm.common import LOWER_BYTES, lean, lean_group, release_shuffles, table, utf8
from strata.llm.components import components
from strata.llm.suffix_dedup import SpanHash, mix
from strata.session import stage

WORDS = 3
PERCENT = 90
#: token groups up to this many classes give their pairs
SMALL = 256
#: a token is common when more texts have it among their first ones
COMMON = 32
#: bits of the bitmaps that are broadcast (8 MB)
BITS = 1 << 26
TEXTS = 1000
#: and bytes of them (at least one text); the arrays over them are tens of times as large
TEXT_BYTES = 1 << 20
#: classes of a cluster that meet others in one task, and tokens of their sets
BLOCK = 512
BLOCK_TOKENS = 4 << 20
#: tokens that a task counts at a time
CHUNK_TOKENS = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ORDERS = [np.uint64(0), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)]


def token_sets(texts: pa.Array, words: int = WORDS):
    """(number, sorted distinct token hashes) of every text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    to = 0
    while to < len(texts):
        k, done = to, int(ends[to - 1]) if to else 0
        to = min(max(k + 1, int(np.searchsorted(ends, done + TEXT_BYTES, side="right"))), k + TEXTS)
        raw, offs = utf8(texts.slice(k, to - k))
        raw = LOWER_BYTES[raw]
        inside = np.empty(len(raw) + 2, bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = ~IS_SPACE[raw]
        # a word also ends where its text ends
        start = inside[1:-1] & ~inside[:-2]
        end = inside[1:-1] & ~inside[2:]
        full = offs[:-1] < offs[1:]
        first, last = offs[:-1][full], offs[1:][full] - 1
        start[first] = inside[1:-1][first]
        end[last] = inside[1:-1][last]
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        word = SpanHash(raw)(s, e)
        bound = np.searchsorted(s, offs)
        grams = word.copy()
        for j in range(1, words):
            m = len(word) - j
            if m > 0:
                grams[:m] = mix(grams[:m] * np.uint64(3) + word[j:] + np.uint64(j))
        for i in range(len(offs) - 1):
            a, b = int(bound[i]), int(bound[i + 1])
            if b - a >= words:
                yield k + i, np.unique(grams[a:b - words + 1])
            elif b > a:         # the whole sequence as one, marked with its length
                h = mix(word[a:a + 1] + np.uint64(b - a) * np.uint64(0x2545F4914F6CDD1D))
                for w in word[a + 1:b]:
                    h = mix(h * np.uint64(7) + w)
                yield k + i, h
            else:
                yield k + i, word[:0]


def class_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = int(np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D))))
    b = int(np.add.reduce(mix(tokens + np.uint64(0x14057B7EF767814F))))
    return tuple(int(np.uint64(x).view(np.int64)) for x in (a, b))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def order_key(tokens: np.ndarray, k: int) -> np.ndarray:
    return tokens if k == 0 else mix(tokens ^ ORDERS[k])


def _sets(id_col, text_col, words):
    def run(batches):
        for b in batches:
            n, keys = np.zeros(b.num_rows, np.int64), np.zeros((2, b.num_rows), np.int64)
            for i, t in token_sets(b.column(text_col), words):
                n[i] = len(t)
                keys[:, i] = class_key(t)
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(n), pa.array(keys[0]), pa.array(keys[1])],
                                             names=[id_col, "n", "c1", "c2"])

    return run


def _distinct_sets(batches, text_col, words):
    """Sets of a task, each once."""
    seen: set = set()
    for b in batches:
        for _, t in token_sets(b.column(text_col), words):
            if len(t) and (key := class_key(t)) not in seen:
                seen.add(key)
                yield key, t


def _blocks(rows, size=400_000):
    """Lists of (key, array) with about ``size`` values."""
    part, n = [], 0
    for r in rows:
        part.append(r)
        n += len(r[1])
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def _first_tokens(text_col, words, percent):
    """Tokens among the first of a set in hash order (half as many again as its prefix), counted per block."""

    def run(batches):
        rows = ((k, t[:prefix_length(len(t), percent) * 3 // 2]) for k, t in _distinct_sets(batches, text_col, words))
        for part in _blocks(rows):
            tok, n = np.unique(np.concatenate([t for _, t in part]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(n)], names=["t", "n"])

    return run


def _prefixes(text_col, words, percent, common):
    def run(batches):
        bits = common.value

        def rows():
            for key, t in _distinct_sets(batches, text_col, words):
                often = bitmaps.test(bits, t)
                rare = int(len(t) - often.sum())
                p = prefix_length(len(t), percent)
                pre = t[~often][:p]
                if len(pre) < p:
                    pre = np.concatenate([pre, t[often][:p - len(pre)]])
                yield (key, len(t), rare), pre

        for part in _blocks(rows(), 100_000):
            size = np.array([len(t) for _, t in part])
            rep = lambda v, size=size: pa.array(np.repeat(np.array(v, np.int64), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([t for _, t in part]).view(np.int64)),
                 rep([k[0][0] for k, _ in part]), rep([k[0][1] for k, _ in part]), rep([k[1] for k, _ in part]),
                 pa.array(np.concatenate([np.arange(s) for s in size])), rep([k[2] for k, _ in part])],
                names=["t", "c1", "c2", "n", "pos", "rare"])

    return run


def _drop_single(batches):
    """Drop tokens that one class has, and repeats of a (token, class); a partition's first and last tokens stay."""
    held, before = None, None
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        t, c1, c2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("t", "c1", "c2"))
        again = np.append(False, (t[1:] == t[:-1]) & (c1[1:] == c1[:-1]) & (c2[1:] == c2[:-1]))
        if again.any():
            b = b.filter(pa.array(~again))
            t = t[~again]
        same = t[1:] == t[:-1]
        keep = np.append(before is None or t[0] == before, same) | np.append(same, True)
        if len(t) > 1:
            yield b.slice(0, len(t) - 1).filter(pa.array(keep[:-1]))
            before = t[-2]
        held = b.slice(len(t) - 1)
    if held is not None:
        yield held


def _fetch(text_col, words, percent, wanted):
    """Whole sets of the wanted rows (by the hash of their id), with their prefixes under orders 2 and 3."""

    def run(batches):
        bits = wanted.value

        def rows():
            for b in batches:
                b = b.filter(pa.array(bitmaps.test(bits, b.column("id_hash").to_numpy(zero_copy_only=False))))
                yield from _distinct_sets([b], text_col, words)

        kind, half = pa.list_(pa.int64()), pa.list_(pa.int32())
        for part in _blocks(rows(), 200_000):
            other = [[], []]
            for _, t in part:
                p = prefix_length(len(t), percent)
                for j in (1, 2):
                    o = order_key(t, j)
                    # half of each hash: a chance match costs a verification, nothing else
                    other[j - 1].append(((np.partition(o, p - 1)[:p] if p < len(o) else o) >> np.uint64(16)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part], pa.int64()), pa.array([k[1] for k, _ in part], pa.int64()),
                 pa.array(other[0], half), pa.array(other[1], half), pa.array([t.view(np.int64) for _, t in part], kind)],
                names=["c1", "c2", "p2", "p3", "tokens"])

    return run


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest member of each set's component, by the links among ``sets`` (sorted as unsigned numbers)."""
    n = len(sets)
    sets = [t.view(np.uint64) for t in sets]
    size = np.array([len(t) for t in sets], np.int64)
    overlap = np.zeros((n, n), np.float32)
    # tokens are hashes, so equal ranges of them hold about equally many
    parts = max(1, -(-int(size.sum()) // CHUNK_TOKENS))
    cuts = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    edges = np.stack([np.concatenate([[0], np.searchsorted(t, cuts), [len(t)]]) for t in sets]).astype(np.int64)
    for k in range(parts):
        some = [t[e[k]:e[k + 1]] for t, e in zip(sets, edges, strict=True)]
        owner = np.repeat(np.arange(n), edges[:, k + 1] - edges[:, k])
        _, token, count = np.unique(np.concatenate(some), return_inverse=True, return_counts=True)
        shared = count[token] > 1                       # a token of one set overlaps with nothing
        owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
        by = np.argsort(token, kind="stable")
        owner, token = owner[by], token[by]
        for lo in range(0, int(token.max(initial=-1)) + 1, 2048):
            a, b = np.searchsorted(token, [lo, lo + 2048])
            held = np.zeros((n, 2048), np.float32)
            held[owner[a:b], token[a:b] - lo] = 1
            overlap += held @ held.T
    overlap = overlap.astype(np.int64)
    link = 100 * overlap >= percent * (size[:, None] + size[None, :] - overlap)
    np.fill_diagonal(link, True)
    return spanning(link)


def spanning(link: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component, by a symmetric matrix of links (its diagonal set)."""
    n = len(link)
    label = np.arange(n)
    while True:
        low = np.where(link, label[None, :], n).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def sketch_size(cell: int, percent: int) -> int:
    """Counters for the sets of a cell: one for about four tokens, a power of two."""
    return 1 << max(3, int(np.log2(max(1.0, (100 / percent) ** cell / 4))))


def sketch(tokens: np.ndarray, size: int) -> np.ndarray:
    """How many of the tokens have each rest modulo ``size`` (a power of two)."""
    return np.bincount((tokens.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint32)


def _sketch(percent: int):
    """Rows with a set and its cell -> rows with the set's sketch."""

    def run(batches):
        for b in batches:
            lists = b.column("tokens")
            flat, size = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            cells = b.column("cell").to_pylist()
            made = [sketch(flat[e - n:e], sketch_size(c, percent)) for e, n, c in zip(ends.tolist(), size.tolist(), cells, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("task", "b", "o", "cluster", "c1", "c2", "n")], pa.array([m.tobytes() for m in made], pa.binary())],
                names=["task", "b", "o", "cluster", "c1", "c2", "n", "sketch"])

    return run


def possible(sketches: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link: they share at most the sum of the lesser counts."""
    n = len(size)
    link = np.eye(n, dtype=bool)
    for i in range(n - 1):
        most = np.minimum(sketches[i], sketches[i + 1:]).sum(axis=1, dtype=np.int64)
        link[i, i + 1:] = 100 * most >= percent * (size[i] + size[i + 1:] - most)
    return link | link.T


def _may_link(percent: int):
    """A spanning set of the possible links among the rows of each cell in a task."""

    def run(tab: pa.Table) -> pa.Table:
        code = tab.column("cluster").to_numpy()
        by = np.argsort(code, kind="stable")
        c1, c2, size = (tab.column(c).to_numpy() for c in ("c1", "c2", "n"))
        body = tab.column("sketch").to_pylist()
        a, b = [], []
        for rows in np.split(by, np.flatnonzero(np.diff(code[by])) + 1):
            _, first = np.unique(np.stack([c1[rows], c2[rows]]), axis=1, return_index=True)
            rows = rows[first]
            if len(rows) > 1:
                label = spanning(possible(np.stack([np.frombuffer(body[r], np.uint32) for r in rows.tolist()]), size[rows], percent))
                own = np.flatnonzero(label != np.arange(len(rows)))
                a.append(rows[own])
                b.append(rows[label[own]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.table({"x1": pa.array(c1[a]), "x2": pa.array(c2[a]), "y1": pa.array(c1[b]), "y2": pa.array(c2[b])})

    return run


def _meetings(sized: DataFrame, percent: int, by_tokens: bool) -> DataFrame:
    """Where classes (c1, c2, n, cluster, whole) meet: task, b, o and, as ``cluster``, their cell; with cell and n.

    A cluster larger than a block is cut by size first: sets of sizes more than one
    band apart cannot link. Small cells share tasks; of a large one, every two blocks meet in a task.
    """
    band = F.floor(F.ln("n") / -F.ln(F.lit(percent / 100))).cast("long")
    cell = F.when(F.col("whole") <= BLOCK, F.array(F.lit(-2).cast("long"))).otherwise(F.array(band, band - 1))
    cells, n_cells = stage(sized.select("c1", "c2", "n", "cluster", F.explode(cell).alias("cell")), "ngram-cells")
    most = F.expr(f"div(held + {BLOCK - 1}, {BLOCK})")
    shards = max(1, n_cells // BLOCK)
    if by_tokens:
        most = F.greatest(most, F.expr(f"div(tokens + {BLOCK_TOKENS - 1}, {BLOCK_TOKENS})"))
        shards = max(shards, int(cells.agg(F.sum("n")).first()[0] or 0) // BLOCK_TOKENS)
    blocks = (cells.groupBy("cluster", "cell").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("tokens")).filter("held > 1")
              .withColumn("blocks", most).drop("tokens"))
    return (cells.join(blocks, ["cluster", "cell"])
            .withColumn("own", F.xxhash64("cluster", "cell"))
            .withColumn("b", F.pmod(F.xxhash64("c1", "c2", F.lit(6)), F.col("blocks")))
            .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("c1", "c2", "n", "cell", F.col("own").alias("cluster"),
                    F.when(F.col("blocks") == 1, F.pmod("own", F.lit(shards))).otherwise(F.col("own")).alias("task"),
                    F.when(F.col("blocks") == 1, F.lit(-1).cast("long")).otherwise(F.least("b", "o")).alias("b"), F.greatest("b", "o").alias("o")))


def _verify(percent: int):
    """A spanning set of the links among the rows of each cluster in a task."""

    def run(tab: pa.Table) -> pa.Table:
        code = tab.column("cluster").to_numpy()
        by = np.argsort(code, kind="stable")
        lists = tab.column("tokens").combine_chunks()
        flat, offs = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        c1, c2 = tab.column("c1").to_numpy(), tab.column("c2").to_numpy()
        a, b = [], []
        for rows in np.split(by, np.flatnonzero(np.diff(code[by])) + 1):
            # a class that was fetched twice counts once
            _, first = np.unique(np.stack([c1[rows], c2[rows]]), axis=1, return_index=True)
            rows = rows[first]
            if len(rows) > 1:
                label = linked([flat[offs[r]:offs[r + 1]] for r in rows.tolist()], percent)
                own = np.flatnonzero(label != np.arange(len(rows)))
                a.append(rows[own])
                b.append(rows[label[own]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.table({"x1": pa.array(c1[a]), "x2": pa.array(c2[a]), "y1": pa.array(c1[b]), "y2": pa.array(c2[b])})

    return run


def _fits(percent: int):
    """Sizes and prefix places allow the overlap that a link needs (sets ``l`` and ``r``)."""
    need = F.expr(f"div({percent} * (l.n + r.n) + {99 + percent}, {100 + percent})")
    return ((F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent)
            & (F.least(F.expr("l.n - l.pos"), F.expr("r.n - r.pos")) >= need))


LINK = "x1 long, x2 long, y1 long, y2 long"
PAIR = ["l.c1 AS x1", "l.c2 AS x2", "r.c1 AS y1", "r.c2 AS y2"]


def _other_orders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (x1, x2, y1, y2) that share a token in the prefixes of orders 2 and 3 too."""
    for s in ("x", "y"):
        side = sets.select("c1", "c2", F.col("p2").alias(f"{s}_p2"), F.col("p3").alias(f"{s}_p3"))
        pairs = pairs.withColumns({"c1": F.col(f"{s}1"), "c2": F.col(f"{s}2")}).join(side, ["c1", "c2"]).drop("c1", "c2")
    return (pairs.filter(F.arrays_overlap("x_p2", "y_p2") & F.arrays_overlap("x_p3", "y_p3"))
            .select("x1", "x2", "y1", "y2").distinct())


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                   percent: int = PERCENT, small: int = SMALL, common_from: int = COMMON, bits: int = BITS) -> DataFrame:
    """id, ``n_shingles`` and ``component_id`` (smallest id reachable by links) per row."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    docs = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    texts = docs.select(F.col(f"`{text_col}`"))
    named = docs.select(F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"), F.col(f"`{text_col}`"))
    rows, _ = stage(docs.mapInArrow(lean(_sets(id_col, text_col, words)), T.StructType([
        docs.schema[id_col], *[T.StructField(c, T.LongType()) for c in ("n", "c1", "c2")]])), "ngram-rows")

    counts = texts.mapInArrow(lean(_first_tokens(text_col, words, percent)), "t long, n long")
    common = share(bitmaps.build(counts.groupBy("t").agg(F.sum("n").alias("n")).filter(F.col("n") > common_from), "t", bits))
    order = ["t", "c1", "c2"]
    cols = "t long, c1 long, c2 long, n long, pos long, rare long"
    cand, _ = stage(texts.mapInArrow(lean(_prefixes(text_col, words, percent, common)), cols)
                    .repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_drop_single, cols)
                    .dropDuplicates(["t", "c1", "c2"]), "ngram-prefixes")

    groups = (cand.groupBy("t").agg(F.count(F.lit(1)).alias("g"), F.min(F.struct("rare", "c1", "c2")).alias("lead"))
              .filter("g > 1"))
    members, _ = stage(cand.join(groups, "t"), "ngram-groups")
    release_shuffles(spark)
    few = members.filter(F.col("g") <= small).select("t", "c1", "c2", "n", "pos")
    many = members.filter(F.col("g") > small)
    apart = F.expr("l.c1 < r.c1 OR (l.c1 = r.c1 AND l.c2 < r.c2)")
    close = few.alias("l").join(few.alias("r"), (F.col("l.t") == F.col("r.t")) & apart & _fits(percent)).selectExpr(*PAIR)
    pairs, _ = stage(close.distinct(), "ngram-pairs")
    star = many.filter("c1 != lead.c1 OR c2 != lead.c2").selectExpr("c1 AS x1", "c2 AS x2", "lead.c1 AS y1", "lead.c2 AS y2").distinct()
    star, n_star = stage(star, "ngram-star")
    release_shuffles(spark)

    classes, _ = stage(rows.filter("n > 0").groupBy("c1", "c2").agg(F.min(id_col).alias("doc"), F.first("n").alias("n")), "ngram-classes")
    both = pairs.unionByName(star)
    wanted = both.selectExpr("x1 AS c1", "x2 AS c2").union(both.selectExpr("y1 AS c1", "y2 AS c2")).distinct()
    bitmap = share(bitmaps.build(classes.join(wanted, ["c1", "c2"]).select(F.xxhash64("doc").alias("h")), "h", bits))
    # the sets are the bulk of the work: bucketed, they are written once; dealt before, since the driver could not
    # hold a file for every task and bucket
    sets = (named.mapInArrow(lean(_fetch(text_col, words, percent, bitmap)), "c1 long, c2 long, p2 array<int>, p3 array<int>, tokens array<long>")
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c1", "c2"))
    sets = bucketed(sets, "c1", "c2")
    release_shuffles(spark)

    # clusters of candidates: components of the pairs that pass every order, and of the stars
    edges = _other_orders(pairs, sets).unionByName(star).select(F.struct("x1", "x2").alias("x"), F.struct("y1", "y2").alias("y"))
    edges = edges.selectExpr("named_struct('c1', x.x1, 'c2', x.x2) AS x", "named_struct('c1', y.y1, 'c2', y.y2) AS y")
    members, _ = stage(components(edges).select("node.c1", "node.c2", F.xxhash64("root").alias("cluster")), "ngram-clusters")
    release_shuffles(spark)
    # of a large cluster, most classes have no link: count sketches, a few bytes for every token, show which may
    sized = members.join(classes.select("c1", "c2", "n"), ["c1", "c2"])
    whole = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("whole"))
    large = sized.join(whole.filter(F.col("whole") > BLOCK), "cluster")
    sketched = (_meetings(large, percent, by_tokens=False).join(sets.select("c1", "c2", "tokens"), ["c1", "c2"])
                .select("task", "b", "o", "cluster", "c1", "c2", "cell", "n", "tokens")
                .mapInArrow(lean(_sketch(percent)), "task long, b long, o long, cluster long, c1 long, c2 long, n long, sketch binary"))
    may, n_may = stage(sketched.groupBy("task", "b", "o").applyInArrow(lean_group(_may_link(percent)), LINK), "ngram-may-link")
    left = sized.join(whole.filter(F.col("whole") <= BLOCK).select("cluster"), "cluster").select("c1", "c2", "n", "cluster")
    if n_may:
        again = components(may.selectExpr("named_struct('c1', x1, 'c2', x2) AS x", "named_struct('c1', y1, 'c2', y2) AS y"))
        left = left.unionByName(again.select("node.c1", "node.c2", F.xxhash64("root").alias("cluster"))
                                .join(classes.select("c1", "c2", "n"), ["c1", "c2"]))
    left, _ = stage(left, "ngram-left")
    release_shuffles(spark)
    met = _meetings(left.join(left.groupBy("cluster").agg(F.count(F.lit(1)).alias("whole")), "cluster"), percent, by_tokens=True)
    links, n_links = stage(met.join(sets.select("c1", "c2", "tokens"), ["c1", "c2"]).groupBy("task", "b", "o")
                           .applyInArrow(lean_group(_verify(percent)), LINK), "ngram-links")
    node = classes.select("c1", "c2", F.struct(F.col("doc").isNull().alias("none"), "doc", "c1", "c2").alias("node"))    # no id: last
    labels = node.select("c1", "c2", F.col("node.doc").alias("component"))
    if n_links:
        side = lambda s: node.select(F.col("c1").alias(f"{s}1"), F.col("c2").alias(f"{s}2"), F.col("node").alias(s))
        linked_nodes = links.join(side("x"), ["x1", "x2"]).join(side("y"), ["y1", "y2"]).select("x", "y")
        roots = components(linked_nodes).select("node.c1", "node.c2", "root")
        labels = node.join(roots, ["c1", "c2"], "left").select("c1", "c2", F.coalesce("root", "node")["doc"].alias("component"))
    labels, _ = stage(labels, "ngram-labels")
    return (rows.join(labels, ["c1", "c2"], "left")
            .select(F.col(f"`{id_col}`"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col(f"`{id_col}`")).alias("component_id")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op6_ngram_join": op6_ngram_join}
ORACLE = {}
