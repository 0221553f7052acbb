"""Removal of repeated byte strings (operator 8): threshold-bounded interval expansion on a BWT.

Every byte covered by a ``min_len``-byte string that also starts elsewhere goes.

1. *Shards that keep equal strings together.* Of every ``min_len``-byte string,
   the smallest hash among its ``seed``-byte substrings is its anchor, so equal
   strings share their anchor at the same place. A text has about one anchor per
   ``(min_len - seed) / 2`` bytes. An anchor's *window* holds all strings that
   could have it. Anchors that occur once hold no repeat and are dropped while
   they stream past their neighbours in a sort by anchor. Hot anchors, found in a
   sample of the texts, are dealt over all tasks by window and place instead and
   kept whole; the sample decides where rows go, not which.
2. Equal windows are one class (anchor, window hash). A class of two or more is
   repeated as a whole. Anchors with several classes need a closer look.
3. *BWT.* One window of each such class goes to a shard (anchors are hashed to
   shards of about ``shard_bytes``). The shard's windows are put behind each
   other, sorted as rotations up to ``min_len`` and turned into a BWT. Intervals
   of the empty string are extended backwards, breadth first: at level L every
   new right border gets common prefix L. After level ``min_len - 1`` the borders
   not reached have a common prefix of ``min_len`` or more: equal strings.
   Strings of one text position that come from overlapping windows do not count.
4. An anchor with more than ``hot_windows`` different windows is not put into one
   shard: its strings are grouped by (anchor, place of the anchor in the string,
   hash), first in runs of eight strings with a common core, which is exact too.

Spans go back to their texts by the row's key (a hash of id and text).

Defined results: null text is empty; texts shorter than ``min_len`` lose nothing;
repeated rows are documents of their own, so each is a repeat of the other;
matches never cross texts; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import lean, release_shuffles, table, utf8
from strata.session import owned_scratch, scratch_dir, stage

MIN_LEN = 200
SEED = 64
#: bytes of a shard; its arrays should fit a processor cache
SHARD_BYTES = 1 << 18
HOT_WINDOWS = 4096
SEGMENT = 1 << 20
#: one text in this many is looked at for anchors that fill a task
SAMPLED = 64

C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: one random word per byte value, and an odd base with its inverse, for hashes of spans
BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * C1
    return (x ^ (x >> np.uint64(32))) * C2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (block prefix and suffix minima)."""
    n = len(x)
    pad = -n % w
    b = np.append(x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, w)
    fore = np.minimum.accumulate(b, axis=1).ravel()
    back = np.minimum.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], fore[w - 1:n])


#: powers of the base and of its inverse that a worker keeps (16 bytes each)
KEPT_POWERS = 3 << 19
_KEPT: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (at least)."""
    if _KEPT and len(_KEPT[0][0]) >= n:
        return _KEPT[0]
    out = []
    for base in (BASE, INVERSE):
        p = np.full(max(n, 1), base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p, out=p))
    if n <= KEPT_POWERS:
        _KEPT[:] = [tuple(out)]
    return tuple(out)


class SpanHash:
    """64-bit hashes of arbitrary spans of a byte array (or of an array with ``values`` as its hashes)."""

    def __init__(self, raw: np.ndarray, values: np.ndarray | None = None):
        n = len(raw)
        values = BYTE[raw] if values is None else values
        power, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h ^ ((end - start).astype(np.uint64) * C3))


def anchors(raw: np.ndarray, offs: np.ndarray, min_len: int, seed: int):
    """Anchors of all texts of a buffer, segment by segment (memory does not grow with a text).

    Yields (text number, place in the text, bytes before it in the window, window length,
    anchor hash, window hash).
    """
    n = len(raw)
    w = min_len - seed + 1
    last = -1
    for s in range(0, max(n - min_len + 1, 0), SEGMENT):
        e = min(s + SEGMENT, n - min_len + 1)              # string starts s..e-1
        lo, hi = max(0, s - min_len), min(n, e + 2 * min_len)
        part = np.ascontiguousarray(raw[lo:hi])
        span = SpanHash(part)
        at = np.arange(s, e + w - 1)                       # seeds that these strings hold
        hashes = span(at - lo, at - lo + seed)
        key = (hashes & np.uint64(0xFFFFFFFF00000000)) | (at - s).astype(np.uint64)
        least = sliding_min(key, w)
        ok = np.ones(e - s, bool)
        d0 = max(int(np.searchsorted(offs, s, side="right")) - 1, 0)
        d1 = int(np.searchsorted(offs, e, side="left"))
        for a, b in zip(offs[d0:d1].tolist(), offs[d0 + 1:d1 + 1].tolist(), strict=True):
            ok[max(a, b - min_len + 1, s) - s:max(min(b, e) - s, 0)] = False
        p = (least[ok] & np.uint64(0xFFFFFFFF)).astype(np.int64) + s
        if len(p):
            p = p[np.append(True, p[1:] != p[:-1])]
            p = p[p > last]
        if not len(p):
            continue
        last = int(p[-1])
        d = np.searchsorted(offs, p, side="right") - 1
        begin = np.maximum(offs[d], p - (min_len - seed))
        end = np.minimum(offs[d + 1], p + min_len)
        yield d, p - offs[d], p - begin, end - begin, mix(hashes[p - s]), span(begin - lo, end - lo)


def rotation_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all rotations of ``x`` in order of their first ``depth`` symbols (or more), ties by start.

    Prefix doubling. A sort key and the start that it belongs to are packed into one
    number where they fit, so that numbers are sorted instead of places. Only rotations
    that still equal a neighbour are looked at again.
    """
    n = len(x)
    bits = max(n - 1, 1).bit_length()
    wide = max(int(x.max(initial=0)), 1).bit_length()
    packed = 3 * bits <= 63

    def sort(key, idx):
        """``idx`` and ``key`` in order of key, then idx."""
        if packed:
            both = key << bits
            both |= idx
            both.sort()
            return both & ((1 << bits) - 1), both >> bits
        by = np.lexsort((idx, key))
        return idx[by], key[by]

    h = max(1, (63 - bits if packed else 62) // wide)
    ext = np.concatenate([x, np.resize(x, h)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= wide
        key |= ext[j:j + n]
    order, key = sort(key, np.arange(n))
    rank = np.empty(n, np.int64)
    idx, at = order, np.arange(n)       # rotations that are not alone in their place yet, and their places
    while True:
        new = np.append(True, key[1:] != key[:-1])
        group = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[idx] = group
        if h >= depth:
            return order
        left = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(left):
            return order
        idx, at = idx[left], at[left]
        after = np.append(rank, np.resize(rank, h))[idx + h] if h < n else rank[(idx + h) % n]
        idx, key = sort(group[left] << bits | after, idx)
        order[at] = idx
        h *= 2


def expand_intervals(bwt: np.ndarray, min_len: int) -> np.ndarray:
    """Borders between neighbours of the rotation order whose common prefix is shorter than ``min_len``.

    Breadth-first backward extension: the intervals of level L are the strings of
    length L whose right border was new. Prepending a symbol c to an interval maps its
    ends by the number of c before them; a right border reached for the first time
    at level L has common prefix L.
    """
    n = len(bwt)
    # numbers of 32 bits where (symbol, place) fits
    num = np.int32 if (int(bwt.max(initial=0)) + 1) * n < 1 << 31 else np.int64
    occ = np.argsort(bwt, kind="stable").astype(num)
    front = bwt[occ]                                       # first symbol of each rotation
    step = np.empty(n, num)                                # a rotation's place after one symbol is prepended
    step[occ] = np.arange(n, dtype=num)
    keys = front.astype(num) * num(n) + occ                # (symbol, place), sorted: rank queries by binary search
    symbols = np.unique(bwt).astype(num)
    last = np.flatnonzero(np.append(bwt[1:] != bwt[:-1], True))[:n] + 1
    alike = np.repeat(last, np.diff(last, prepend=0)).astype(num)   # where the run of equal symbols ends
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    lo, hi = np.array([0], num), np.array([n], num)
    for _ in range(min_len):
        if not len(lo):
            break
        # an interval before which one symbol stands moves as it is; of the others, wide ones try every
        # symbol, the rest the symbols that they hold
        same = alike[lo] >= hi
        to = step[lo[same]]
        a, b = [to], [to + (hi[same] - lo[same])]
        mixed = np.flatnonzero(~same)
        if len(mixed):
            lo, hi = lo[mixed], hi[mixed]
            width = hi - lo
            wide = width > 4 * len(symbols)
            if wide.any():
                c = np.tile(symbols, int(wide.sum())) * num(n)
                a.append(np.searchsorted(keys, c + np.repeat(lo[wide], len(symbols))).astype(num))
                b.append(np.searchsorted(keys, c + np.repeat(hi[wide], len(symbols))).astype(num))
                lo, width = lo[~wide], width[~wide]
            if len(lo):
                owner = np.repeat(np.arange(len(width)), width)
                place = np.arange(len(owner)) + np.repeat(lo - np.cumsum(width) + width, width)
                moved = owner * n + step[place]
                moved.sort()
                moved -= owner * n                      # owners stand as before
                byte = front[moved]
                first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])))
                a.append(moved[first].astype(num))
                b.append((moved[np.append(first[1:], len(moved)) - 1] + 1).astype(num))
        lo, hi = np.concatenate(a), np.concatenate(b)
        fresh = (hi > lo) & ~border[hi]
        lo, hi = lo[fresh], hi[fresh]
        border[hi] = True
    return border


def repeated_starts(windows: list[bytes], origin: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Where in the windows strings start that also start at another origin: (window number, place).

    ``origin`` is the place of each window's first byte as one number (text number
    and position); windows of one text may overlap.
    """
    sizes = np.array([len(w) for w in windows], np.int64)
    x = np.frombuffer(b"\xff".join(windows) + b"\xff", np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(windows)), sizes + 1)
    place = np.arange(len(x)) - begin[owner]
    valid = place + min_len <= sizes[owner]
    order = rotation_order(x, min_len)
    border = expand_intervals(x[order - 1], min_len)
    first = np.flatnonzero(border[:-1])
    where = (origin[owner] + place)[order]
    fits = valid[order]
    low = np.minimum.reduceat(np.where(fits, where, np.iinfo(np.int64).max), first)
    high = np.maximum.reduceat(np.where(fits, where, -1), first)
    twice = np.repeat((high > low) & (high >= 0), np.diff(np.append(first, len(x))))
    hit = np.sort(order[twice & fits])
    return owner[hit], place[hit]


def merge_spans(owner: np.ndarray, start: np.ndarray, length: int):
    """Runs covered by [start, start + length) within each owner; both arrays sorted. (owner, start, end)."""
    if not len(owner):
        return owner, start, start
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + length))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], start[last] + length


SPANS = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
SPANS_ARROW = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _spans_of(n: int, owner, start, end) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(n)]
    for o, s, e in zip(owner.tolist(), start.tolist(), end.tolist(), strict=True):
        out[o].append({"s": s, "e": e})
    return out


def _shard(min_len: int):
    def run(tab: pa.Table) -> pa.Table:
        # one row per window class (a repeated row may have been fetched twice)
        seen, keep = set(), []
        for i, k in enumerate(zip(tab.column("a").to_pylist(), tab.column("h").to_pylist(), strict=True)):
            if k not in seen:
                seen.add(k)
                keep.append(i)
        tab = tab.take(pa.array(keep))
        texts = tab.column("k1").to_numpy() ^ tab.column("k2").to_numpy()
        code = np.unique(texts, return_inverse=True)[1].astype(np.int64)
        origin = (code << 40) + tab.column("from").to_numpy()
        owner, place = repeated_starts(tab.column("bytes").to_pylist(), origin, min_len)
        found = _spans_of(tab.num_rows, *merge_spans(owner, place, min_len))
        return pa.table({"a": tab.column("a"), "h": tab.column("h"), "spans": pa.array(found, SPANS_ARROW)})

    return run


def _hot_cores(min_len: int, step: int):
    """Runs of ``step`` strings by the place of their anchor, each with its common core's hash."""

    def run(batches):
        for b in batches:
            out = [[], [], [], []]
            before = b.column("l").to_numpy(zero_copy_only=False)
            raw, offs = utf8(b.column("bytes"))
            span = SpanHash(raw)
            size = np.diff(offs)
            for g in range(0, int(before.max(initial=-1)) + 1, step):
                # strings that start g .. g+step-1 bytes before the anchor; the core starts g before it
                core = before - g
                ok = (core >= 0) & (core + min_len - step + 1 <= size)
                i = np.flatnonzero(ok)
                at = offs[i] + core[i]
                out[0].append(i)
                out[1].append(np.full(len(i), g))
                out[2].append(span(at, at + min_len - step + 1).view(np.int64))
            i = pa.array(np.concatenate(out[0]) if out[0] else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(i), b.column("h").take(i), pa.array(np.concatenate(out[1]) if out[1] else [], pa.int32()),
                 pa.array(np.concatenate(out[2]) if out[2] else [], pa.int64())], names=["a", "h", "g", "core"])

    return run


def _hot_strings(min_len: int, step: int):
    """Each string of the runs that are left: its start in the window and its hash."""

    def run(batches):
        for b in batches:
            before = b.column("l").to_numpy(zero_copy_only=False)
            g = b.column("g").to_numpy(zero_copy_only=False)
            raw, offs = utf8(b.column("bytes"))
            span = SpanHash(raw)
            size = np.diff(offs)
            rows, starts, hashes = [], [], []
            for r in range(step):
                s = before - g - r
                i = np.flatnonzero((s >= 0) & (s + min_len <= size))
                rows.append(i)
                starts.append(s[i])
                hashes.append(span(offs[i] + s[i], offs[i] + s[i] + min_len).view(np.int64))
            i = np.concatenate(rows)
            starts = np.concatenate(starts)
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(pa.array(i)), b.column("h").take(pa.array(i)),
                 pa.array(starts, pa.int32()), pa.array((before[i] - starts), pa.int32()),
                 pa.array(np.concatenate(hashes), pa.int64())], names=["a", "h", "s", "r", "string"])

    return run


def _hot_spans(windows: DataFrame, min_len: int, step: int = 8) -> DataFrame:
    """Spans of the windows of hot anchors, by grouping strings instead of a shard."""
    cores = windows.select("a", "h", "l", "bytes").mapInArrow(
        _hot_cores(min_len, step), "a long, h long, g int, core long")
    shared = cores.groupBy("a", "g", "core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "g", "core")
    left = cores.join(shared, ["a", "g", "core"]).select("a", "h", "g")
    strings = (windows.select("a", "h", "l", "bytes").join(left, ["a", "h"])
               .mapInArrow(_hot_strings(min_len, step), "a long, h long, s int, r int, string long"))
    twice = strings.groupBy("a", "r", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "r", "string")
    return (strings.join(twice, ["a", "r", "string"]).groupBy("a", "h")
            .agg(F.collect_list(F.struct("s", (F.col("s") + min_len).alias("e"))).alias("spans")))


def repeated_spans(keyed: DataFrame, min_len: int = MIN_LEN, seed: int = SEED,
                   shard_bytes: int = SHARD_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Repeated spans of texts: ``k1, k2`` and ``spans`` (unmerged), for rows (k1, k2, text)."""

    def find(batches):
        for b in batches:
            raw, offs = utf8(b.column("text"))
            k1, k2 = b.column("k1"), b.column("k2")
            for d, p, before, size, a, h in anchors(raw, offs, min_len, seed):
                d = pa.array(d)
                yield pa.RecordBatch.from_arrays(
                    [k1.take(d), k2.take(d), pa.array(p), pa.array(before.astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(a.view(np.int64)), pa.array(h.view(np.int64))], names=["k1", "k2", "p", "l", "n", "a", "h"])

    def drop_single(batches):
        """Rows whose anchor equals a neighbour's, and all rows of hot anchors; a partition's first and last rows stay."""
        held, before = None, None       # the last row so far, not put out yet; the anchor before it

        def flags(a, prev, nxt):
            left = np.append(prev is None or a[0] == prev, a[1:] == a[:-1])
            right = np.append(a[1:] == a[:-1], nxt is None or a[-1] == nxt)
            return left | right

        def put(b, keep):
            return b.filter(pa.array(keep | b.column("hot").to_numpy(zero_copy_only=False))).drop_columns(["hot"])

        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            a = b.column("a").to_numpy(zero_copy_only=False)
            if len(a) > 1:
                yield put(b.slice(0, len(a) - 1), flags(a[:-1], before, a[-1]))
                before = a[-2]
            held = b.slice(len(a) - 1)
        if held is not None:
            yield held.drop_columns(["hot"])

    def only_anchors(batches):
        for b in find(batches):
            yield b.select(["a"])

    spark, schema = keyed.sparkSession, "k1 long, k2 long, p long, l int, n int, a long, h long"
    texts = keyed.filter(F.octet_length("text") >= min_len)
    # anchors that would fill a good part of a task, seen in one text of SAMPLED: their rows are dealt by
    # window and place, since none of them occurs once; all others meet under their anchor
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen, total = stage(texts.filter(F.pmod("k1", F.lit(SAMPLED)) == 0).mapInArrow(lean(only_anchors), "a long"), "suffix-sample")
    often = (seen.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(8, total // (4 * parts)))
             .select("a", F.lit(True).alias("hot")))      # at most 4 rows per partition
    rows = (texts.mapInArrow(lean(find), schema).join(F.broadcast(often), "a", "left")
            .select("k1", "k2", "p", "l", "n", "a", "h", F.coalesce("hot", F.lit(False)).alias("hot")))
    dealt = F.when(F.col("hot"), F.xxhash64("a", "h", "k1", "p")).otherwise(F.col("a"))
    cand, _ = stage(rows.repartition(dealt).sortWithinPartitions("a", "h")
                    .mapInArrow(drop_single, schema), "suffix-anchors")
    release_shuffles(spark)
    classes = cand.groupBy("a", "h").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("k1", "k2", "p", "l", "n")).alias("rep"))
    kinds = classes.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("all")).filter("all > 1")
    mixed, _ = stage(classes.join(kinds.filter("kinds > 1"), "a")
                     .select("a", "h", "c", "kinds", "rep.*"), "suffix-mixed")

    # one window's bytes per class, cut from the text that holds it
    need = (mixed.groupBy("k1", "k2")
            .agg(F.collect_list(F.struct("a", "h", "c", "kinds", "p", "l", "n")).alias("need")))

    def cut(batches):
        for b in batches:
            raw, offs = utf8(b.column("text"))
            lists = b.column("need")
            item = lists.flatten()
            d = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            f = {k: item.field(k) for k in ("a", "h", "c", "kinds", "p", "l", "n")}
            start = f["p"].to_numpy() - f["l"].to_numpy()
            at = offs[d] + start
            buf = raw.tobytes()
            got = [buf[i:i + m] for i, m in zip(at.tolist(), f["n"].to_pylist(), strict=True)]
            take = pa.array(d)
            yield pa.RecordBatch.from_arrays(
                [f["a"], f["h"], f["c"], f["kinds"], b.column("k1").take(take), b.column("k2").take(take),
                 pa.array(start), f["l"], pa.array(got, pa.binary())],
                names=["a", "h", "c", "kinds", "k1", "k2", "from", "l", "bytes"])

    windows, _ = stage(keyed.join(need, ["k1", "k2"]).mapInArrow(
        lean(cut), "a long, h long, c long, kinds long, k1 long, k2 long, from long, l int, bytes binary"), "suffix-windows", compression="zstd")
    release_shuffles(spark)
    cool, hot = windows.filter(F.col("kinds") <= hot_windows), windows.filter(F.col("kinds") > hot_windows)
    total = cool.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    from_bwt = (cool.withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards)))
                .groupBy("shard").applyInArrow(_shard(min_len), T.StructType([
                    T.StructField("a", T.LongType()), T.StructField("h", T.LongType()), T.StructField("spans", SPANS)])))
    found = from_bwt
    if not hot.isEmpty():
        found = found.unionByName(_hot_spans(hot.dropDuplicates(["a", "h"]), min_len))
    closer, _ = stage(found.filter(F.size("spans") > 0), "suffix-spans")
    release_shuffles(spark)

    # back to every place: whole windows for classes of two or more, else what the closer look found
    whole = classes.join(kinds, "a").filter("c > 1").select("a", "h", F.lit(True).alias("whole"))
    per_class = whole.join(closer, ["a", "h"], "full")
    begin = F.col("p") - F.col("l")
    spans = F.when(F.col("whole"), F.array(F.struct(begin.alias("s"), (begin + F.col("n")).alias("e")))).otherwise(
        F.transform("spans", lambda x: F.struct((begin + x["s"]).alias("s"), (begin + x["e"]).alias("e"))))
    places = cand.join(per_class, ["a", "h"]).select("k1", "k2", spans.alias("spans"))
    return (places.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """All columns of ``docs`` with ``__spans`` (maximal removed runs, bytes), ``__n_bytes`` and ``__kept`` (bytes left).

    Columns of these names are replaced.
    """
    docs = docs.drop("__spans", "__n_bytes", "__kept")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    keys = [F.xxhash64(F.lit(1), ident, text).alias("k1"), F.xxhash64(F.lit(2), text, ident).alias("k2")]
    spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "suffix-repeats")
    with owned_scratch(spark):      # anchors and windows go once the spans are written
        repeated_spans(docs.select(*keys, text.alias("text")), **kw).write.option("compression", "zstd").parquet(path)
    release_shuffles(spark)
    spans = spark.read.parquet(path)
    names = docs.columns
    body = docs.select(*keys, *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)])
    at = f"__c{names.index(text_col)}"
    joined = body.join(spans, ["k1", "k2"], "left").drop("k1", "k2")

    def cut(batches):
        for b in batches:
            raw, offs = utf8(b.column(at))
            lists = b.column("spans")
            out, kept, size = [], [], np.diff(offs)
            buf = raw.tobytes()
            for i, got in enumerate(lists.to_pylist()):
                text = buf[offs[i]:offs[i + 1]]
                runs: list[list[int]] = []
                for x in sorted((x["s"], x["e"]) for x in got or ()):
                    if runs and x[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], x[1])
                    else:
                        runs.append([*x])
                out.append([{"s": s, "e": e} for s, e in runs])
                if runs:
                    edge = [0, *(y for r in runs for y in r), len(text)]
                    text = b"".join(text[edge[j]:edge[j + 1]] for j in range(0, len(edge), 2))
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f"__c{i}") for i in range(len(names))],
                 pa.array(out, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(size), pa.array(kept, pa.binary())],
                names=[*[f"__c{i}" for i in range(len(names))], "__spans", "__n_bytes", "__kept"])

    schema = T.StructType([*[T.StructField(f"__c{i}", f.dataType) for i, f in enumerate(docs.schema)],
                           T.StructField("__spans", T.ArrayType(T.StructType([
                               T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))),
                           T.StructField("__n_bytes", T.LongType()), T.StructField("__kept", T.BinaryType())])
    return joined.mapInArrow(lean(cut), schema).select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)], "__spans", "__n_bytes", "__kept")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"),
        F.aggregate("__spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]).alias("n_removed"),
        F.size("__spans").cast("long").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))


QUERIES = {"op8_suffix_dedup": op8_suffix_dedup}
ORACLE = {}
