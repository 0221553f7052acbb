"""Approximate nearest neighbours (operator 5): robust-pruned directed graphs, one per shard.

Vectors are spread over shards of about ``shard_rows`` by hash. Per shard a
graph is grown in batches: greedy searches propose neighbours, from the nearest of
some pivots (the medoid and nodes far from each other, so that no dense group of
vectors is cut off),
relaxed distance pruning (factor ``alpha``) keeps diverse edges, reverse edges are
pruned back to the degree bound. Every query is searched in every shard by beam
search, and the shards' nearest are merged. The index covers every row.

Equal vectors are one node: a group of copies as large as a third of the table
costs one node, and only its ``k + 1`` smallest ids can ever be among the k nearest
(ties go to the smaller id), so only those are kept, by a group limit that Spark
applies before the shuffle. Queries come in blocks of about 32 MB; a shard meets
one block per task, so neither side of a task grows with the input, and the index
is shuffled once per block, not once per few thousand queries. The search keeps at
least as many nodes as a vector has components, since long vectors lie at more
equal distances.

Scores of what is found are computed in double precision on the original vectors.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components are neither indexed nor searched; vectors only meet vectors of their
own length; rows that repeat an id are rows of their own, except that a query
never finds its own id; with fewer than k candidates all are returned (up to
what the beam, at least ``4 k`` wide, reaches).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.session import stage

SHARD_ROWS = 4096
#: bytes of query vectors (doubles) in a block: an index is copied once per block
BLOCK_BYTES = 32 << 20
DEGREE, BEAM, ALPHA = 28, 56, 1.2
SEARCH_BEAM = 96
BATCH = 256
#: nodes spread over a shard, of which a search starts from the nearest few
PIVOTS, STARTS = 256, 8


def pivots(x: np.ndarray, entry: int) -> np.ndarray:
    """Nodes far from each other (farthest first, from ``entry``), so that every dense group has one near."""
    out, near = [entry], 2 - 2 * (x @ x[entry])
    while len(out) < min(PIVOTS, len(x)):
        p = int(near.argmax())
        if near[p] <= 1e-6:
            break
        out.append(p)
        near = np.minimum(near, 2 - 2 * (x @ x[p]))
    return np.array(out)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int | np.ndarray, q: np.ndarray, beam: int):
    """Nearest nodes that greedy search meets: ids and squared distances (rows x beam, by distance; -1 pads).

    The search starts from the nearest of the entry nodes.
    """
    entry = np.atleast_1d(entry)
    rows = np.arange(len(q))
    ids = np.full((len(q), beam), -1, np.int64)
    dist = np.full((len(q), beam), np.inf, np.float32)
    done = np.ones((len(q), beam), bool)
    start = (2 - 2 * (q @ x[entry].T)).astype(np.float32)
    few = np.argsort(start, axis=1, kind="stable")[:, :min(STARTS, beam)]
    ids[:, :few.shape[1]], dist[:, :few.shape[1]], done[:, :few.shape[1]] = entry[few], np.take_along_axis(start, few, 1), False
    seen = np.zeros((len(q), len(x)), bool)
    seen[rows[:, None], entry[few]] = True
    while True:
        open_dist = np.where(done, np.inf, dist)
        pick = open_dist.argmin(axis=1)
        live = np.isfinite(open_dist[rows, pick])
        if not live.any():
            return ids, dist
        r = rows[live]
        done[r, pick[live]] = True
        near = graph[ids[r, pick[live]]]
        bad = near < 0
        near = np.where(bad, 0, near)
        bad |= seen[r[:, None], near]
        seen[r[:, None], near] |= ~bad
        d = 2 - 2 * np.einsum("brd,bd->br", x[near], q[r])
        d[bad] = np.inf
        all_ids = np.concatenate([ids[r], near], axis=1)
        all_dist = np.concatenate([dist[r], d.astype(np.float32)], axis=1)
        all_done = np.concatenate([done[r], bad], axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[r] = np.take_along_axis(all_ids, best, 1)
        dist[r] = np.take_along_axis(all_dist, best, 1)
        done[r] = np.take_along_axis(all_done, best, 1) | ~np.isfinite(dist[r])
        ids[r] = np.where(np.isfinite(dist[r]), ids[r], -1)


def robust_prune(x: np.ndarray, p: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse out-neighbours of nodes ``p`` from candidates (rows x any; -1 pads)."""
    rows = np.arange(len(p))
    own = x[p]
    safe = np.where(cand < 0, 0, cand)
    d = 2 - 2 * np.einsum("bkd,bd->bk", x[safe], own)
    d[(cand < 0) | (cand == p[:, None])] = np.inf
    by = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(safe, by, 1), np.take_along_axis(d, by, 1)
    same = np.zeros_like(d, bool)                  # a candidate that is listed twice
    same[:, 1:] = cand[:, 1:] == cand[:, :-1]
    d[same] = np.inf
    vec = x[cand]
    out = np.full((len(p), degree), -1, np.int64)
    alive = np.isfinite(d)
    for k in range(degree):
        pick = alive.argmax(axis=1)
        live = alive[rows, pick]
        if not live.any():
            break
        out[live, k] = cand[rows, pick][live]
        to = 2 - 2 * np.einsum("bkd,bd->bk", vec, vec[rows, pick])
        alive &= ~(live[:, None] & (alpha * alpha * np.maximum(to, 0) <= d))
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 3):
    """Graph (rows x degree; -1 pads) and entry node for unit vectors."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    entry = int((x @ x.mean(axis=0)).argmax()) if n else 0
    order = np.random.default_rng(seed).permutation(n)
    spread = pivots(x, entry) if n else order
    order = np.concatenate([spread, order[~np.isin(order, spread)]])
    at = 1
    while at < n:
        p = order[at:at + min(BATCH, max(8, at // 2))]
        found, _ = beam_search(x, graph, spread[:at], x[p], beam)
        at += len(p)
        # the batch's own members may be neighbours too while the graph is small
        if len(p) and at <= 4 * BATCH:
            found = np.concatenate([found, np.tile(p, (len(p), 1))], axis=1)
        graph[p] = robust_prune(x, p, found, degree, alpha)
        src = np.repeat(p, degree)
        dst = graph[p].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        if not len(dst):
            continue
        first = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
        count = np.diff(np.append(first, len(dst)))
        slot = np.arange(len(dst)) - np.repeat(first, count)
        new = np.full((len(first), int(count.max())), -1, np.int64)
        new[np.repeat(np.arange(len(first)), count), slot] = src
        target = dst[first]
        for k in range(0, len(target), BATCH):
            t = target[k:k + BATCH]
            both = np.concatenate([graph[t], new[k:k + BATCH]], axis=1)
            room = (both >= 0).sum(axis=1) <= degree
            if room.any():          # no pruning needed: pack to the left
                b = both[room]
                graph[t[room]] = np.take_along_axis(b, np.argsort(b < 0, axis=1, kind="stable"), 1)[:, :degree]
            if (~room).any():
                graph[t[~room]] = robust_prune(x, t[~room], both[~room], degree, alpha)
    return graph, entry


def _matrix(col, dtype) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values.reshape(len(flat), -1), dtype)


def _unit(v: np.ndarray) -> np.ndarray:
    # scaled first, so that very large or small components neither overflow nor vanish
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def _build(tab: pa.Table) -> pa.Table:
    x = _unit(_matrix(tab.column("vec"), np.float64))
    graph, entry = build_graph(x)
    keep = [row[row >= 0].astype(np.int32) for row in graph]
    start = np.isin(np.arange(tab.num_rows), pivots(x, entry))
    return pa.table({"shard": tab.column("shard"), "node": pa.array(np.arange(tab.num_rows, dtype=np.int32)),
                     "vec_id": tab.column("vec_id"), "k1": tab.column("k1"), "k2": tab.column("k2"), "vec": tab.column("vec"),
                     "edges": pa.array(keep, pa.list_(pa.int32())), "entry": pa.array(start)})


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def beam_for(dims: int, beam: int, k: int) -> int:
    """Nodes that a search keeps: distances of long vectors differ less, so the beam grows with their length."""
    return max(beam, dims, 4 * k)


def _search(k: int, beam: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "score": pa.float64(), "rep": pa.int64()}
        if not index.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], t) for c, t in names.items()})
        index = index.take(pa.array(np.argsort(index.column("node").to_numpy())))
        full = _matrix(index.column("vec"), np.float64)
        x = _unit(full)
        lists = index.column("edges").to_pylist()
        graph = np.full((len(x), max(1, max(len(e) for e in lists))), -1, np.int64)
        for i, e in enumerate(lists):
            graph[i, :len(e)] = e
        entry = np.flatnonzero(index.column("entry").to_numpy())
        ids = index.column("vec_id").to_numpy()
        q = _matrix(queries.column("vec"), np.float64)
        qid = queries.column("query_id").to_numpy()
        cols = [[], [], []]
        for s in range(0, len(q), BATCH):
            part = q[s:s + BATCH]
            found, _ = beam_search(x, graph, entry, _unit(part), beam_for(x.shape[1], beam, k))
            score = cosine(full[np.maximum(found, 0)], part[:, None, :])
            score[found < 0] = -np.inf
            rep = ids[np.maximum(found, 0)]
            by = np.lexsort((rep, -score), axis=1)[:, :k + 1]
            found, score = np.take_along_axis(found, by, 1), np.take_along_axis(score, by, 1)
            ok = found >= 0
            cols[0].append(np.repeat(qid[s:s + BATCH], ok.sum(axis=1)))
            cols[1].append(found[ok])
            cols[2].append(score[ok])
        node = pa.array(np.concatenate(cols[1]))
        return pa.table({"query_id": pa.array(np.concatenate(cols[0])), "k1": index.column("k1").take(node), "k2": index.column("k2").take(node),
                         "score": pa.array(np.concatenate(cols[2])), "rep": index.column("vec_id").take(node)})

    return run


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, vec (doubles) and the vector's 128-bit key, for vectors that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    inf = float("inf")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0)
    # adding 0.0 makes -0.0 and 0.0 the same component
    return (df.filter(F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("vec"))
            .withColumn("k1", F.xxhash64(F.lit(1), "vec")).withColumn("k2", F.xxhash64("vec", F.lit(2))))


def _shard_of(number):
    """Shards hold vectors of one length only."""
    return number.cast("long") * 65536 + F.least(F.size("vec"), F.lit(65535))


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """Index rows (shard, node, vec_id, key, vec, edges, entry), members (key, vec_id) and the number of shards."""
    first = Window.partitionBy("k1", "k2").orderBy(F.col("vec_id").asc_nulls_last())
    members, _ = stage(vectors.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1), "ann-members")
    reps = members.filter("r = 1")
    n = reps.count()
    shards = max(1, -(-n // shard_rows))
    nodes = reps.withColumn("shard", _shard_of(F.pmod(F.xxhash64("k1", "k2", F.lit(5)), F.lit(shards))))
    index, _ = stage(nodes.select("shard", "vec_id", "k1", "k2", "vec").groupBy("shard").applyInArrow(
        _build, "shard long, node int, vec_id long, k1 long, k2 long, vec array<double>, edges array<int>, entry boolean"), "ann-index")
    return index, members.select("k1", "k2", "vec_id"), shards


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM, block_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query row, its own id left out.

    ``block_rows`` (default: what ``BLOCK_BYTES`` hold of the longest query vector) is how many
    queries meet a shard in one task.
    """
    index, members, shards = build_index(usable(vectors, id_col, vec_col), k, shard_rows)
    asked, n = stage(usable(queries, id_col, vec_col).select(F.col("vec_id").alias("query_id"), "vec"), "ann-queries")
    if block_rows is None:
        block_rows = max(1, BLOCK_BYTES // (8 * int(asked.agg(F.max(F.size("vec"))).first()[0] or 1)))
    blocks = max(1, -(-n // block_rows))
    # the stated query set in blocks: every shard meets every block once
    asked = (asked.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(9)), F.lit(blocks)).cast("int"))
             .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", _shard_of(F.col("s"))).drop("s"))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInArrow(_search(k, beam), "query_id long, k1 long, k2 long, score double, rep long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "rep")
    near = found.dropDuplicates(["query_id", "k1", "k2"]).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (near.select("query_id", "k1", "k2", "score").join(members, ["k1", "k2"])
            .filter(~F.col("vec_id").eqNullSafe(F.col("query_id")))
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(e, e.filter(F.col("vec_id") % 50 == 0))


QUERIES = {"op5_ann": op5_ann}
ORACLE = {}
