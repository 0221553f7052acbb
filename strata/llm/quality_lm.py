"""Quality classifier (operator 3): interpolated modified Kneser-Ney n-grams, judged by perplexity.

*Symbols.* A text is its UTF-8 bytes; a word that repeats the word before it becomes
one mark, and marks are no history, so every repeat is as surprising as the first. ``order - 1``
zero bytes stand before a text. An n-gram fits a 64-bit integer, exactly.

*Models.* One per language and fold: rows fall into two folds by hash, and trusted
rows train the model that scores the *other* fold, so no text is scored by a model
that has read it. All trusted rows are counted.

*Count joins.* Counts are grouped sums; lower orders are continuation counts. Blocks
of texts ask for their distinct (model, n-gram) once; the distinct questions are
joined with the sharded tables order by order (discounted probability, back-off
weight of the context), and the answers return to their blocks in packed parcels,
since they are most of what is shuffled. Nothing about the
model is broadcast or collected except its discounts (4 numbers per model and order).

*Decision.* A text's bits per symbol are shrunk to its language's mean by ``prior``
symbols (short texts say little). Its language's threshold is a quantile of the
trusted rows' values plus a margin in multiples of a quantile distance:
``q(high) + margin * (q(high) - q(0.5))``. Texts above it are rejected.

Defined results: null and empty texts have no symbols and are kept (nothing speaks
against them); a null language is a language of its own; a language without trusted
rows keeps all its texts; repeated rows are scored row by row; other columns pass
through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.blocks import Blocks, bucketed, pack_rows, unpack_rows
from strata.llm.common import delete_folder, give_back, release_shuffles, table, utf8
from strata.llm.suffix_dedup import SpanHash
from strata.session import owned_scratch, scratch_dir, stage

ORDER = 5
#: bytes of text in a block: larger blocks ask for fewer n-grams twice
BLOCK_BYTES = 12 << 20
#: block numbers that differ below this bit are answered together (blocks of 512 input partitions)
SALT_BIT = 29
#: answers that a task packs at a time, and packed parcels that leave it at a time
PARCEL_ROWS = 1 << 20
PARCELS = 256
#: rows that leave a block's task at a time
PART = 1 << 16
#: bytes of text that a block's task looks at together
PIECE = 1 << 18
#: n-grams that wait, beside those merged before, until they are merged
LOOSE = 1 << 18
MARK = 1
PRIOR = 200.0
HIGH, MARGIN = 0.95, 6.0

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def symbols(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts with repeated words as one mark each; new bytes and offsets."""
    if not len(raw):
        return raw, offs
    inside = ~IS_SPACE[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offs[:-1] < offs[1:]
    start[offs[:-1][full]] = inside[offs[:-1][full]]
    end[offs[1:][full] - 1] = inside[offs[1:][full] - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    h = SpanHash(raw)(s, e)
    text = np.searchsorted(offs, s, side="right")
    again = np.flatnonzero(np.append(False, (h[1:] == h[:-1]) & (text[1:] == text[:-1])))
    if not len(again):
        return raw, offs
    # the gap and the repeated word become one mark
    out = raw.copy()
    out[e[again] - 1] = MARK
    drop = np.zeros(len(raw) + 1, np.int64)
    np.add.at(drop, e[again - 1], 1)
    np.add.at(drop, e[again] - 1, -1)
    keep = np.cumsum(drop[:-1]) == 0
    total = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], total[offs]


def grams(raw: np.ndarray, offs: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each symbol, as one integer (zero bytes before a text).

    Marks are no history: the tenth repeat is as surprising as the first.
    """
    solid = raw != MARK
    total = np.concatenate([[0], np.cumsum(solid)])[:-1]   # symbols before each place, marks left out
    plain = raw[solid].astype(np.int64)
    before = np.zeros(len(plain) + 1, np.int64)            # the symbols before each, across texts
    for j in range(1, order):
        before[j:] |= plain[:len(plain) + 1 - j] << (8 * j)
    out = before[total] if len(plain) < len(raw) else before[:-1].copy()
    out |= raw
    starts = np.minimum(offs[:-1], max(len(raw) - 1, 0))
    place = total - np.repeat(total[starts], np.diff(offs)) if len(raw) else total
    early = np.flatnonzero(place < order - 1)              # what another text holds goes
    out[early] &= (np.int64(1) << (8 * (place[early] + 1))) - 1
    return out


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _by_model(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Places, models and texts of a block's rows, model by model, so that a piece holds few models."""
    model = rows.column("m").to_numpy()
    by = np.argsort(model, kind="stable")
    return by, model[by], rows.select(["text"]).take(pa.array(by))


class Counts:
    """Distinct n-grams with counts, merged as they come: about twice what is left in the end is held."""

    def __init__(self, counted: bool):
        self.counted = counted
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.loose = self.merged = 0

    def add(self, g: np.ndarray) -> None:
        self.parts.append(np.unique(g, return_counts=True) if self.counted else (_distinct(g),))
        self.loose += len(self.parts[-1][0])
        if self.loose > self.merged + LOOSE:
            self.merge()

    def merge(self) -> tuple[np.ndarray, ...]:
        if self.loose:
            g, *n = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            self.parts.clear()
            if self.counted:
                by = np.argsort(g)
                g = g[by]
                first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
                self.parts = [(g[first], np.add.reduceat(n[0][by], first))]
            else:
                self.parts = [(_distinct(g),)]
            self.merged, self.loose = len(self.parts[0][0]), 0
        return self.parts[0]


def _pieces(rows: pa.Table):
    """Slices of rows with about ``PIECE`` bytes of text: (first row, symbols, offsets)."""
    raw, offs = utf8(rows.column("text"))
    at = 0
    n = len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + PIECE, side="right")) - 1)
        to = min(to, n)
        yield at, *symbols(raw[offs[at]:offs[to]], offs[at:to + 1] - offs[at])
        at = to


def _ask(order: int):
    """Questions (n = 0) and training counts (n > 0) of a block."""

    def run(block, rows, trusted):
        none = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=["block", "m", "g", "n"])
        if rows is None:
            return pa.Table.from_batches([none])
        good = np.zeros(rows.num_rows, bool)
        good[trusted.column("row").to_numpy().astype(np.int64)] = True
        by, model, texts = _by_model(rows)
        good = good[by]
        del rows
        asked: dict[int, Counts] = {}
        train: dict[int, Counts] = {}
        for at, raw, offs in _pieces(texts):
            g = grams(raw, offs, order)
            size = np.diff(offs)
            m = np.repeat(model[at:at + len(size)], size)
            t = np.repeat(good[at:at + len(size)], size)
            for one in np.unique(model[at:at + len(size)][size > 0]):
                own = m == one
                asked.setdefault(int(one), Counts(False)).add(g[own])
                if (own & t).any():     # the other fold's model learns from it
                    train.setdefault(int(one) ^ 1, Counts(True)).add(g[own & t])
        del texts
        out = [none]
        # in parts: the other side of the pipe holds one of them at a time
        for held in (asked, train):
            while held:
                one, counts = held.popitem()
                u, *n = counts.merge()
                n = n[0] if n else np.zeros(len(u), np.int64)
                del counts
                for k in range(0, len(u), PART):
                    size = len(u[k:k + PART])
                    out.append(pa.RecordBatch.from_arrays([pa.array(np.full(size, block, np.int64)), pa.array(np.full(size, one, np.int64)), pa.array(u[k:k + PART]),
                                                           pa.array(n[k:k + PART])], names=["block", "m", "g", "n"]))
        return pa.Table.from_batches(out)

    return run


def _parcels(batches):
    """Answers (m, g, bits, the blocks that asked) -> per block a few parcels of packed answers.

    A parcel is sorted by place and holds differences of n-grams, which compress well; a
    task holds ``PARCEL_ROWS`` answers, however many it has.
    """

    def close(held):
        # column by column, so that few copies of the answers stand beside each other
        cols = [list(c) for c in zip(*held, strict=True)]
        held.clear()
        block, m, g, bits = (np.concatenate(cols.pop(0)) for _ in range(4))
        by = np.lexsort((g, m, block))
        block = block[by]
        m = m[by]
        g = g[by]
        bits = bits[by]
        del by
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        step = np.diff(g, prepend=0)
        step[first] = g[first]
        del g
        for k in range(0, len(first), PARCELS):
            at = first[k:k + PARCELS].tolist()
            ends = [*at[1:], int(first[k + PARCELS]) if k + PARCELS < len(first) else len(block)]
            yield pa.RecordBatch.from_arrays([pa.array(block[at]), pa.array([
                pack_rows(pa.table({"m": m[x:y], "step": step[x:y], "bits": bits[x:y]}), level=1) for x, y in zip(at, ends, strict=True)], pa.binary())],
                names=["block", "parcel"])

    held, size = [], 0
    for b in batches:
        asked = b.column("asked")
        ends = np.cumsum(asked.value_lengths().to_numpy(), dtype=np.int64)
        at = 0
        while at < b.num_rows:          # rows that still fit; at least one
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + PARCEL_ROWS - size, side="right")))
            n = np.diff(ends[at:to], prepend=done)
            held.append((asked.slice(at, to - at).flatten().to_numpy(), *(np.repeat(b.column(c).slice(at, to - at).to_numpy(), n) for c in ("m", "g", "bits"))))
            size += int(n.sum())
            at = to
            if at < b.num_rows or size >= PARCEL_ROWS:
                yield from close(held)
                give_back()
                held, size = [], 0
    if size:
        yield from close(held)
    give_back()


def _unpacked(parcels) -> list[np.ndarray]:
    """m, g and bits of parcels."""
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]]
    for blob in parcels:
        t = unpack_rows(blob.as_py())
        out[0].append(t.column("m").to_numpy())
        out[1].append(np.cumsum(t.column("step").to_numpy()))
        out[2].append(t.column("bits").to_numpy())
    return [np.concatenate(out.pop(0)) for _ in range(3)]


def _known(parcels) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By model, sorted n-grams and their bits, from a block's parcels."""
    held: dict[int, list] = {}
    for blob in parcels:
        m, g, bits = _unpacked([blob])
        first = np.flatnonzero(np.append(True, m[1:] != m[:-1])).tolist() if len(m) else []
        for x, y in zip(first, [*first[1:], len(m)], strict=False):
            held.setdefault(int(m[x]), []).append((g[x:y], bits[x:y]))
    out = {}
    while held:
        one, parts = held.popitem()
        g, bits = (np.concatenate(c) for c in zip(*parts, strict=True))
        parts.clear()
        by = np.argsort(g, kind="stable")
        out[one] = g[by], bits[by]
    return out


def _score(order: int):
    def run(block, rows, answers):
        names = ["block", "row", "bits", "n"]
        if rows is None:
            return pa.table({c: pa.array([], pa.float64() if c == "bits" else pa.int64()) for c in names})
        known = _known(answers.column("parcel"))
        del answers
        place, model, texts = _by_model(rows)
        total_rows = rows.num_rows
        del rows
        bits, count = np.zeros(total_rows), np.zeros(total_rows, np.int64)
        for at, raw, offs in _pieces(texts):
            g = grams(raw, offs, order)
            size = np.diff(offs)
            m = np.repeat(model[at:at + len(size)], size)
            cost = np.zeros(len(g))
            for one in np.unique(model[at:at + len(size)][size > 0]):
                own = np.flatnonzero(m == one)
                if int(one) in known:       # sorted first: neighbours are found near each other
                    ag, ab = known[int(one)]
                    own = own[np.argsort(g[own])]
                    cost[own] = ab[np.searchsorted(ag, g[own])]
            total = np.concatenate([[0.0], np.cumsum(cost)])
            bits[place[at:at + len(size)]] = total[offs[1:]] - total[offs[:-1]]
            count[place[at:at + len(size)]] = size
        return pa.table({"block": pa.array(np.full(total_rows, block, np.int64)), "row": pa.array(np.arange(total_rows)),
                         "bits": pa.array(bits), "n": pa.array(count)})

    return run


def kneser_ney(counts: DataFrame, asked: DataFrame, order: int) -> DataFrame:
    """``m, g, p``: probability of the last symbol of every asked n-gram.

    ``counts`` has (m, g, c) of the highest order, ``asked`` distinct (m, g).
    p_k = max(c - D(c), 0) / sum(c of context) + backoff(context) * p_(k-1), p_0 = 1 / 256.
    """
    level = {order: counts}
    for k in range(order - 1, 0, -1):
        # continuation counts: the (k+1)-grams that end in a k-gram differ in their first symbol
        # staged, since four steps read each level
        level[k], _ = stage(level[k + 1].groupBy("m", F.col("g").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("g"))
                            .agg(F.count(F.lit(1)).alias("c")), "quality-level")
    mask = lambda k: F.lit((1 << (8 * k)) - 1)
    # shorter n-grams are fewer: each is looked up once, not once per question that ends in it
    need = {order: asked.select("m", "g")}
    for k in range(order - 1, 0, -1):
        need[k], _ = stage(need[k + 1].select("m", F.col("g").bitwiseAND(mask(k)).alias("g")).distinct(), "quality-need")
    release_shuffles(counts.sparkSession)
    below = None
    for k in range(1, order + 1):
        of = lambda j: F.sum((F.col("c") == j).cast("double"))  # noqa: E731, B023
        # 4 numbers per model: a text's languages bound it
        d = level[k].groupBy("m").agg(*[of(j).alias(f"n{j}") for j in (1, 2, 3, 4)])
        some = lambda c: F.nullif(c, F.lit(0.0))
        y = F.col("n1") / some(F.col("n1") + 2 * F.col("n2"))

        def rate(j: int, y=y, some=some) -> Column:
            raw = j - (j + 1) * y * F.col(f"n{j + 1}") / some(F.col(f"n{j}"))
            return F.greatest(F.lit(0.05), F.least(F.lit(j - 0.05), F.coalesce(raw, F.lit(0.5 * j)))).alias(f"d{j}")

        d = d.select("m", rate(1), rate(2), rate(3))
        grams_k = level[k].withColumn("h", F.shiftright("g", 8))
        context = (grams_k.groupBy("m", "h").agg(F.sum("c").alias("all"), of(1).alias("e1"), of(2).alias("e2"), of(3).alias("e3"), F.count(F.lit(1)).alias("e"))
                   .join(F.broadcast(d), "m")
                   .select("m", "h", "all", "d1", "d2", "d3",
                           ((F.col("d1") * F.col("e1") + F.col("d2") * F.col("e2") + F.col("d3") * (F.col("e") - F.col("e1") - F.col("e2"))) / F.col("all")).alias("b")))
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        seen = F.when(F.col("c").isNotNull(), F.greatest(F.col("c") - off, F.lit(0.0)) / F.col("all")).otherwise(F.lit(0.0))
        out = (need[k].join(level[k], ["m", "g"], "left").withColumn("h", F.shiftright("g", 8))
               .join(context, ["m", "h"], "left")
               .select("m", "g", seen.alias("seen"), F.coalesce("b", F.lit(1.0)).alias("w")))
        if below is None:
            out = out.withColumn("low", F.lit(1 / 256))
        else:
            out = (out.withColumn("s", F.col("g").bitwiseAND(mask(k - 1)))
                   .join(below.select("m", F.col("g").alias("s"), F.col("p").alias("low")), ["m", "s"]))
        below = out.select("m", "g", (F.col("seen") + F.col("w") * F.col("low")).alias("p"))
        if k < order:
            below, _ = stage(below, "quality-lower")
            release_shuffles(counts.sparkSession)
    return below


class QualityModel:
    """Scores of all rows and the thresholds; see the module's text."""

    def __init__(self, docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", order: int = ORDER, prior: float = PRIOR, high: float = HIGH, margin: float = MARGIN,
                 block_bytes: int = BLOCK_BYTES):
        self.columns = docs.columns
        self.schema = docs.schema
        lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("\x00"))
        fold = F.xxhash64(F.lit(3), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).bitwiseAND(F.lit(1))
        model = F.xxhash64(F.lit(4), lang).bitwiseAND(F.lit(-2)).bitwiseOR(fold)
        # own names inside, so that no column of the caller can clash
        rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), model.alias("m"), lang.alias("lang"),
                           *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)],
                           F.col(f"`{text_col}`").isNull().alias("empty"))
        self.own = {id_col: "id", text_col: "text"}
        self.blocks = Blocks(rows, "id", "text", block_bytes)
        long = lambda c: T.StructField(c, T.LongType())
        known = trusted.select(F.col(f"`{id_col}`").alias("id")).filter("id IS NOT NULL").distinct()
        spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "quality-scores")
        with owned_scratch(spark):      # of what it stages only the scores are read later
            learn, _ = stage(self.blocks.ids().join(known, "id").select("block", "row"), "quality-trusted")
            scored = self.blocks.meet(self._answers(learn, order), _score(order), "block long, row long, bits double, n long")
            names = self.blocks.meet(learn.withColumn("t", F.lit(True)), _names, T.StructType([
                long("block"), long("row"), T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang", T.StringType()), T.StructField("trusted", T.BooleanType())]))
            scored.join(names, ["block", "row"]).write.parquet(path)
        release_shuffles(spark)
        raw = spark.read.parquet(path)
        # per language: mean bits per symbol and the quantiles of trusted rows; no row where nothing is trusted
        mean = raw.filter("trusted").groupBy("lang").agg((F.sum("bits") / F.nullif(F.sum("n"), F.lit(0).cast("long"))).alias("mean"))
        value = F.when(F.col("n") > 0, (F.col("bits") + prior * F.col("mean")) / (F.col("n") + prior))
        shrunk = raw.join(F.broadcast(mean), "lang", "left").withColumn("value", value)
        limits = (shrunk.filter("trusted AND n > 0").groupBy("lang")
                  .agg(F.percentile_approx("value", [0.5, high], 10000).alias("q"))
                  .select("lang", (F.col("q")[1] + margin * (F.col("q")[1] - F.col("q")[0])).alias("threshold")))
        limits, _ = stage(limits, "quality-limits")
        self.scores = (shrunk.join(F.broadcast(limits), "lang", "left")
                       .withColumn("keep", F.coalesce(F.col("value") <= F.col("threshold"), F.lit(True))))

    def _answers(self, learn: DataFrame, order: int) -> DataFrame:
        """block and ``parcel``: the answers to all that a block asks, ``learn`` being its rows to count."""
        long = lambda c: T.StructField(c, T.LongType())
        spark, path = learn.sparkSession, scratch_dir(learn.sparkSession, "quality-asks")
        (self.blocks.meet(learn, _ask(order), T.StructType([long("block"), long("m"), long("g"), long("n")]))
         .write.option("compression", "zstd").parquet(path))
        asks = spark.read.parquet(path)
        counts_path, answers_path = scratch_dir(spark, "quality-counts"), scratch_dir(spark, "quality-answers")
        asks.filter("n > 0").groupBy("m", "g").agg(F.sum("n").alias("c")).write.option("compression", "zstd").parquet(counts_path)
        release_shuffles(spark)
        # every question once per salt, with the blocks that asked; dealt by what joins use, so it is moved only once
        dealt = asks.filter("n = 0").select("m", "g", "block").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "m", "g")
        questions = bucketed(dealt.groupBy("m", "g", F.shiftright("block", SALT_BIT).alias("salt"))
                             .agg(F.collect_list("block").alias("asked")), "m", "g", compression="zstd")
        del asks
        delete_folder(spark, path)      # counts and questions are tables of their own now
        release_shuffles(spark)
        with owned_scratch(spark):      # the levels go once the answers are written
            (kneser_ney(spark.read.parquet(counts_path), questions.select("m", "g").distinct(), order)
             .select("m", "g", (-F.log2("p")).cast("float").alias("bits")).write.option("compression", "zstd").parquet(answers_path))
        delete_folder(spark, counts_path)
        release_shuffles(spark)
        return (questions.join(spark.read.parquet(answers_path), ["m", "g"]).select("m", "g", "bits", "asked")
                .mapInArrow(_parcels, "block long, parcel binary"))

    def kept_rows(self) -> DataFrame:
        """The rows that stay, with all their columns as they came."""
        names = [self.own.get(c, f"c{i}") for i, c in enumerate(self.columns)]

        def pick(block, rows, kept):
            if rows is None:
                return None
            return rows.take(pa.array(np.sort(kept.column("row").to_numpy()))).select(list(dict.fromkeys([*names, "empty"])))

        inner = list(dict.fromkeys([*names, "empty"]))
        by = {f.name: f.dataType for f in self.blocks.schema}
        schema = T.StructType([T.StructField(c, by[c]) for c in inner])
        out = self.blocks.meet(self.scores.filter("keep").select("block", "row"), _or_empty(pick, inner), schema)

        def col(c, inner_name) -> Column:
            if inner_name == "text":
                return F.when(~F.col("empty"), F.col("text")).alias(c)
            return F.col(inner_name).alias(c)

        return out.select(*[col(c, n) for c, n in zip(self.columns, names, strict=True)])


def _or_empty(func, names):
    def run(block, rows, other):
        if rows is None:
            raise RuntimeError("an answer without its block")
        return func(block, rows, other)

    return run


def _names(block, rows, trusted):
    good = np.zeros(rows.num_rows, bool)
    good[trusted.column("row").to_numpy().astype(np.int64)] = True
    return pa.table({"block": pa.array(np.full(rows.num_rows, block, np.int64)), "row": pa.array(np.arange(rows.num_rows)),
                     "id": rows.column("id"), "lang": rows.column("lang"), "trusted": pa.array(good)})


def trusted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = QualityModel(table(spark, sf_dir, "documents"), trusted_rows(spark, sf_dir))
    return model.scores.select(
        F.col("id").alias("doc_id"), F.nullif(F.col("lang"), F.lit("\x00")).alias("lang"), F.col("n").alias("n_symbols"),
        F.pow(F.lit(2.0), "value").alias("perplexity"), F.pow(F.lit(2.0), "threshold").alias("threshold"), "keep")


QUERIES = {"op3_quality_classifier": op3_quality_classifier}
ORACLE = {}
