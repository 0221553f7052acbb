"""Surrogate keys: dense numbering in a total order (W1/W2) and key retention.

``row_number().over(Window.orderBy(...))`` without a partition puts every row in
one task. ``dense_number`` gives the same numbers with every step partitioned, and
moves only what the order needs:

1. rows are named by their order columns and a 128-bit hash of the whole row; equal
   rows are counted under one name (a partial aggregate, so a row that repeats
   without end is no hot key), and the names are staged: order columns, hash, count;
2. names are range-partitioned and sorted on (order columns, hash), so even a group
   of ties spreads over many partitions; running totals of the counts within each
   partition are staged (hash, count, start);
3. one row per partition gives the offsets (a broadcast join whose size is bounded
   by the partition count);
4. the numbers are joined back to the rows by the hash. Of equal rows one is taken
   and written out under each of its numbers.

Rows themselves are staged once, unless computing them again gives the same rows
(``deterministic_input``); then they are not staged at all. A row whose hash has no
number, because it changed in between, raises. The plan is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_column, resolve_columns
from strata.operators.upsert import DuplicateKeyError
from strata.session import stage

_H1, _H2 = "__strata_h1", "__strata_h2"
_N, _PID, _START, _OFF, _FIRST = "__strata_n", "__strata_pid", "__strata_start", "__strata_off", "__strata_first"
_ROW, _PART, _POS = "__strata_row", "__strata_part", "__strata_pos"

#: copies of one row that one task writes, at most
_COPIES = 100_000


def row_name(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the given columns; nulls count by their place, 0.0 and -0.0 are equal."""
    flat = [F.to_json(F.struct(qcol(c))) if isinstance(df.schema[c].dataType, T.StructType | T.ArrayType | T.MapType) else qcol(c)
            for c in columns]
    nulls = [qcol(c).isNull() for c in columns]
    return [F.xxhash64(*flat, *nulls).alias(_H1), F.xxhash64(F.lit(7), *flat[::-1], *nulls).alias(_H2)]


def _running_totals(batches):
    """Sorted (h1, h2, n) of one partition -> with the partition's number and the rows before."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    before, part = 0, TaskContext.get().partitionId()
    for b in batches:
        n = b.column(2).to_numpy(zero_copy_only=False)
        upto = before + np.cumsum(n, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(upto - n)], names=[_H1, _H2, _N, _PID, _START])
        before = int(upto[-1]) if len(n) else before


def dense_number(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    *,
    rows_per_partition: int = 2_000_000,
    deterministic_input: bool = False,
    total_order: bool = False,
) -> DataFrame:
    """Add ``key`` = 1..N (bigint) following ascending ``order_by`` (nulls first).

    Rows that tie on ``order_by`` get consecutive numbers in the order of their
    hashes. Set ``deterministic_input`` only when computing ``df`` again gives the
    same rows, in whatever order (a file scan, and what exact operators make of it):
    no row is staged then. Set ``total_order`` only when no two rows tie on
    ``order_by``: the hash is then of these columns alone, and a tie raises.
    """
    spark, cols = df.sparkSession, df.columns
    order = resolve_columns(cols, order_by, "order column")
    if resolve_column(cols, key) is not None:
        raise ValueError(f"key column {key!r} already exists in {cols}")
    width, total = int(spark.conf.get("spark.sql.shuffle.partitions")), None
    if not deterministic_input:
        df, total = stage(df, "unnumbered")
    name = row_name(df, order if total_order else cols)
    named = df.select(*[qcol(c).alias(f"__o{i}") for i, c in enumerate(order)], *name)
    if total_order:      # every name is there once: counted where they meet, not in the task that reads them
        named = named.repartition(width, *[f"__o{i}" for i in range(len(order))], _H1, _H2)
    names, n = stage(named.groupBy(*[f"__o{i}" for i in range(len(order))], _H1, _H2).agg(F.count(F.lit(1)).alias(_N)), "names")
    if total_order:
        names = names.withColumn(_N, F.when(F.col(_N) > 1, F.raise_error(F.lit(f"rows tie on {order}"))).otherwise(F.col(_N)).cast("long"))
    parts = max(width, math.ceil(n / rows_per_partition))
    by = [*[F.col(f"__o{i}").asc_nulls_first() for i in range(len(order))], F.col(_H1), F.col(_H2)]
    ranked, _ = stage(
        names.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(_H1, _H2, _N)
        .mapInArrow(_running_totals, f"{_H1} long, {_H2} long, {_N} long, {_PID} int, {_START} long"), "ranked")
    # at most `parts` rows: a bounded single-partition window and broadcast
    offsets = (
        ranked.groupBy(_PID).agg(F.sum(_N).alias("n"))
        .withColumn(_OFF, F.coalesce(
            F.sum("n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
        .select(_PID, _OFF)
    )
    numbers = ranked.join(F.broadcast(offsets), _PID).select(_H1, _H2, _N, (F.col(_OFF) + F.col(_START)).alias(_FIRST))
    lost = F.raise_error(F.lit("a row changed while it was numbered; leave deterministic_input unset"))
    found = (df.select(*[qcol(c) for c in cols], *name).join(numbers, [_H1, _H2], "left")
             .withColumn(_N, F.when(F.col(_N).isNull(), lost).otherwise(F.col(_N)).cast("long")))
    single = found.where(F.col(_N) == 1).select(*[qcol(c) for c in cols], (F.col(_FIRST) + 1).cast("long").alias(key))
    if total_order or n == total:       # no two rows are equal
        return single
    equal = (found.where(F.col(_N) > 1).groupBy(_H1, _H2)
             .agg(F.first(F.struct(*[qcol(c) for c in cols])).alias(_ROW), F.max(_N).alias(_N), F.max(_FIRST).alias(_FIRST)))
    share = max(1, min(_COPIES, rows_per_partition))
    split = (equal.select(_ROW, _N, _FIRST, F.explode(F.expr(f"sequence(0L, ({_N} - 1) div {share})")).alias(_PART))
             .repartition(width))
    copies = split.select(_ROW, _FIRST, F.explode(F.expr(
        f"sequence({_PART} * {share}, least({_N}, ({_PART} + 1) * {share}) - 1)")).alias(_POS))
    return single.unionByName(copies.select(
        *[F.col(_ROW).getField(c).alias(c) for c in cols], (F.col(_FIRST) + F.col(_POS) + 1).cast("long").alias(key)))


def assign_keys(
    batch: DataFrame,
    existing: DataFrame,
    natural_key: Sequence[str],
    key: str,
    order_by: Sequence[str],
    *,
    deterministic_input: bool = False,
) -> DataFrame:
    """Entities already in ``existing`` keep their key; new ones get max + n.

    Both sides must hold an entity once: a natural key that repeats (nulls count
    as equal) raises ``DuplicateKeyError``, since a second row would take a second
    key and the table would grow with every run. The natural key matches null-safely.
    """
    nk = resolve_columns(batch.columns, natural_key, "natural key")
    check_one_row_each(batch, nk, "batch")
    check_one_row_each(existing, natural_key, "existing keys")
    known = existing.select(*[qcol(c).alias(f"__k_{i}") for i, c in enumerate(natural_key)],
                            qcol(key).alias(_OFF))
    cond = [batch[c].eqNullSafe(known[f"__k_{i}"]) for i, c in enumerate(nk)]
    joined = batch.join(known, cond, "left")
    cols = [c for c in batch.columns if c != key]
    old = joined.where(F.col(_OFF).isNotNull()).select(*[qcol(c) for c in cols], F.col(_OFF).cast("long").alias(key))
    fresh = joined.where(F.col(_OFF).isNull()).select(*[qcol(c) for c in cols])
    top = existing.agg(F.max(qcol(key))).first()[0] or 0
    order = resolve_columns(batch.columns, order_by, "order column")
    # an order that holds the natural key is unique
    numbered = dense_number(fresh, order, key, total_order=set(nk) <= set(order), deterministic_input=deterministic_input)
    return old.unionByName(numbered.withColumn(key, F.col(key) + F.lit(int(top))))


def check_one_row_each(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise ``DuplicateKeyError`` if a key occurs twice (null equals null).

    Keys that pass are there once, so they are counted where they meet: a task that
    reads rows need not hold all of their keys.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dup = (df.select(*[qcol(k) for k in keys]).repartition(width, *[qcol(k) for k in keys])
           .groupBy(*[qcol(k) for k in keys]).agg(F.count(F.lit(1)).alias(_POS))
           .where(F.col(_POS) > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"{what}: key {list(keys)} repeats, e.g. {dup[0].asDict()}")
