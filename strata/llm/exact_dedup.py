"""Exact dedup by content sort (operator 9).

Normalised texts are range-partitioned on (leading bytes, digest, id) with
splitters that Spark samples, sorted externally, and neighbours are compared
in full. The digest only orders texts with the same leading bytes, so the sort
moves each text once and compares short keys. The id is the last part of the
range key: a text held by a third of all rows is cut over many partitions.

Each task settles the runs of equal texts inside its partition. A run that
touches a partition's first or last row may go on next door; there are at most
two such runs per partition, so their totals are a table of at most
``2 x partitions`` rows, which is what is broadcast.

Defined results: a null text is the empty text; a null id sorts below every id;
of rows with equal text and equal id one (any) is kept; an empty table gives no
rows. Columns of the input other than id and text are only read with
``with_rows``; then they come back unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import LOWER_BYTES, ascii_lower, table, utf8
from strata.session import stage

#: characters of the normalised text in the range key; it bounds the sampled splitters, not the comparison
KEY_CHARS = 64
OUT = "__x9_"


def _normalised(texts: pa.Array) -> pa.Array:
    raw, offs = utf8(texts)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(offs), pa.py_buffer(LOWER_BYTES[raw])])


def _runs(text_col: str, id_col: str, with_rows: bool):
    """Map sorted batches to rows with their run's local first id, size and edge flag."""
    import pyarrow.compute as pc

    def settle(batches):
        pid = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []     # rows of the run that is still open
        last = None                         # its normalised text
        first_run = True

        def emit(parts, edge):
            """Rows of one batch list whose runs are closed: ``parts`` is [(batch, starts)]."""
            rows = pa.Table.from_batches([b for b, _ in parts])
            starts = np.concatenate([s for _, s in parts])
            starts[0] = True
            at = np.flatnonzero(starts)
            size = np.diff(np.append(at, len(starts)))
            run = np.cumsum(starts) - 1
            ids = rows.column(id_col).combine_chunks() if rows.num_rows else None
            keep = ids.take(pa.array(at[run]))
            flag = np.zeros(len(starts), bool)
            if edge == "first":
                flag[run == 0] = True
            if edge == "last":
                flag[:] = True
            kept = np.zeros(len(starts), bool)
            kept[at] = True
            cols = {f: rows.column(f) for f in rows.schema.names if with_rows or f != text_col}
            cols |= {OUT + "keep": keep, OUT + "size": pa.array(size[run], pa.int64()),
                     OUT + "head": pa.array(kept), OUT + "edge": pa.array(flag),
                     OUT + "pid": pa.array(np.full(len(starts), pid, np.int32))}
            yield from pa.table(cols).to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            norm = _normalised(b.column(text_col))
            same = np.zeros(b.num_rows, bool)
            if b.num_rows > 1:
                same[1:] = pc.equal(norm.slice(1), norm.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            same[0] = last is not None and norm[0].as_py() == last
            starts = ~same
            cut = np.flatnonzero(starts)
            if len(cut) == 0:               # the open run goes on through this whole batch
                held.append((b.drop_columns([text_col]) if not with_rows else b, starts))
                continue
            # everything before the last start is closed now
            tail = int(cut[-1])
            slim = b if with_rows else b.drop_columns([text_col])
            closed = [*held, (slim.slice(0, tail), starts[:tail])] if tail else held
            closed = [(x, s) for x, s in closed if x.num_rows]
            if closed:
                yield from emit(closed, "first" if first_run else "")
                first_run = False
            held = [(slim.slice(tail), starts[tail:])]
            last = norm[b.num_rows - 1].as_py()
        if held:
            yield from emit(held, "last")

    return settle


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                with_rows: bool = False) -> DataFrame:
    """Equal texts after lower-casing A-Z: which row of each group stays (the largest id).

    Returns id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; with
    ``with_rows`` instead the input's own columns for the rows that stay.
    """
    names = docs.columns if with_rows else [id_col, text_col]
    # own names inside: no column of the caller can clash, dots in names do no harm
    own = {c: f"{OUT}c{i}" for i, c in enumerate(names)}
    norm = ascii_lower(F.col(f"`{text_col}`"))
    keyed = docs.select(*[F.col(f"`{c}`").alias(own[c]) for c in names], F.unhex(F.sha2(norm, 256)).alias(OUT + "sha"),
                        F.substring(norm, 1, KEY_CHARS).alias(OUT + "lead"))
    order = [F.col(OUT + "lead"), F.col(OUT + "sha"), F.col(own[id_col]).desc_nulls_last()]
    ordered = (keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop(OUT + "lead"))
    kept_fields = [f for f in ordered.schema if with_rows or f.name != own[text_col]]
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(kept_fields + [
        T.StructField(OUT + "keep", id_type), T.StructField(OUT + "size", T.LongType()),
        T.StructField(OUT + "head", T.BooleanType()), T.StructField(OUT + "edge", T.BooleanType()),
        T.StructField(OUT + "pid", T.IntegerType())])
    rows, _ = stage(ordered.mapInArrow(_runs(own[text_col], own[id_col], with_rows), schema), "exact-dedup", compression="zstd")

    # runs that may go on in a neighbouring partition: at most two per partition
    edges = (rows.filter(F.col(OUT + "edge") & F.col(OUT + "head"))
             .groupBy(F.col(OUT + "sha").alias(OUT + "esha"))
             .agg(F.sum(OUT + "size").alias(OUT + "total"), F.max(OUT + "keep").alias(OUT + "top"),
                  # the partition with the largest ids of a run comes first in the sort
                  F.min(OUT + "pid").alias(OUT + "front")))
    joined = rows.join(F.broadcast(edges), F.col(OUT + "edge") & (F.col(OUT + "sha") == F.col(OUT + "esha")), "left")
    whole = F.col(OUT + "total").isNotNull()
    kept = F.col(OUT + "head") & (~whole | (F.col(OUT + "pid") == F.col(OUT + "front")))
    if with_rows:
        return joined.filter(kept).select(*[F.col(own[c]).alias(c) for c in names])
    return joined.select(
        F.col(own[id_col]).alias(id_col),
        F.when(whole, F.col(OUT + "top")).otherwise(F.col(OUT + "keep")).alias("keep_id"),
        F.coalesce(OUT + "total", OUT + "size").alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex(OUT + "sha")).alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}

ORACLE = {"op9_exact_dedup": """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""}
