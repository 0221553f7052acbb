"""Blocks of rows that are read several times without moving them again.

Operators that score texts against a large table (n-gram counts, a word lattice)
cannot ship every occurrence through a join, and must not broadcast the table.
They work on blocks instead: a block is some MB of consecutive rows, compressed
(Arrow IPC, zstd), written once to the shared folder as a table bucketed by block
number. A pass over the blocks asks for what each block needs, each thing once
per block; the answers come back keyed by block number and meet the block where
its bucket is read. Only questions and answers are shuffled.

Blocks hold about ``BLOCK_BYTES`` of text (a longer text is a block of its own),
so a task's memory does not grow with the input, and a hot source or key only
makes more blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import give_back, lean
from strata.session import scratch_dir

BLOCK_BYTES = 8 << 20


def pack_rows(batch: pa.RecordBatch | pa.Table, level: int = 6) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as w:
        w.write(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all().combine_chunks()


def _blocks(text_col: str, id_col: str, id_name: str, block_bytes: int):
    def cut(batches):
        # a partition has fewer than 2^20 blocks of its rows
        number = TaskContext.get().partitionId() << 20
        held, size = [], 0

        def close():
            t = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([t.column(id_col).to_pylist()], pa.list_(t.schema.field(id_col).type)),
                 pa.array([pack_rows(t)], pa.binary())], names=["block", id_name, "body"])

        for b in batches:
            ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(b.column(text_col)), 0).cast(pa.int64()))
            ends = ends.to_numpy(zero_copy_only=False)
            at = 0
            while at < b.num_rows:
                done = int(ends[at - 1]) if at else 0
                # rows that still fit; at least one into an empty block
                upto = int(ends.searchsorted(done + block_bytes - size, side="right"))
                upto = max(upto, at + (not held))
                if upto > at:
                    held.append(b.slice(at, upto - at))
                    size += int(ends[upto - 1]) - done
                    at = upto
                if at < b.num_rows or size >= block_bytes:
                    yield close()
                    number += 1
                    held, size = [], 0
        if held:
            yield close()

    return cut


def bucketed(df: DataFrame, *keys: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder, bucketed by ``keys``: joins and groups on them do not shuffle it.

    A task writes a file for every bucket that it has rows of, and the driver holds all files of
    the table; so ``df`` comes dealt by ``keys`` to as many partitions as there are buckets.
    """
    spark = df.sparkSession
    name = f"strata_bucketed_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).option("path", scratch_dir(spark, "bucketed")).option("compression", compression).saveAsTable(name)
    return spark.table(name)


class Blocks:
    """A bucketed table of blocks; ``drop`` removes its catalog entry (files go with the scratch folder)."""

    def __init__(self, rows: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
        self.spark = rows.sparkSession
        self.schema = rows.schema
        self.name = f"strata_blocks_{uuid.uuid4().hex[:12]}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = rows.mapInArrow(lean(_blocks(text_col, id_col, "ids", block_bytes)), T.StructType([
            T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema[id_col].dataType)),
            T.StructField("body", T.BinaryType())]))
        (blocks.write.bucketBy(buckets, "block").option("path", scratch_dir(self.spark, "blocks"))
         .option("compression", "none").saveAsTable(self.name))
        self.table = self.spark.table(self.name)

    def ids(self) -> DataFrame:
        """block, row (number in the block) and id."""
        return self.table.select("block", F.posexplode("ids").alias("row", "id"))

    def meet(self, side: DataFrame, func: Callable[[int, pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
        """``func(block, rows, side rows)`` for every block; only ``side`` (column ``block``) is shuffled."""

        def both(key, mine: pa.Table, other: pa.Table) -> pa.Table:
            if not mine.num_rows:
                return func(None, None, other)
            out = func(key[0].as_py(), unpack_rows(mine.column("body")[0].as_py()), other)
            give_back()
            return out

        return (self.table.select("block", "body").groupBy("block")
                .cogroup(side.groupBy("block")).applyInArrow(both, schema))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
