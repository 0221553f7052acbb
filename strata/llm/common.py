"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: byte table that lower-cases A-Z and leaves every other byte alone
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="strata-code-")) / "strata_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no plan reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written.

    It does so when the driver has collected their plans, which may be long after
    the disks are full; a step that needs much disk asks for it between its parts.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's way to return freed memory, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda keep: 0


def give_back() -> None:
    """Return memory that a Python worker has freed but its allocators keep.

    Workers stay for other tasks and steps, several beside each other; without it each
    holds what the largest batch so far took.
    """
    pa.default_memory_pool().release_unused()
    _trim()(0)


#: bytes of a batch or group that are worth a call of ``give_back``
MUCH = 4 << 20


def lean(func: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``func`` over batches, for ``mapInArrow``: freed memory is given back after large batches and at the end."""

    def run(batches):
        def each():
            for b in batches:
                much = b.nbytes >= MUCH
                yield b
                del b
                if much:
                    give_back()

        try:
            yield from func(each())
        finally:
            give_back()

    return run


def lean_group(func: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``func`` over a group, for ``applyInArrow``: freed memory is given back after large groups."""

    def run(tab: pa.Table) -> pa.Table:
        much = tab.nbytes >= MUCH
        out = func(tab)
        del tab
        if much:
            give_back()
        return out

    return run


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty text."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower())


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (length n + 1, first 0) of an Arrow string or binary column; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    n = len(arr)
    big = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if big else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]
