"""Fixed-size membership bitmaps: a broadcast whose size is a parameter, not a function of the data.

A set of 64-bit hashes becomes ``bits`` bits (a power of two). Members always
test true; others may (more often when the set is large against ``bits``), so a
bitmap may only be used where a false positive costs work, not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16


def build(hashes: DataFrame, col: str, bits: int) -> np.ndarray:
    """Bitmap of a long column, built per chunk on the executors; at most ``bits / 8`` bytes reach the driver."""
    at = F.col(col).bitwiseAND(F.lit(bits - 1))
    cells = hashes.select(F.shiftright(at, 16).cast("int").alias("chunk"), at.bitwiseAND(F.lit(CHUNK - 1)).cast("int").alias("bit")).distinct()

    def fill(tab: pa.Table) -> pa.Table:
        chunk = np.zeros(CHUNK, np.uint8)
        chunk[tab.column("bit").to_numpy()] = 1
        return pa.table({"chunk": tab.column("chunk").slice(0, 1), "body": pa.array([np.packbits(chunk).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    step = CHUNK // 8
    for r in cells.groupBy("chunk").applyInArrow(fill, "chunk int, body binary").toLocalIterator():
        body = np.frombuffer(r["body"], np.uint8)
        out[r["chunk"] * step:r["chunk"] * step + step] = body[:max(0, min(step, len(out) - r["chunk"] * step))]
    return out


def test(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    return ((bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1).astype(bool)
