"""Session-level helpers: the shared work folder and lineage cuts.

All scratch output (CSV drops, staged tables, checkpoints) lives below the
folder the cluster names in ``spark.checkpoint.dir``, never in a machine-local
temporary folder. Only a local-mode session without that setting (tests) gets
a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: scratch folders of the load that runs in this thread, if it owns them
_OWNED: ContextVar[list[str] | None] = ContextVar("strata_owned_scratch", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unused folder below the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/strata-work/{tag}-{uuid.uuid4().hex[:12]}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that the body creates when it ends, failed or not.

    For a load that has published its result: a DataFrame that still reads a staged
    table must not leave the body.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, tag: str = "stage", compression: str | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as a parquet table in the shared folder; read it back, with its row count.

    Cuts lineage like ``checkpoint()``, but columnar and compressed; columns
    computed before the write (row ids, partition ids) are frozen by it. The
    count is observed during the write, so it costs no extra job.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    path = scratch_dir(df.sparkSession, tag)
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path), int(obs.get["rows"])


def purge_scratch(spark: SparkSession, older_than_s: float, root: str | None = None) -> list[str]:
    """Delete scratch folders (staged tables, CSV drops) older than ``older_than_s`` seconds.

    Only folders directly below ``<checkpoint folder>/strata-work`` (or ``root``)
    are considered. Call it between runs: a DataFrame still being read must not
    lose its staged input.
    """
    import time

    sc = spark.sparkContext
    base = root or f"{checkpoint_root(spark)}/strata-work"
    path = sc._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    cutoff = (time.time() - older_than_s) * 1000
    removed = []
    for status in fs.listStatus(path):
        if status.isDirectory() and status.getModificationTime() < cutoff:
            fs.delete(status.getPath(), True)
            removed.append(status.getPath().toString())
    return removed
