"""Run control (S9, K10, K11, G7): a run gate and an audit log, as tables.

The gate lets a run start only when the previous one completed: flag to 0,
work, audit row, flag to 1. A failed run leaves the flag at 0, which blocks
later runs until ``reset`` is called (the reference has no failure branch).

Reading the flag and setting it are two steps, so two runs that start together
would both pass. A run therefore first claims the pipeline by a lease file that
only one of them can create, and gives it back at its end. A run that dies keeps
the lease, as it keeps the flag at 0; ``reset`` clears both.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import PIPELINE_AUDIT_LOG, PIPELINE_RUN_STATUS
from strata.sources.tables import LayerTable


def _utc_now() -> str:
    # with its offset, so Spark reads the same instant whatever the session time zone
    return _dt.datetime.now(_dt.UTC).isoformat(sep=" ")


@dataclass
class ControlTables:
    status: LayerTable
    audit: LayerTable

    def create(self) -> ControlTables:
        """K8 for the two control tables."""
        self.status.create(PIPELINE_RUN_STATUS)
        self.audit.create(PIPELINE_AUDIT_LOG)
        return self

    def last_run_completed(self, pipeline: str) -> bool:
        """The flag of one pipeline; a pipeline without a row is an error."""
        row = (self.status.read().where(F.col("PIPELINE_NAME") == pipeline)
               .select("IS_LAST_RUN_COMPLETED").first())
        if row is None:
            raise KeyError(f"pipeline {pipeline!r} has no status row; register it first")
        return bool(row[0])

    def set_flag(self, pipeline: str, completed: bool) -> None:
        """Set (or create) the pipeline's flag: every other row, plus this one."""
        spark = self.status.spark
        one = spark.createDataFrame([(pipeline, completed)], PIPELINE_RUN_STATUS)
        others = self.status.read().where(~F.col("PIPELINE_NAME").eqNullSafe(pipeline))
        self.status.replace(others.unionByName(one).coalesce(1))

    register = set_flag

    def reset(self, pipeline: str) -> None:
        """Clear a flag left at 0 by a failed run, and the lease of one that died."""
        self.set_flag(pipeline, True)
        self.release(pipeline)

    # ------------------------------------------------------------ lease
    def _lease(self, pipeline: str):
        jvm = self.status.spark.sparkContext._jvm
        name = hashlib.sha256(pipeline.encode()).hexdigest()[:32]
        path = jvm.org.apache.hadoop.fs.Path(f"{self.status.root}/_lease/{name}")
        return path, path.getFileSystem(self.status.spark.sparkContext._jsc.hadoopConfiguration())

    def claim(self, pipeline: str, run_id: str) -> bool:
        """Take the pipeline's lease; False if another run holds it.

        The file is created exclusively: by the operating system for a local or
        mounted folder (Hadoop's local file system looks first and creates then),
        else by the store (HDFS and stores with conditional writes).
        """
        path, fs = self._lease(pipeline)
        text = f"{run_id}\n{_utc_now()}\n".encode()
        fs.mkdirs(path.getParent())
        if fs.getUri().getScheme() == "file":
            try:
                handle = os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "wb") as out:
                out.write(text)
            return True
        try:
            out = fs.create(path, False)
        except Exception as e:      # noqa: BLE001  (py4j wraps the store's own classes)
            if fs.exists(path):
                return False
            raise e
        out.write(bytearray(text))
        out.close()
        return True

    def holder(self, pipeline: str) -> str | None:
        """Run id of the run that holds the lease."""
        path, fs = self._lease(pipeline)
        if not fs.exists(path):
            return None
        row = self.status.spark.read.text(f"{path.getParent().toString()}/*").where(
            F.col("_metadata.file_name") == path.getName()).first()
        return row["value"] if row else ""

    def release(self, pipeline: str) -> None:
        path, fs = self._lease(pipeline)
        fs.delete(path, False)

    def log_run(self, pipeline: str, run_id: str, start: str, end: str) -> None:
        """Append one audit row."""
        spark = self.audit.spark
        row = spark.createDataFrame([(pipeline, run_id, start, end)],
                                    "PIPELINE_NAME string, PIPELINE_RUN_ID string, s string, e string")
        self.audit.append(row.select(
            "PIPELINE_NAME", "PIPELINE_RUN_ID",
            F.col("s").cast(T.TimestampType()).alias("PIPELINE_START_TIME"),
            F.col("e").cast(T.TimestampType()).alias("PIPELINE_END_TIME")))


def gated_run(
    control: ControlTables,
    pipeline: str,
    run_id: str,
    work: Callable[[], object],
    *,
    clock: Callable[[], str] = _utc_now,
) -> str:
    """``"completed"`` after work ran, ``"skipped"`` if another run holds the pipeline or the last one did not complete."""
    start = clock()
    if not control.claim(pipeline, run_id):
        return "skipped"
    try:
        if not control.last_run_completed(pipeline):
            return "skipped"
        control.set_flag(pipeline, False)
        work()  # an exception leaves the flag at 0
        control.log_run(pipeline, run_id, start, clock())
        control.set_flag(pipeline, True)
        return "completed"
    finally:
        control.release(pipeline)
