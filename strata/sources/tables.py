"""Path-based tables with versioned replace (S7, K1, K2/K3 publish, K7, K8).

A table is a folder of versions ``v=000001``, ``v=000002`` ... Appends add files
to the current version; a replace writes the next version, so a plan that reads
the current version is never overwritten while it runs (overwriting a path the
plan reads deletes the data first). The newest version is the table.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import ADDED_BY
from strata.sources.partitioned import PartitionedTable

_VERSION = re.compile(r"v=(\d+)")


class LayerTable:
    """One table of one layer, stored under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __repr__(self) -> str:
        return f"LayerTable({self.root!r})"

    # ------------------------------------------------------------ versions
    def versions(self, committed: bool = True) -> list[int]:
        """Versions from a listing: committed ones have a ``_SUCCESS`` marker.

        A write that died leaves a folder without the marker; readers skip it and
        the next write takes a higher number.
        """
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            m = _VERSION.fullmatch(status.getPath().getName())
            if not (m and status.isDirectory()):
                continue
            if committed and not fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                continue
            found.append(int(m.group(1)))
        return sorted(found)

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed versions, and folders of writes that
        died before those. Returns the deleted version numbers.

        Run it between loads: a query still reading an old version would lose its files.
        """
        if keep < 1:
            raise ValueError("keep at least the current version")
        committed = self.versions()
        if not committed:
            return []
        cutoff = committed[-keep] if len(committed) >= keep else committed[0]
        doomed = [v for v in self.versions(committed=False) if v < cutoff]
        jvm = self.spark.sparkContext._jvm
        fs = jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(
            self.spark.sparkContext._jsc.hadoopConfiguration())
        for v in doomed:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._path(v)), True)
        return doomed

    def _path(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def current_path(self) -> str:
        vs = self.versions()
        if not vs:
            raise FileNotFoundError(f"table {self.root} has no version; create it first")
        return self._path(vs[-1])

    def exists(self) -> bool:
        return bool(self.versions())

    # ------------------------------------------------------------ reads
    def read(self) -> DataFrame:
        """The current version (files below it too: streamed batches live in subfolders)."""
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.current_path())

    def write_batch(self, df: DataFrame, name: str) -> int:
        """Write one batch into its own folder of the current version; returns rows written.

        A replayed batch (same name) overwrites its own folder instead of adding
        its rows twice; another stream's or run's batches have other names.
        """
        obs = Observation()
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{self.current_path()}/batch={name}")
        return int(obs.get["rows"])

    def batches(self) -> list[str]:
        """Names of the batches of the current version that are complete."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.current_path())
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith("batch=") and fs.exists(
                    jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(name.removeprefix("batch="))
        # rows that a replace published lie beside the batches; they count as one
        return [self.current_path().rsplit("/", 1)[1], *sorted(found)]

    def read_batches(self, names: list[str]) -> DataFrame:
        """Only the given batches."""
        beside = _VERSION.fullmatch(names[0]) if names else None
        parts = [f"{self.current_path()}/batch={n}" for n in names[bool(beside):]]
        out = self.read().limit(0)
        if parts:
            out = self.spark.read.option("recursiveFileLookup", "true").schema(self.schema).parquet(*parts)
        if beside:
            out = out.unionByName(self.read().where(~F.col("_metadata.file_path").contains("/batch=")))
        return out

    @property
    def schema(self) -> T.StructType:
        return self.read().schema

    # ------------------------------------------------------------ writes
    def create(self, schema: T.StructType) -> LayerTable:
        """K8: create or replace with declared columns and no rows."""
        self._write_version(self.spark.createDataFrame([], schema))
        return self

    def append(self, df: DataFrame, run_id: str | None = None) -> int:
        """K1: add rows to the current version, as a batch of their own; returns rows written.

        ``run_id``: the run that all of them belong to (see ``read_run``).
        """
        return self.write_batch(df, f"{run_mark(run_id) if run_id else ''}{uuid.uuid4().hex[:16]}")

    def replace(self, df: DataFrame) -> int:
        """K2/K3: publish ``df`` as the next version; returns rows written (K7)."""
        return self._write_version(df)

    def _write_version(self, df: DataFrame) -> int:
        vs = self.versions(committed=False)
        obs = Observation()
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(
            self._path((vs[-1] + 1) if vs else 1))
        return int(obs.get["rows"])


def run_mark(run_id: str) -> str:
    """How the folders of a run's batches begin."""
    return f"run-{hashlib.sha256(run_id.encode()).hexdigest()[:16]}-"


def read_run(table: LayerTable, run_id: str, column: str = ADDED_BY) -> DataFrame:
    """The rows that a run loaded; batch folders of other runs are not opened.

    Batches are partitions for this read, so Spark prunes their folders by name; in
    batches without a run's mark and in rows beside them (a replace), ``column`` decides.
    """
    spark, path, schema = table.spark, table.current_path(), table.schema
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = lambda glob: bool(len(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{glob}")) or ()))
    out = spark.createDataFrame([], schema)
    if exists("batch=*"):
        rows = (spark.read.schema(T.StructType([*schema, T.StructField("batch", T.StringType())]))
                .option("basePath", path).parquet(f"{path}/batch=*"))
        mine = F.col("batch").startswith(run_mark(run_id)) | ~F.col("batch").startswith("run-")
        out = rows.where(mine & (F.col(column) == run_id)).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    if exists("part-*"):
        out = out.unionByName(spark.read.schema(schema).parquet(f"{path}/part-*").where(F.col(column) == run_id))
    return out


class Lakehouse:
    """Tables by layer and name below one root (e.g. in the shared folder).

    ``partition_by``: partition columns of the tables (layer, name) that have them;
    upserts into those rewrite only the partitions that they touch.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: Mapping[tuple[str, str], Sequence[str]] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = {(a.lower(), b.lower()): tuple(c) for (a, b), c in (partition_by or {}).items()}

    def table(self, layer: str, name: str) -> LayerTable | PartitionedTable:
        path = f"{self.root}/{layer.lower()}/{name.lower()}"
        columns = self.partition_by.get((layer.lower(), name.lower()))
        return PartitionedTable(self.spark, path, columns) if columns else LayerTable(self.spark, path)

    def vacuum(self, keep: int = 2) -> dict[str, list[int]]:
        """``LayerTable.vacuum`` for every table of every layer below the root."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = {}
        if not fs.exists(root):
            return out
        for layer in fs.listStatus(root):
            if not layer.isDirectory() or layer.getPath().getName().startswith(("_", ".")):
                continue
            for t in fs.listStatus(layer.getPath()):
                if t.isDirectory() and not t.getPath().getName().startswith(("_", ".")):
                    name = f"{layer.getPath().getName()}/{t.getPath().getName()}"
                    out[name] = LayerTable(self.spark, f"{self.root}/{name}").vacuum(keep)
        return out


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
