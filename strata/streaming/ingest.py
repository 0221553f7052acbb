"""K9: load each new CSV file exactly once, then archive it.

Re-aimed from "move the whole folder after the load": a file stream with
``trigger(availableNow=True)`` processes every file not yet recorded in its
checkpoint and stops; ``cleanSource="archive"`` moves files that earlier
batches committed into ``archive_dir``. Files of any name, suffix and age are loaded;
a file older than the newest one is not skipped (``maxFileAge``).

``ingest_into_table`` reads each file under its own header, so files in several layouts
load in one run. ``ingest_new_files``
is for folders of one declared layout and checks every file's header against it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.transform import conform, normalize_headers, stamp_audit
from strata.schemas import AUDIT_COLUMNS
from strata.session import scratch_dir
from strata.sources.csv import csv_parts, escape_path, first_lines, hidden_files, list_files, unhide, write_parts
from strata.sources.tables import LayerTable

#: the stream's age limit is switched off: a back-fill with old file times is loaded like any file
ANY_AGE = "36500d"


def _reader(spark: SparkSession, schema: T.StructType, glob: str | None, archive_dir: str | None):
    reader = spark.readStream.format("csv").schema(schema).option("header", True).option("maxFileAge", ANY_AGE)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    header: T.StructType,
    target_dir: str,
    checkpoint_dir: str,
    target_schema: T.StructType,
    *,
    run_id: str,
    now=None,
    archive_dir: str | None = None,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Run one incremental load of one layout; returns the last progress report of the query."""
    reader = _reader(spark, header, glob, archive_dir).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    audit = tuple(c for c in AUDIT_COLUMNS if c in target_schema.fieldNames())
    rows = conform(stamp_audit(normalize_headers(reader.load(source_dir)), run_id, now, audit),
                   target_schema)
    query = (rows.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start(target_dir))
    _finish(query)
    return query.lastProgress or {}


def stream_identity(spark: SparkSession, checkpoint_dir: str) -> str:
    """A name that lives and dies with a checkpoint: kept in a file inside it.

    Batch numbers start at 0 again under a new or lost checkpoint; with this name in
    the batch's folder they cannot meet the folders of the old one.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(checkpoint_dir, "strata-stream")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        with_name = spark.read.text(path.toString()).first()
        if with_name is not None:
            return with_name["value"]
    name = uuid.uuid4().hex[:16]
    out = fs.create(path, True)
    out.write(bytearray(f"{name}\n".encode()))
    out.close()
    return name


#: files of one micro-batch, at most; their names come to the driver
FILES_PER_BATCH = 10_000

#: batches after which the names of loaded files are written together
FILE_LOG_BATCHES = 32


def ingest_into_table(
    spark: SparkSession,
    source_dir: str,
    bronze: LayerTable,
    checkpoint_dir: str,
    *,
    run_id: str,
    now=None,
    archive_dir: str | None = None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    hidden: bool = False,
    rejects: LayerTable | None = None,
) -> int:
    """K9 into a layer table: new files only, each micro-batch written idempotently.

    Returns the number of rows written. The stream hands out file names, subfolders
    included (it reads no content, and rows of files with spaces in their names would
    come twice); the files of a micro-batch are scanned once, each under its own header.
    ``options`` go to the CSV reader. ``hidden`` loads files with hidden names too,
    which a stream does not see, as a batch of their own. ``rejects`` receives
    malformed records (see ``strata.sources.csv``).
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(source_dir)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    target = bronze.schema
    reader = (spark.readStream.format("binaryFile").option("maxFileAge", ANY_AGE).option("recursiveFileLookup", True)
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", FILES_PER_BATCH))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    name = stream_identity(spark, checkpoint_dir)
    # the files of earlier batches: after a restart a stream may hand out files again
    # whose names its own log has to escape
    done = LayerTable(spark, f"{checkpoint_dir}/strata-files")
    if not done.exists():
        done.create(T.StructType([T.StructField("file", T.StringType()), T.StructField("batch", T.StringType())]))
    elif len(done.batches()) > FILE_LOG_BATCHES:
        done.replace(done.read().distinct().coalesce(1))
        done.vacuum(1)
    written: list[int] = []

    def load_files(heads: DataFrame, known: list, label: str) -> None:
        """``heads``: (file, header) of files to read; ``known``: the names to remember."""
        paths = [escape_path(r["file"]) for r in heads.collect()]       # at most FILES_PER_BATCH
        if paths:
            written.append(write_parts(
                *csv_parts(spark, paths, heads, target, run_id=run_id, now=now, options=options), target,
                lambda rows: bronze.write_batch(rows, label),
                None if rejects is None else lambda rows: rejects.write_batch(rows, label)))
            done.write_batch(spark.createDataFrame([(f, label) for f in known], "file string, batch string"), label)

    def load(batch: DataFrame, batch_id: int) -> None:
        label = f"{name}-{batch_id:012d}"
        # a replayed batch may take its own files again
        before = done.read().where(F.col("batch") != label).select("file")
        files = batch.select(F.col("path").alias("file")).distinct().join(before, "file", "left_anti")
        found = first_lines(files.repartition("file")).collect()        # at most FILES_PER_BATCH rows
        load_files(spark.createDataFrame(found, "file string, header string"), [r["file"] for r in found], label)

    query = (reader.load(source_dir).select("path").writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    _finish(query)
    if hidden:
        seen = {r["file"] for r in done.read().select("file").collect()} if (names := hidden_files(spark, source_dir)) else set()
        names = [f for f in names if f not in seen]
        copies = unhide(spark, names, scratch_dir(spark, "unhidden"))
        if copies:
            label = f"{name}-hidden-{hashlib.sha256(chr(10).join(names).encode()).hexdigest()[:16]}"
            load_files(first_lines(list_files(spark, copies).repartition("file")), names, label)
    return sum(written)
