"""CSV sources (S4, S5, S6) and the bronze load of a folder of files (G1).

One ``spark.read.csv(folder)`` takes the first file's header for every file, so
files whose columns come in another order are silently misread. Here the first
line of every file is read, and the folder is then scanned once, whatever the
number of layouts: Spark's CSV reader hands out values by position, and a join
on the file's path says which position holds which column in that file.

What is loaded. Loads go through subfolders (``recursive``). Spark's readers leave
out files and folders whose names start with ``_`` or ``.``; a load logs them, and
with ``hidden=True`` loads them as well. A ``glob`` is the caller's choice, and
``skipped_files`` says what it leaves out.

Malformed records. A record with more values than its header has names would
lose the rest without a trace. Such records go to a reject table, with their text,
file and header, or are counted in the log where a load has none. A record with
too few values is padded with nulls, as Spark's reader does; nothing is lost.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import normalize_names, resolve_column
from strata.operators.transform import conform, stamp_audit
from strata.schemas import ADDED_BY, ADDED_ON, AUDIT_COLUMNS
from strata.session import scratch_dir, stage

_LOG = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    infer_schema: bool = False,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """S4 (all columns text) or S5 (``infer_schema``): header row, comma separated."""
    reader = spark.read.option("header", True).option("inferSchema", infer_schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.csv(path)


def list_files(spark: SparkSession, path: str, *, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, length): every file of a folder (``recursive``: and of its subfolders); only the listing is read, not the content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("file"), "length")


def skipped_files(spark: SparkSession, path: str, glob: str | None, *, recursive: bool = False) -> DataFrame:
    """(file): files of a folder that ``glob`` leaves out."""
    every = list_files(spark, path, recursive=recursive).select("file")
    if glob is None:
        return every.limit(0)
    return every.join(list_files(spark, path, glob=glob, recursive=recursive).select("file"), "file", "left_anti")


#: names that Hadoop and Spark write themselves; never data
_OWN_NAMES = re.compile(r"_SUCCESS|_temporary|\..*\.crc|.*\._COPYING_|_spark_metadata|\.spark-staging.*")


def hidden_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below ``path`` that Spark's readers leave out: their name, or a folder's on the way, starts with ``_`` or ``.``.

    One listing per folder depth, by Hadoop's file system; only hidden names come here.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    base = fs.makeQualified(root).toString().rstrip("/")
    out, level = [], escape_path(base)
    while len(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/*")) or ()):
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/[._]*")) or ():
            if _OWN_NAMES.fullmatch(status.getPath().getName()):
                continue
            if status.isFile():
                out.append(status.getPath().toString())
                continue
            files = fs.listFiles(status.getPath(), True)
            while files.hasNext():
                f = files.next().getPath()
                if not _OWN_NAMES.fullmatch(f.getName()):
                    out.append(f.toString())
        level += "/*"
    return sorted(set(out))


def unhide(spark: SparkSession, files: Sequence[str], folder: str) -> str | None:
    """Copies of ``files`` below ``folder`` under names that Spark's readers take; None if there are none."""
    if not files:
        return None
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for i, name in enumerate(files):
        source, target = jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.hadoop.fs.Path(folder, f"{i:06d}-{name.rsplit('/', 1)[1]}")
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    return folder


def first_lines(files: DataFrame) -> DataFrame:
    """(file, header): the first non-empty line of each file.

    Local files are opened in executor tasks. Files of any other store are opened by
    Hadoop's file system, with the session's settings and credentials, from a pool of
    driver threads: only names and first lines pass through the driver, 10,000 at a time.
    """
    def run(batches):
        import io

        import pyarrow as pa
        from pyarrow import fs

        store = fs.LocalFileSystem()
        for b in batches:
            heads = []
            for name in b.column(0).to_pylist():
                # a plain path: a URI would have to escape spaces and brackets
                at = "/" + name.partition(":")[2].lstrip("/")
                with store.open_input_stream(at) as raw, io.TextIOWrapper(io.BufferedReader(raw), "utf-8-sig", "replace", newline=None) as text:
                    heads.append(next((line.rstrip("\r\n") for line in text if line.strip()), None))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(heads, pa.string())], names=["file", "header"])

    spark, schema = files.sparkSession, "file string, header string"
    local = F.col("file").startswith("file:")
    heads = files.select("file").where(local).mapInArrow(run, schema)
    others = (r["file"] for r in files.select("file").where(~local).toLocalIterator())
    path, some = None, list(islice(others, 10_000))
    while some:
        path = path or scratch_dir(spark, "first-lines")
        with ThreadPoolExecutor(16) as pool:
            found = list(pool.map(lambda f: (f, _hadoop_first_line(spark, f)), some))
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(path)
        some = list(islice(others, 10_000))
    if path:
        heads = heads.unionByName(spark.read.schema(schema).parquet(path))
    return heads.where(F.col("header").isNotNull())


def _hadoop_first_line(spark: SparkSession, name: str) -> str | None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(name)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    raw = path.getFileSystem(conf).open(path)
    try:
        text = jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, "UTF-8")
        reader = jvm.java.io.BufferedReader(text)
        line = reader.readLine()
        while line is not None and not line.lstrip("\ufeff").strip():
            line = reader.readLine()
        return None if line is None else line.lstrip("\ufeff")
    finally:
        raw.close()


def file_headers(spark: SparkSession, path: str, *, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, header): the first non-empty line of every file of a folder; empty files have none."""
    return first_lines(list_files(spark, path, glob=glob, recursive=recursive).repartition("file"))


def escape_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def header_names(spark: SparkSession, header: str, options: Mapping[str, str] | None = None) -> list[str]:
    """Column names of a header line, named as Spark's reader names blank and repeated ones."""
    reader = spark.read.option("header", True)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.csv(spark.sparkContext.parallelize([header], 1)).columns


def read_folder(
    spark: SparkSession,
    path: str,
    *,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    with_file: bool = False,
) -> list[DataFrame]:
    """The files of ``path``, names normalised (P1), as one DataFrame per layout.

    For loads into one schema, ``scan_layouts`` needs one scan in all; here each
    layout keeps its own columns: it reads the folder and keeps the rows of its own
    files by a join on the file's path. ``with_file`` adds the file's name as ``FILE_NAME``.
    """
    heads, _ = stage(file_headers(spark, path, glob=glob), "csv-headers")
    layouts = [r["header"] for r in heads.select("header").distinct().orderBy("header").collect()]
    if not layouts:
        raise FileNotFoundError(f"no files with a header {'matching ' + repr(glob) + ' ' if glob else ''}below {path}")
    out = []
    for header in layouts:
        names = header_names(spark, header, options)
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        reader = spark.read.schema(schema).option("header", True)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        rows = reader.csv(path)
        if len(layouts) > 1:
            rows = _of_files(rows, heads.where(F.col("header") == header))
        else:
            rows = rows.select("*", F.col("_metadata.file_name").alias(FILE_NAME))
        cols = [F.col(f"c{i}").alias(n) for i, n in enumerate(normalize_names(names))]
        out.append(rows.select(*cols, *([FILE_NAME] if with_file else [])))
    return out


#: column of ``read_folder`` that holds each row's file name
FILE_NAME = "__strata_file"


def plain_path(col):
    """A file's path without URI escapes or authority slashes, as ``list_files`` and metadata both give it."""
    return F.regexp_replace(col, "^file:/+", "file:/")


def _of_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the given files; Spark chooses how to join, a large file may be split."""
    # metadata paths are URL-encoded ("+" stands for itself there)
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    tagged = rows.select("*", plain_path(decoded).alias("__strata_path"), F.col("_metadata.file_name").alias(FILE_NAME))
    return tagged.join(files.select(plain_path(F.col("file")).alias("__strata_path")), "__strata_path", "left_semi").drop("__strata_path")


#: options of a reader that a load decides itself
_OWN_OPTIONS = ("header", "mode", "columnnameofcorruptrecord", "enforceschema", "recursivefilelookup", "pathglobfilter", "columnpruning")

#: columns of records that have too many values
REJECTS = T.StructType([T.StructField("FILE_NAME", T.StringType()), T.StructField("HEADER", T.StringType()),
                        T.StructField("VALUE_COUNT", T.IntegerType()), T.StructField("RECORD", T.StringType()),
                        T.StructField(ADDED_BY, T.StringType()), T.StructField(ADDED_ON, T.TimestampType())])
_RAW, _COUNT, _WIDTH, _HEADER = "__strata_raw", "__strata_count", "__strata_width", "__strata_header"


def _value_count(widths: Sequence[int], total: int, options: Mapping[str, str]) -> Column:
    """Number of values of a record read into ``total`` columns, more than any header (``widths``) has.

    Spark keeps the text of every record whose number of values is not that of the
    schema. Separators in it are counted, quoted values left out; where even all
    separators are too few for a surplus, they need no closer look. A value that
    stands beyond the header counts whatever the quotes say.
    """
    low = {k.lower(): v for k, v in options.items()}
    sep = low.get("sep", low.get("delimiter", ",")).replace("\\t", "\t")
    quote, escape = re.escape(low.get("quote", '"') or "\0"), re.escape(low.get("escape", "\\"))
    quoted = (f"(^|{re.escape(sep)}){quote}[^{quote}{escape}]*+(?:{escape}.[^{quote}{escape}]*+)*+{quote}"
              if quote != escape else f"(^|{re.escape(sep)}){quote}[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+{quote}")
    raw = F.col(_RAW)
    parts = lambda text: ((F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))) / len(sep) + 1).cast("int")
    seen = F.coalesce(*[F.when(F.col(f"c{i}").isNotNull(), i + 1) for i in range(total - 1, min(widths) - 1, -1)], F.col(_WIDTH))
    count = F.when(parts(raw) <= F.col(_WIDTH), F.col(_WIDTH)).otherwise(parts(F.regexp_replace(raw, "(?s)" + quoted, "$1")))
    return F.when(raw.isNull(), total).otherwise(F.greatest(seen, count)).cast("int")


def scan_layouts(
    spark: SparkSession,
    paths: str | list[str],
    heads: DataFrame,
    columns: Sequence[str],
    *,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One scan of files in any number of layouts: ``columns`` (text), file name, header, record and number of values.

    ``heads`` is ``file_headers`` of the same files. A row's position decides its
    column, under the header of its own file (names normalised, P1). A header
    without one of ``columns`` raises.
    """
    options = dict(options or {})
    layouts = {r["header"]: None for r in heads.select("header").distinct().orderBy("header").collect()}
    if not layouts:
        raise FileNotFoundError(f"no files with a header {'matching ' + repr(glob) + ' ' if glob else ''}in {paths}")
    rows_of = []
    for header in layouts:
        names = layouts[header] = normalize_names(header_names(spark, header, options))
        found = [resolve_column(names, c) for c in columns]
        missing = [c for c, f in zip(columns, found, strict=True) if f is None]
        if missing:
            raise ValueError(f"missing target column {missing} under header {header!r}")
        rows_of.append((header, [names.index(f) for f in found], len(names)))
    widths = [len(n) for n in layouts.values()]
    # two more than the widest: the text of a record with one value too many is kept as it is
    total = max(widths) + 2
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(total)] + [T.StructField(_RAW, T.StringType())])
    # a record is kept only by a parser that sees all of its values
    reader = (spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", _RAW)
              .option("columnPruning", False).option("recursiveFileLookup", recursive))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for k, v in options.items():
        if k.lower() not in _OWN_OPTIONS:
            reader = reader.option(k, v)
    rows = reader.csv(paths).select("*", F.col("_metadata.file_name").alias(FILE_NAME), F.col("_metadata.file_path").alias("__strata_path"))
    if len(layouts) == 1:
        (header, at, n), = rows_of
        rows = rows.withColumns({_HEADER: F.lit(header), _WIDTH: F.lit(n)})
        value = [F.col(f"c{i}") for i in at]
    else:
        table = spark.createDataFrame(rows_of, f"{_HEADER} string, __strata_at array<int>, {_WIDTH} int")     # a row per layout
        places = heads.select(plain_path(F.col("file")).alias("__strata_file_path"), F.col("header").alias(_HEADER)).join(table, _HEADER)
        # metadata paths are URL-encoded ("+" stands for itself there)
        decoded = F.url_decode(F.replace(F.col("__strata_path"), F.lit("+"), F.lit("%2B")))
        # by the planner's own size check; a large file is spread over many splits before the join
        rows = rows.join(places, plain_path(decoded) == F.col("__strata_file_path"))
        values = F.array(*[F.col(f"c{i}") for i in range(total)])
        value = [F.get(values, F.get("__strata_at", F.lit(j))) for j in range(len(columns))]
    record = F.coalesce(F.col(_RAW), F.to_csv(F.struct(*[F.col(f"c{i}") for i in range(total)])))
    return rows.select(*[v.alias(c) for v, c in zip(value, columns, strict=True)], FILE_NAME, _HEADER, _WIDTH,
                       _value_count(widths, total, options).alias(_COUNT), record.alias(_RAW))


def csv_parts(
    spark: SparkSession,
    paths: str | list[str],
    heads: DataFrame,
    schema: T.StructType,
    *,
    run_id: str,
    now=None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    file_column: str | None = None,
    recursive: bool = False,
) -> tuple[DataFrame, DataFrame, Column]:
    """Scanned rows under the names of ``schema``, rejects, and the condition that a scanned row is malformed.

    The first still holds every row, so that one pass may keep the others and count the malformed.
    """
    audit = tuple(c for c in AUDIT_COLUMNS if c in schema.fieldNames())
    wanted = [c for c in schema.fieldNames() if c not in audit and (file_column is None or c.lower() != file_column.lower())]
    rows = scan_layouts(spark, paths, heads, wanted, glob=glob, options=options, recursive=recursive)
    if file_column:
        rows = rows.withColumn(file_column, F.col(FILE_NAME))
    bad = F.col(_COUNT) > F.col(_WIDTH)
    rejects = stamp_audit(rows.where(bad).select(
        F.col(FILE_NAME).alias("FILE_NAME"), F.col(_HEADER).alias("HEADER"), F.col(_COUNT).alias("VALUE_COUNT"),
        F.col(_RAW).alias("RECORD")), run_id, now, (ADDED_BY, ADDED_ON))
    return stamp_audit(rows, run_id, now, audit), rejects, bad


def csv_to_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    run_id: str,
    now=None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    file_column: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """G1 without the write: read (S4/S6), normalise (P1), stamp (P2), conform.

    A file that lacks a target column fails the load, as loading it alone would.
    ``file_column`` names a column that receives each row's file name (kept if the
    schema has it). Malformed records are cut to their header, as Spark's reader does.
    """
    heads, _ = stage(file_headers(spark, path, glob=glob, recursive=recursive), "csv-headers")
    rows, _, _ = csv_parts(spark, path, heads, schema, run_id=run_id, now=now, glob=glob, options=options,
                           file_column=file_column, recursive=recursive)
    return conform(rows, schema)


def write_parts(rows: DataFrame, rejects: DataFrame, bad: Column, schema: T.StructType, write, write_rejects) -> int:
    """Write the good rows by ``write`` and count the malformed ones in that pass; these, if any, go to ``write_rejects``.

    Without ``write_rejects`` malformed rows are kept, cut to their header, and logged. Returns good rows written.
    """
    seen = Observation()
    counted = rows.observe(seen, F.count_if(bad).alias("bad"), F.count(F.lit(1)).alias("rows"))
    written = write(conform(counted if write_rejects is None else counted.where(~bad), schema))
    n = int(seen.get["bad"])
    if n and write_rejects is None:
        _LOG.warning("%d records have more values than their header; the surplus is lost", n)
    elif n:
        write_rejects(rejects)
        _LOG.warning("%d records have more values than their header; see the reject table", n)
    return written


def load_csv_folder(
    spark: SparkSession,
    path: str,
    table,
    *,
    run_id: str,
    now=None,
    glob: str | None = None,
    options: Mapping[str, str] | None = None,
    file_column: str | None = None,
    recursive: bool = True,
    hidden: bool = False,
    rejects=None,
) -> int:
    """G1: append a folder of CSV files, subfolders included, to a layer table; returns rows written.

    Files that ``glob`` leaves out are logged, and so are hidden ones unless
    ``hidden`` loads them. ``rejects`` (a layer table with columns ``REJECTS``)
    receives malformed records, which the table then does not.
    """
    if glob:
        skipped = skipped_files(spark, path, glob, recursive=recursive)
        n = skipped.count()
        if n:
            _LOG.warning("%d files below %s do not match %r, e.g. %s", n, path, glob, skipped.first()["file"])
    veiled = hidden_files(spark, path) if recursive or hidden else []
    if veiled and not hidden:
        _LOG.warning("%d files below %s have hidden names and are not loaded, e.g. %s", len(veiled), path, veiled[0])
    folders = [path, unhide(spark, veiled, scratch_dir(spark, "unhidden")) if hidden else None]
    reject = None if rejects is None else lambda rows: rejects.append(rows, run_id)
    written, empty = 0, True
    for folder in filter(None, folders):
        heads, n = stage(file_headers(spark, folder, glob=glob, recursive=recursive), "csv-headers")
        if n == 0 and (hidden and veiled):
            continue
        written += write_parts(*csv_parts(spark, folder, heads, table.schema, run_id=run_id, now=now, glob=glob, options=options,
                                          file_column=file_column, recursive=recursive), table.schema, lambda rows: table.append(rows, run_id), reject)
        empty = False
    if empty:
        raise FileNotFoundError(f"no files with a header below {path}")
    return written


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> str:
    """Write ``df`` as headed CSV files (used to drop test files into a folder)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path
