"""Tables with declared partition columns (K4, K5 on touched partitions).

The folder is Spark's own partition layout (``data/YEAR=1998/part-...``), read
with the declared schema, so filters on partition columns prune folders. A load
replaces only the partitions that it touches:

1. their new contents are written below ``_pending`` (nothing reads them yet), and
   then the names of the partitions that they replace;
2. Spark's dynamic partition overwrite copies them into ``data``;
3. replaced partitions without new rows are deleted, and the pending folder too.

A load that dies in step 1 leaves the table as it was. One that dies later is
finished by the next read or load: steps 2 and 3 may be done again any number of
times, since the pending contents do not change. Loads of one table must not
overlap (the run gate), and a query still reading a replaced partition fails, as
its files are gone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_columns

#: types whose folder name gives the value back
PARTITION_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


class PartitionedTable:
    """One table in Spark's partition layout; ``partition_by`` names its partition columns."""

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str]):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), tuple(partition_by)

    def __repr__(self) -> str:
        return f"PartitionedTable({self.root!r}, {self.partition_by!r})"

    # ------------------------------------------------------------ folders
    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("data").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs().exists(self._path("_schema/_SUCCESS"))

    def create(self, schema: T.StructType) -> PartitionedTable:
        """K8: create or replace with declared columns and no rows."""
        for c in resolve_columns(schema.fieldNames(), self.partition_by, "partition column"):
            if not isinstance(schema[c].dataType, PARTITION_TYPES):
                raise ValueError(f"partition column {c} has type {schema[c].dataType.simpleString()}")
        fs = self._fs()
        for name in ("_pending", "data"):
            fs.delete(self._path(name), True)
        fs.mkdirs(self._path("data"))
        self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/_schema")
        return self

    @property
    def schema(self) -> T.StructType:
        if not self.exists():
            raise FileNotFoundError(f"table {self.root} has no schema; create it first")
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}/_schema").first()[0]))

    # ------------------------------------------------------------ reads
    def read(self) -> DataFrame:
        """All rows, columns in declared order; filters on partition columns prune folders."""
        schema = self.schema
        self.recover()
        return self._rows("data", schema).select(*[qcol(c) for c in schema.fieldNames()])

    def _rows(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    # ------------------------------------------------------------ writes
    def replace(self, df: DataFrame) -> int:
        """K2/K3: ``df`` becomes the whole contents; returns rows written (K7)."""
        return self.overwrite(df, self.read())

    def append(self, df: DataFrame) -> int:
        """K1: add rows; returns rows written."""
        return self.overwrite(df, None)

    def overwrite(self, new: DataFrame, old: DataFrame | None) -> int:
        """Replace the partitions that hold rows of ``old`` (rows of this table), and those of ``new``, by ``new``.

        ``old=None`` adds the rows of ``new`` and replaces nothing.
        """
        schema, fs = self.schema, self._fs()
        names = resolve_columns(schema.fieldNames(), self.partition_by, "partition column")
        # an empty text would come back as null: refuse it instead
        checked = [F.when(qcol(c) == "", F.raise_error(F.lit(f"empty text in partition column {c}"))).otherwise(qcol(c)).alias(c)
                   if c in names and isinstance(schema[c].dataType, T.StringType) else qcol(c) for c in schema.fieldNames()]
        rows = new.select(*checked)
        obs = Observation()
        # AQE splits large partitions over tasks and joins small ones
        rows = rows.hint("rebalance", *names).observe(obs, F.count(F.lit(1)).alias("rows"))
        if old is None:
            rows.write.mode("append").partitionBy(*names).parquet(f"{self.root}/data")
            return int(obs.get["rows"])
        pending = f"_pending/{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy(*names).parquet(f"{self.root}/{pending}/data")
        written = int(obs.get["rows"])
        old.select(_folder("data").alias("value")).distinct().write.text(f"{self.root}/{pending}/old")
        self._publish(pending, schema, names, fs)
        return written

    def _publish(self, pending: str, schema: T.StructType, names: list[str], fs) -> None:
        staged = self._rows(f"{pending}/data", schema)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(f"{self.root}/data")
        old = self.spark.read.text(f"{self.root}/{pending}/old").select("value")
        for row in old.subtract(staged.select(_folder("data").alias("value"))).collect():     # one row per emptied partition
            uri = self.spark.sparkContext._jvm.java.net.URI(f"{self._path('data').toUri().toString()}/{row['value']}")
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri), True)
        fs.delete(self._path(pending), True)

    def recover(self) -> None:
        """Finish a load that died while it published; drop one that died before."""
        fs = self._fs()
        if not fs.exists(self._path("_pending")):
            return
        schema = self.schema
        for status in fs.listStatus(self._path("_pending")):
            name = f"_pending/{status.getPath().getName()}"
            if fs.exists(self._path(f"{name}/old/_SUCCESS")):
                self._publish(name, schema, resolve_columns(schema.fieldNames(), self.partition_by, "partition column"), fs)
            else:
                fs.delete(self._path(name), True)


def _folder(base: str) -> Column:
    """The partition folder of a row's file, as it is below ``base`` (URI-escaped)."""
    return F.regexp_extract(F.col("_metadata.file_path"), rf"/{base}/(?!.*/{base}/)(.*)/[^/]*$", 1)


def in_partitions(df: DataFrame, names: Sequence[str], values: DataFrame) -> Column:
    """Condition on partition columns only: the row's partition is one of ``values`` (one row per partition).

    The values come to the driver, as the partition folders do when Spark lists
    them; the condition prunes folders before any file is read.
    """
    key = F.to_json(F.struct(*[qcol(n) for n in names]))
    return key.isin([r[0] for r in values.select(key).distinct().collect()])
