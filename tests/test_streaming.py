from pyspark.sql import types as T

from strata.sources.csv import write_csv
from strata.sources.tables import LayerTable
from strata.streaming.ingest import ingest_into_table

TARGET = T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.StringType()),
                       T.StructField("ADDED_BY", T.StringType())])


def _files(spark, path):
    try:
        return [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .load(path).select("path").collect()]
    except Exception:  # noqa: BLE001
        return []


def test_each_file_once_then_archived(spark, workdir):
    src, arch, ckpt = f"{workdir}/in", f"{workdir}/arch", f"{workdir}/ckpt"
    t = LayerTable(spark, f"{workdir}/t").create(TARGET)
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").coalesce(1), src)
    assert ingest_into_table(spark, src, t, ckpt, run_id="r1", archive_dir=arch) == 2
    write_csv(spark.createDataFrame([(3, "c")], "k long, v string").coalesce(1), src, mode="append")
    assert ingest_into_table(spark, src, t, ckpt, run_id="r2", archive_dir=arch) == 1
    assert ingest_into_table(spark, src, t, ckpt, run_id="r3", archive_dir=arch) == 0
    assert sorted((r.K, r.ADDED_BY) for r in t.read().collect()) == [(1, "r1"), (2, "r1"), (3, "r2")]
    # files committed by earlier batches were moved below the archive folder
    assert any(str(f.path).endswith(".csv") for f in _files(spark, arch))


def test_two_layouts_wait_together(spark, workdir):
    src = f"{workdir}/in2"
    t = LayerTable(spark, f"{workdir}/t2").create(TARGET)
    write_csv(spark.createDataFrame([(1, "a")], "k long, v string").coalesce(1), src)
    write_csv(spark.createDataFrame([("b", 2)], "v string, k long").coalesce(1), src, mode="append")
    assert ingest_into_table(spark, src, t, f"{workdir}/ckpt2", run_id="r") == 2
    assert sorted((r.K, r.V) for r in t.read().collect()) == [(1, "a"), (2, "b")]


def test_new_checkpoint_does_not_overwrite(spark, workdir):
    t = LayerTable(spark, f"{workdir}/t3").create(TARGET)
    for i in (1, 2):
        write_csv(spark.createDataFrame([(i, "a")], "k long, v string").coalesce(1), f"{workdir}/in3-{i}")
        assert ingest_into_table(spark, f"{workdir}/in3-{i}", t, f"{workdir}/ckpt3-{i}", run_id="r") == 1
    assert sorted(r.K for r in t.read().collect()) == [1, 2]
