import pytest
from pyspark.sql import types as T

from strata.plans.control import ControlTables, gated_run
from strata.sources.csv import csv_to_bronze, file_headers, load_csv_folder, read_folder, write_csv
from strata.sources.tables import LayerTable

TARGET = T.StructType([
    T.StructField("YARD_ID", T.StringType()), T.StructField("PRICE", T.DoubleType()),
    T.StructField("C3", T.StringType()), T.StructField("ADDED_BY", T.StringType()),
    T.StructField("ADDED_ON", T.TimestampType())])


def _write_text(spark, path, lines):
    # one text file per call, through Spark's writer (suffix .csv via the glob rename below)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_mixed_layouts_quotes_blank_header_and_glob(spark, workdir):
    folder = f"{workdir}/in"
    write_csv(spark.createDataFrame([("y1", "1.5", "q,1")], "`Yard ID` string, `Price ($)` string, `` string"),
              folder)
    write_csv(spark.createDataFrame([("2e3", "z", "y2")], "`Price ($)` string, `` string, `yard-id` string"),
              folder, mode="append")
    _write_text(spark, f"{folder}/notes", ["this is not csv"])  # part-*.txt: skipped by the glob
    hdr = file_headers(spark, folder).collect()
    assert {h.header for h in hdr} == {'Yard ID,Price ($),""', 'Price ($),"",yard-id'}
    assert all(h.file.endswith(".csv") for h in hdr)
    parts = read_folder(spark, folder)
    assert sorted(tuple(p.columns) for p in parts) == [("PRICE", "C1", "YARD_ID"), ("YARD_ID", "PRICE", "C2")]
    target = T.StructType([TARGET["YARD_ID"], TARGET["PRICE"], TARGET["ADDED_BY"], TARGET["ADDED_ON"]])
    got = sorted((r.YARD_ID, r.PRICE) for r in csv_to_bronze(spark, folder, target, run_id="r").collect())
    assert got == [("y1", 1.5), ("y2", 2000.0)]


def test_missing_target_column_raises(spark, workdir):
    write_csv(spark.createDataFrame([("a",)], "`Yard ID` string"), f"{workdir}/m")
    with pytest.raises(ValueError, match="missing"):
        csv_to_bronze(spark, f"{workdir}/m", TARGET, run_id="r")


def test_header_collision_raises(spark, workdir):
    write_csv(spark.createDataFrame([("a", "b")], "`Yard ID` string, `Yard-ID` string"), f"{workdir}/c")
    with pytest.raises(ValueError, match="collide"):
        read_folder(spark, f"{workdir}/c")


def test_gate(spark, workdir):
    c = ControlTables(LayerTable(spark, f"{workdir}/s"), LayerTable(spark, f"{workdir}/a")).create()
    with pytest.raises(KeyError):
        c.last_run_completed("p")
    c.register("p", True)
    ran = []
    assert gated_run(c, "p", "r1", lambda: ran.append(1)) == "completed"
    with pytest.raises(RuntimeError):
        gated_run(c, "p", "r2", lambda: (_ for _ in ()).throw(RuntimeError("boom")))
    assert c.last_run_completed("p") is False
    assert gated_run(c, "p", "r3", lambda: ran.append(3)) == "skipped"
    c.reset("p")
    assert gated_run(c, "p", "r4", lambda: ran.append(4)) == "completed"
    assert ran == [1, 4]
    assert [r.PIPELINE_RUN_ID for r in c.audit.read().orderBy("PIPELINE_START_TIME").collect()] == ["r1", "r4"]
    assert c.status.read().count() == 1


def test_file_name_lineage(spark, workdir):
    write_csv(spark.createDataFrame([("a", "1")], "`Yard ID` string, `Price` string"), f"{workdir}/f")
    schema = T.StructType([T.StructField("YARD_ID", T.StringType()), T.StructField("SOURCE_FILE", T.StringType())])
    rows = csv_to_bronze(spark, f"{workdir}/f", schema, run_id="r", file_column="SOURCE_FILE").collect()
    assert len(rows) == 1 and rows[0].SOURCE_FILE.startswith("part-") and rows[0].SOURCE_FILE.endswith(".csv")


def test_layouts_and_odd_names(spark, workdir):
    from strata.queries.rerun import drop_files
    from strata.sources.csv import skipped_files

    target = T.StructType([T.StructField("YARD_ID", T.StringType()), T.StructField("PRICE", T.DoubleType())])
    folder = f"{workdir}/odd"
    drop_files(spark, spark.createDataFrame([("y1", "1.5")], "`Yard.ID` string, `Price` string").coalesce(1), folder, "Sales Day {i}.csv")
    drop_files(spark, spark.createDataFrame([("2", "y2")], "`Price` string, `Yard.ID` string").coalesce(1), folder, "Sales [{i}].CSV")
    drop_files(spark, spark.createDataFrame([("y3", "3", "e")], "`Yard.ID` string, `Price` string, `Extra` string").coalesce(1), folder, "S{x}%20+{i}")
    t = LayerTable(spark, f"{workdir}/odd_t").create(target)
    assert load_csv_folder(spark, folder, t, run_id="r") == 3
    assert sorted((r.YARD_ID, r.PRICE) for r in t.read().collect()) == [("y1", 1.5), ("y2", 2.0), ("y3", 3.0)]
    assert t.versions() == [1]
    assert load_csv_folder(spark, folder, t, run_id="r", glob="*.csv") == 1
    assert skipped_files(spark, folder, "*.csv").count() == 2
    bad = f"{workdir}/bad"
    write_csv(spark.createDataFrame([("y1", "cheap")], "`Yard.ID` string, `Price` string"), bad)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_csv_folder(spark, bad, t, run_id="r")
