"""Layouts, subfolders, hidden names, other stores and malformed records of CSV loads."""

import os

import pytest
from pyspark.sql import types as T

from strata.session import stage
from strata.sources.csv import (REJECTS, csv_to_bronze, file_headers, hidden_files, list_files, load_csv_folder, scan_layouts)
from strata.sources.tables import LayerTable
from strata.streaming.ingest import ingest_into_table

TARGET = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.StringType())])


def _put(folder, files):
    for name, text in files.items():
        path = os.path.join(folder.removeprefix("file:"), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def _rows(t):
    return sorted((tuple(r) for r in t.read().collect()), key=repr)


def test_twenty_layouts_are_one_scan(spark, workdir):
    names = ["A", "B", *(f"x{i}" for i in range(20))]
    files, want = {}, []
    for i in range(20):
        head = names[i % 5:] + names[:i % 5] if i < 5 else names[2:i] + ["B", "A"]
        files[f"f{i}.csv"] = ",".join(head) + "\n" + "".join(",".join(f"{h}-{i}-{k}" for h in head) + "\n" for k in range(3))
        want += [(f"A-{i}-{k}", f"B-{i}-{k}") for k in range(3)]
    _put(workdir, files)
    df = csv_to_bronze(spark, workdir, TARGET, run_id="r")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert sorted(map(tuple, df.collect())) == sorted(want)
    assert file_headers(spark, workdir).select("header").distinct().count() >= 19


def test_value_counts_of_quoted_and_odd_records(spark, workdir):
    lines = {"1,2": 2, '"a,b",c': 2, '"a,b",c,d': 3, '"x\\"y,z",1': 2, '"x\\"y,z",1,2,3': 4, "1": 2, ',,"",': 4, "1,2,,": 4, 'a"b,c"d,e': 3, '"a,b","c,d","e,f"': 3}
    _put(workdir, {"a.csv": "A,B\n" + "\n".join(lines) + "\n"})
    heads, _ = stage(file_headers(spark, workdir))
    got = {r["__strata_raw"]: r["__strata_count"] for r in scan_layouts(spark, workdir, heads, ["A", "B"]).collect()}
    # a record that fits its header, or is shorter, counts as the header's width
    assert {k: v for k, v in got.items() if v != 4} == {k: max(v, 2) for k, v in lines.items() if v != 4}
    # with as many values as the scan has columns, the text is put together again
    assert sum(v == 4 for v in got.values()) == sum(v == 4 for v in lines.values())


def test_rejects_plain_and_incremental(spark, workdir):
    _put(f"{workdir}/in", {"a.csv": "A,B\n1,2\n2,3,4\n5\n", "sub/b.csv": "B;A\n", "sub/c.csv": "B,A,C\nb,a,c\nb,a,c,d\n"})
    for how in ("plain", "step"):
        t, bad = LayerTable(spark, f"{workdir}/{how}").create(TARGET), LayerTable(spark, f"{workdir}/{how}-bad").create(REJECTS)
        _put(f"{workdir}/in", {"sub/b.csv": ""})
        if how == "plain":
            assert load_csv_folder(spark, f"{workdir}/in", t, run_id="r", rejects=bad) == 3
        else:
            assert ingest_into_table(spark, f"{workdir}/in", t, f"{workdir}/ck", run_id="r", rejects=bad) == 3
        assert _rows(t) == [("1", "2"), ("5", None), ("a", "b")]
        assert sorted((r.FILE_NAME, r.VALUE_COUNT, r.RECORD) for r in bad.read().collect()) == [("a.csv", 3, "2,3,4"), ("c.csv", 4, "b,a,c,d")]
    # without a reject table the records are cut, as Spark's reader does
    kept = LayerTable(spark, f"{workdir}/kept").create(TARGET)
    assert load_csv_folder(spark, f"{workdir}/in", kept, run_id="r") == 5


def test_hidden_names(spark, workdir, caplog):
    _put(f"{workdir}/in", {"f1.csv": "A,B\n1,1\n", "sub/f2.csv": "B,A\n2,2\n", "_x.csv": "A,B\n3,3\n", "sub/deep/.y.csv": "A,B\n4,4\n",
                           "_dir/sub/z.csv": "A,B\n5,5\n", "_SUCCESS": "", ".f1.csv.crc": "A,B\nno,no\n"})
    assert [f.rsplit("/", 1)[1] for f in hidden_files(spark, f"{workdir}/in")] == ["z.csv", "_x.csv", ".y.csv"]
    t = LayerTable(spark, f"{workdir}/t").create(TARGET)
    assert load_csv_folder(spark, f"{workdir}/in", t, run_id="r") == 2
    assert "3 files" in caplog.text and "hidden" in caplog.text
    assert load_csv_folder(spark, f"{workdir}/in", t, run_id="r", hidden=True) == 5
    step = LayerTable(spark, f"{workdir}/step").create(TARGET)
    kw = dict(run_id="r", hidden=True)
    assert ingest_into_table(spark, f"{workdir}/in", step, f"{workdir}/ck", **kw) == 5
    assert ingest_into_table(spark, f"{workdir}/in", step, f"{workdir}/ck", **kw) == 0
    _put(f"{workdir}/in", {"sub/_n.csv": "A,B\n6,6\n"})
    assert ingest_into_table(spark, f"{workdir}/in", step, f"{workdir}/ck", **kw) == 1
    assert [r[0] for r in _rows(step)] == ["1", "2", "3", "4", "5", "6"]
    _put(f"{workdir}/none", {"_SUCCESS": "", "a.csv": ""})
    with pytest.raises(FileNotFoundError):
        load_csv_folder(spark, f"{workdir}/none", t, run_id="r", hidden=True)


def test_a_store_that_only_hadoop_opens(spark, workdir):
    """First lines of a store that Arrow cannot open are read by Hadoop's file system."""
    _put(f"{workdir}/in", {"a b.csv": "﻿\nB,A\n2,1\n", "sub/c.csv": "A,B\n3,4\n", "sub/empty.csv": ""})
    import gzip

    with gzip.open(f"{workdir.removeprefix('file:')}/in/sub/d.csv.gz", "wt") as f:
        f.write("B,A\n6,5\n")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.strata.link./drop", f"file:{workdir.removeprefix('file:')}/in")
    try:
        path = "viewfs://strata/drop"
        assert list_files(spark, path, recursive=True).count() >= 3
        t = LayerTable(spark, f"{workdir}/t").create(TARGET)
        assert load_csv_folder(spark, path, t, run_id="r") == 3
        assert _rows(t) == [("1", "2"), ("3", "4"), ("5", "6")]
        step = LayerTable(spark, f"{workdir}/step").create(TARGET)
        assert ingest_into_table(spark, path, step, f"{workdir}/ck", run_id="r") == 3
        assert _rows(step) == _rows(t)
    finally:
        conf.unset("fs.viewfs.mounttable.strata.link./drop")


def test_options_of_incremental_loads_and_file_log(spark, workdir, monkeypatch):
    monkeypatch.setattr("strata.streaming.ingest.FILE_LOG_BATCHES", 2)
    t = LayerTable(spark, f"{workdir}/t").create(TARGET)
    for i in range(5):
        _put(f"{workdir}/in", {f"f{i}.csv": f"A;B\n{i};\"x\ny\"\n"})
        assert ingest_into_table(spark, f"{workdir}/in", t, f"{workdir}/ck", run_id="r", options={"sep": ";", "multiLine": "true"}) == 1
    assert _rows(t) == [(str(i), "x\ny") for i in range(5)]
    log = LayerTable(spark, f"{workdir}/ck/strata-files")
    assert len(log.batches()) <= 4 and log.read().select("file").distinct().count() == 5 and len(log.versions(committed=False)) == 1
