"""Run all layers under the run gate from config tables (the master run, G7).

    python -m strata.cli --lake <root> --source-root <root> --run-id <id> \\
        --objects <path> --mapping <path> --edw <path> \\
        --tables strata.plans.yard_marts:TABLES --builders strata.plans.yard_marts:BUILDERS

Config tables are parquet or headed CSV paths, or database tables with
``--config-format jdbc`` (``--jdbc-url`` and a JSON file of connection options
such as user, password and driver; nothing is stored in code).
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from strata.plans.control import ControlTables
from strata.plans.jobs import LayerConfig, LoadContext, create_tables, run_layers
from strata.schemas import EDW_CONFIG, OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION
from strata.operators.transform import conform, normalize_headers
from strata.sources.csv import read_csv
from strata.sources.jdbc import read_table
from strata.sources.tables import Lakehouse


def _load(ref: str):
    module, _, attr = ref.partition(":")
    return getattr(importlib.import_module(module), attr)


def read_config(spark: SparkSession, where: str, fmt: str, schema, jdbc_url: str | None = None,
                jdbc_options: dict | None = None) -> DataFrame:
    """A config table from parquet, headed CSV (typed by ``schema``) or a database table."""
    if fmt == "parquet":
        return spark.read.parquet(where)
    if fmt == "csv":
        # by header name, in any column order; then typed
        return conform(normalize_headers(read_csv(spark, where)), schema)
    if fmt == "jdbc":
        if not jdbc_url:
            raise ValueError("--jdbc-url is required with --config-format jdbc")
        return read_table(spark, jdbc_url, where, jdbc_options)
    raise ValueError(f"unknown config format {fmt!r}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n")[0])
    p.add_argument("--lake", required=True)
    p.add_argument("--source-root", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--pipeline", default="layers")
    p.add_argument("--objects", required=True)
    p.add_argument("--mapping", required=True)
    p.add_argument("--edw", required=True)
    p.add_argument("--tables", required=True, help="module:attr of {(layer, name): StructType}")
    p.add_argument("--builders", required=True, help="module:attr of a sequence of GoldBuilder")
    p.add_argument("--config-format", choices=("parquet", "csv", "jdbc"), default="parquet")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-options", help="JSON file with connection options")
    p.add_argument("--incremental", action="store_true", help="load only new files, then archive them")
    p.add_argument("--whole-silver", action="store_true",
                   help="silver upserts read all of bronze, not only the batches not consumed yet")
    p.add_argument("--workers", type=int, default=4)
    p.add_argument("--keep-versions", type=int, default=0,
                   help="after a completed run, keep only this many versions per table (0: keep all)")
    a = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"strata-{a.pipeline}").getOrCreate()
    opts = json.load(open(a.jdbc_options)) if a.jdbc_options else None
    cfg = {k: read_config(spark, getattr(a, k), a.config_format, s, a.jdbc_url, opts)
           for k, s in (("objects", OBJECTS_CONFIGURATION), ("mapping", OBJECTS_COLUMN_MAPPING),
                        ("edw", EDW_CONFIG))}
    lake = Lakehouse(spark, a.lake)
    create_tables(lake, _load(a.tables))
    control = ControlTables(lake.table("control", "status"), lake.table("control", "audit"))
    if not control.status.exists():
        control.create()
        control.register(a.pipeline, True)
    ctx = LoadContext(spark, lake, a.source_root, a.run_id, workers=a.workers)
    layers = LayerConfig(cfg["objects"], cfg["mapping"], cfg["edw"], _load(a.builders))
    state = run_layers(ctx, layers, control, a.pipeline, incremental=a.incremental,
                       incremental_silver=not a.whole_silver)
    if state == "completed" and a.keep_versions > 0:
        lake.vacuum(a.keep_versions)
    print(json.dumps({"pipeline": a.pipeline, "run_id": a.run_id, "state": state}))
    return state


if __name__ == "__main__":
    main(sys.argv[1:])
