"""The command-line run of all layers with the yard sales preset, from parquet config tables."""

from pyspark.sql import functions as F

from strata.cli import main
from strata.schemas import (
    APPOINTMENT_DATA_COLUMNS, EDW_CONFIG, OBJECTS_COLUMN_MAPPING, OBJECTS_CONFIGURATION,
    SALES_DATA_PRIOR_DAY_COLUMNS,
)
from strata.sources.csv import write_csv
from strata.sources.tables import Lakehouse


def _human(name):  # "YARD_ID" -> "Yard Id": the header rule must turn it back
    return name.replace("_", " ").title()


def test_cli_runs_all_layers(spark, workdir):
    src = f"{workdir}/landing"
    appts = spark.createDataFrame(
        [("Y1", "A1", "S1", "C1"), ("Y1", "A2", "S2", "C2"), ("Y2", "A3", "S3", "C3")],
        "YARD_NAME string, APPOINTMENT_NUMBER string, SALES_ORDER_TICKET_ID string, CARRIER_NAME string")
    appts = appts.select(*[(F.col(c) if c in appts.columns else F.lit(None).cast("string")).alias(_human(c))
                           for c in APPOINTMENT_DATA_COLUMNS])
    write_csv(appts, f"{src}/appointments")
    sales = spark.createDataFrame(
        [("10", "Y1", "steel", "SO1", "I1", "1.5", "2", "3"), ("11", "Y2", "copper", "SO2", "I2", "1,000", "x", "4"),
         ("12", "Y9", "iron", "SO3", "I3", "5", "6", "7")],
        "YARD_ID string, YARD string, COMMODITY_NAME string, SALES_ORDER_ID string, INVOICE_ID string, "
        "PRICE string, SELL_PRICE string, INVOICE_TOTAL string")
    sales = sales.select(*[(F.col(c) if c in sales.columns else F.lit(None).cast("string")).alias(_human(c))
                           for c in SALES_DATA_PRIOR_DAY_COLUMNS])
    write_csv(sales, f"{src}/sales")

    cfg = f"{workdir}/cfg"
    spark.createDataFrame([
        ("SALES_DATA_PRIOR_DAY", "erp", "sales", "Sales", "done", "SALES_DATA_PRIOR_DAY", "SALES_DATA_PRIOR_DAY",
         "upsert", "SALES_ORDER_ID, INVOICE_ID", 0, 1),
        ("APPOINTMENT_DATA", "erp", "appointments", "Appt", "done", "APPOINTMENT_DATA", "APPOINTMENT_DATA",
         "upsert", "APPOINTMENT_NUMBER", 1, 1)], OBJECTS_CONFIGURATION).write.parquet(f"{cfg}/objects")
    rows = [("erp", "SALES_DATA_PRIOR_DAY", c, c, "string", None) for c in SALES_DATA_PRIOR_DAY_COLUMNS]
    rows += [("erp", "APPOINTMENT_DATA", c, c, "string", None) for c in APPOINTMENT_DATA_COLUMNS]
    spark.createDataFrame(rows, OBJECTS_COLUMN_MAPPING).write.parquet(f"{cfg}/mapping")
    spark.createDataFrame([
        ("FACT_SALES", "upsert", "SALES_KEY", "gold", "edw", "", 1, 1),
        ("DIM_APPOINTMENT_DATA", "upsert", "APPOINTMENT_DATA_KEY", "gold", "edw", "", 1, 1)],
        EDW_CONFIG).write.parquet(f"{cfg}/edw")

    state = main(["--lake", f"{workdir}/lake", "--source-root", src, "--run-id", "run-42",
                  "--objects", f"{cfg}/objects", "--mapping", f"{cfg}/mapping", "--edw", f"{cfg}/edw",
                  "--tables", "strata.plans.yard_marts:TABLES",
                  "--builders", "strata.plans.yard_marts:BUILDERS", "--keep-versions", "1"], spark=spark)
    assert state == "completed"
    lake = Lakehouse(spark, f"{workdir}/lake")
    fact = lake.table("gold", "FACT_SALES").read()
    got = sorted((r.YARD_ID, r.APPOINTMENT_DATA_KEY, r.PRICE, r.SELL_PRICE) for r in fact.collect())
    # Y1 has two appointments (keys 1, 2): its sale takes the first; Y9 has none: null key
    assert got == [("10", 1, 1.5, 2.0), ("11", 3, None, None), ("12", None, 5.0, 6.0)]
    assert {r.ADDED_BY for r in fact.collect()} == {"run-42"}
    assert lake.table("control", "audit").read().count() == 1
    assert lake.table("gold", "FACT_SALES").versions() == [2]  # the empty created version is vacuumed
