from pyspark.sql import functions as F

from strata.operators.transform import conform
from strata.plans.yard_marts import dim_appointment_data, fact_sales
from strata.schemas import GOLD_FACT_SALES, SILVER_APPOINTMENT_DATA, SILVER_SALES_DATA_PRIOR_DAY


def _fill(spark, rows, cols, schema):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    have = set(cols)
    df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have])
    return conform(df, schema)


def test_first_key_per_yard_null_key_and_prices(spark):
    appts = _fill(spark, [("Y1", "S1", "C1"), ("Y1", "S2", "C2"), ("Y2", "S3", "C3")],
                  ["YARD_NAME", "SALES_ORDER_TICKET_ID", "CARRIER_NAME"], SILVER_APPOINTMENT_DATA)
    prices = ["1.5", "1,234.5", "", " 2 ", "$3", "1e3", None]
    sales = _fill(spark, [("10", "Y1" if i < 2 else ("Y9" if i == 2 else None), f"c{i}", p, p, p)
                          for i, p in enumerate(prices)],
                  ["YARD_ID", "YARD", "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL"],
                  SILVER_SALES_DATA_PRIOR_DAY)
    dim = dim_appointment_data(appts, run_id="r", now="2024-01-01 00:00:00")
    assert sorted((r.YARD_NAME, r.APPOINTMENT_DATA_KEY) for r in dim.collect()) == [("Y1", 1), ("Y1", 2), ("Y2", 3)]
    fact = fact_sales(sales, dim, run_id="r", now="2024-01-01 00:00:00")
    assert fact.schema.fieldNames() == GOLD_FACT_SALES.fieldNames()
    rows = fact.collect()
    # one row per sale: Y1 sales take Y1's first appointment key; Y9 and null yards get null
    assert len(rows) == 7
    assert sorted(r.SALES_KEY for r in rows) == list(range(1, 8))
    assert {r.APPOINTMENT_DATA_KEY for r in rows if r.COMMODITY_NAME in ("c0", "c1")} == {1}
    by_c = {}
    for r in rows:
        by_c.setdefault(r.COMMODITY_NAME, set()).add(r.PRICE)
    assert by_c == {"c0": {1.5}, "c1": {None}, "c2": {None}, "c3": {2.0}, "c4": {None}, "c5": {1000.0},
                    "c6": {None}}
    assert {r.APPOINTMENT_DATA_KEY for r in rows if r.COMMODITY_NAME in ("c2", "c3")} == {None}


def test_declared_tables(spark, workdir):
    from pyspark.sql import types as T

    from strata.plans.yard_marts import TABLES
    from strata.schemas import AUDIT_COLUMNS
    from strata.sources.tables import Lakehouse

    sizes = {name: len(schema.fields) for name, schema in TABLES.items()}
    assert sizes == {("bronze", "SALES_DATA_PRIOR_DAY"): 42, ("bronze", "APPOINTMENT_DATA"): 42,
                     ("silver", "SALES_DATA_PRIOR_DAY"): 44, ("silver", "APPOINTMENT_DATA"): 43,
                     ("gold", "DIM_APPOINTMENT_DATA"): 8, ("gold", "FACT_SALES"): 11}
    assert "CUSTOMER_NAME" not in TABLES[("silver", "APPOINTMENT_DATA")].fieldNames()
    for (layer, _), schema in TABLES.items():
        tail = tuple(schema.fieldNames()[-(2 if layer == "bronze" else 4):])
        assert tail == (AUDIT_COLUMNS[:2] if layer == "bronze" else AUDIT_COLUMNS)
    assert TABLES[("gold", "FACT_SALES")]["PRICE"].dataType == T.FloatType()
    lake = Lakehouse(spark, workdir)
    t = lake.table("gold", "FACT_SALES").create(TABLES[("gold", "FACT_SALES")])
    assert t.read().schema == TABLES[("gold", "FACT_SALES")] and t.read().count() == 0


def test_dimension_keeps_keys_across_runs(spark):
    appts1 = _fill(spark, [("Y1", "S1", "C1"), ("Y2", "S2", "C2")],
                   ["YARD_NAME", "SALES_ORDER_TICKET_ID", "CARRIER_NAME"], SILVER_APPOINTMENT_DATA)
    first = dim_appointment_data(appts1, run_id="r1", now="2024-01-01 00:00:00")
    appts2 = _fill(spark, [("Y0", "S0", "C0"), ("Y2", "S2", "C2"), ("Y1", "S1", "C1"), ("Y3", "S3", "C3")],
                   ["YARD_NAME", "SALES_ORDER_TICKET_ID", "CARRIER_NAME"], SILVER_APPOINTMENT_DATA)
    second = dim_appointment_data(appts2, run_id="r2", now="2024-01-02 00:00:00", existing=first)
    got = {r.YARD_NAME: r.APPOINTMENT_DATA_KEY for r in second.collect()}
    # Y1 and Y2 keep 1 and 2; new Y0 and Y3 follow the maximum, in yard order
    assert got == {"Y1": 1, "Y2": 2, "Y0": 3, "Y3": 4}
