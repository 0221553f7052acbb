"""Yard sales and appointments: declared tables and the two gold builders.

``dim_appointment_data`` keys appointments in yard order and is *not* unique
per yard. ``fact_sales`` gives each sale the smallest appointment key of its
yard: one row per sale, never one per (sale, appointment) pair, which would
grow with the square of a busy yard. Both orders get tie-break columns
appended so that keys are reproducible; the declared order columns come first. Measures arrive as text and become 32-bit floats; text
that is not a number becomes null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.operators.marts import DimensionLookup, build_dimension, build_fact
from strata.plans.jobs import GoldBuilder, LoadContext
from strata.schemas import (
    BRONZE_APPOINTMENT_DATA,
    BRONZE_SALES_DATA_PRIOR_DAY,
    GOLD_DIM_APPOINTMENT_DATA,
    GOLD_FACT_SALES,
    SILVER_APPOINTMENT_DATA,
    SILVER_SALES_DATA_PRIOR_DAY,
)

TABLES = {
    ("bronze", "SALES_DATA_PRIOR_DAY"): BRONZE_SALES_DATA_PRIOR_DAY,
    ("bronze", "APPOINTMENT_DATA"): BRONZE_APPOINTMENT_DATA,
    ("silver", "SALES_DATA_PRIOR_DAY"): SILVER_SALES_DATA_PRIOR_DAY,
    ("silver", "APPOINTMENT_DATA"): SILVER_APPOINTMENT_DATA,
    ("gold", "DIM_APPOINTMENT_DATA"): GOLD_DIM_APPOINTMENT_DATA,
    ("gold", "FACT_SALES"): GOLD_FACT_SALES,
}


DIM_NATURAL_KEY = ("YARD_NAME", "SALES_ORDER_ID", "CARRIER_NAME")


def dim_appointment_data(appointments: DataFrame, *, run_id: str, now=None,
                         unique_on: Sequence[str] | None = None,
                         existing: DataFrame | None = None, source_is_scan: bool = False) -> DataFrame:
    """Yard, sales order, carrier; key in yard order.

    With ``existing`` (the current gold dimension), known rows keep their key.
    ``source_is_scan``: as for ``build_dimension``.
    """
    return build_dimension(
        appointments,
        {"YARD_NAME": "YARD_NAME", "SALES_ORDER_TICKET_ID": "SALES_ORDER_ID", "CARRIER_NAME": "CARRIER_NAME"},
        key="APPOINTMENT_DATA_KEY", order_by=list(DIM_NATURAL_KEY),
        run_id=run_id, now=now, schema=GOLD_DIM_APPOINTMENT_DATA, unique_on=unique_on, source_is_scan=source_is_scan,
        existing=existing, natural_key=DIM_NATURAL_KEY if existing is not None else None)


def fact_sales(sales: DataFrame, dim: DataFrame, *, run_id: str, now=None, source_is_scan: bool = False) -> DataFrame:
    """Sales with the first appointment key of their yard (left join on YARD = YARD_NAME)."""
    return build_fact(
        sales, ["YARD_ID", "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL", "YARD"],
        [DimensionLookup(dim, fact_on="YARD", dim_on="YARD_NAME", key="APPOINTMENT_DATA_KEY")],
        key="SALES_KEY",
        order_by=["YARD_ID", "APPOINTMENT_DATA_KEY", "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL"],
        run_id=run_id, now=now, schema=GOLD_FACT_SALES, source_is_scan=source_is_scan)


def _dim(ctx: LoadContext) -> DataFrame:
    return dim_appointment_data(ctx.lake.table("silver", "APPOINTMENT_DATA").read(),
                                run_id=ctx.run_id, now=ctx.now,
                                existing=ctx.lake.table("gold", "DIM_APPOINTMENT_DATA").read(), source_is_scan=True)


def _fact(ctx: LoadContext) -> DataFrame:
    return fact_sales(ctx.lake.table("silver", "SALES_DATA_PRIOR_DAY").read(),
                      ctx.lake.table("gold", "DIM_APPOINTMENT_DATA").read(),
                      run_id=ctx.run_id, now=ctx.now, source_is_scan=True)


BUILDERS = (
    GoldBuilder("DIM_APPOINTMENT_DATA", _dim, "dimension", key="APPOINTMENT_DATA_KEY"),
    GoldBuilder("FACT_SALES", _fact, "fact", key="SALES_KEY"),
)
