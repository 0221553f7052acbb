"""Declared table schemas (K8) and audit column names.

A target table's schema decides what a load keeps and how it casts (P3/P4).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Audit column names, as declared in the layered tables.
ADDED_BY = "ADDED_BY"
ADDED_ON = "ADDED_ON"
MODIFIED_BY = "MODIFIED_BY"
MODIFIED_ON = "MODIFIED_ON"
AUDIT_COLUMNS = (ADDED_BY, ADDED_ON, MODIFIED_BY, MODIFIED_ON)


def is_audit(name: str) -> bool:
    return name.upper() in AUDIT_COLUMNS


def string_schema(names, *, audit: tuple[str, ...] = ()) -> T.StructType:
    """All-text data columns followed by the chosen audit columns."""
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    return T.StructType(fields + audit_fields(audit))


def audit_fields(audit: tuple[str, ...] = AUDIT_COLUMNS) -> list[T.StructField]:
    return [
        T.StructField(a, T.StringType() if a.endswith("_BY") else T.TimestampType(), True)
        for a in audit
    ]


def with_audit(schema: T.StructType, audit: tuple[str, ...] = AUDIT_COLUMNS) -> T.StructType:
    return T.StructType(list(schema.fields) + audit_fields(audit))


# Data columns of the two source objects (sales, appointments).
SALES_DATA_PRIOR_DAY_COLUMNS = (
    "YARD_ID", "YARD", "MATERIAL_NAME", "MATERIAL_CODE", "COMMODITY_NAME",
    "COMMODITY_TYPE", "OUTBOUND_TICKET_ID", "LATEST_SHIP_DATE", "LATEST_PAYMENT_DATE",
    "INVOICE_ISSUE_DATE", "INVOICE_STATUS", "INVOICE_NOTES", "CUSTOMER_NAME",
    "SALES_ORDER_ID", "OUTBOUND_TICKET_STATUS", "INVOICE_ID", "TAX_RATE",
    "CONSUMER_GROSS", "CONSUMER_TARE", "CONSUMER_NET_WEIGHT", "UM", "PRICE",
    "SELL_PRICE", "INVOICE_SUBTOTAL", "INVOICE_TOTAL", "INVOICE_FREIGHT_TOTAL",
    "AMOUNT_PAID", "PAYMENT_ADJUSTMENTS", "INVOICE_GRAND_TOTAL",
    "INVOICE_BALANCE_REMAINING", "COST_OF_GOODS_SOLD", "GROSS_MARGIN_DOLLAR",
    "MARGIN_PERCENTAGE", "NET_WEIGHT_SOLD", "WEIGHT_DIFFERENTIAL", "CURRENCY",
    "ACCOUNT_MANAGER", "CONVERTED_TOTAL", "IS_EXPORT", "MILL_SCALE_NUMBER",
)
APPOINTMENT_DATA_COLUMNS = (
    "YARD_NAME", "APPOINTMENT_NUMBER", "APPOINTMENT_TITLE", "REFERENCE_TYPE",
    "SALES_ORDER_TICKET_ID", "PURCHASE_ORDER_TICKET_ID", "INBOUND_TICKET_ID",
    "OUTBOUND_TICKET_ID", "CUSTOMER_ID", "CUSTOMER_NAME", "CARRIER_NAME",
    "DRIVER_NAME", "ORDER_FULFILLED", "APPOINTMENT_STATUS", "SCHEDULED_START",
    "SCHEDULED_END", "SHIPMENT_TYPE", "VESSEL", "SHIPPING_LINE_NAME",
    "FORWARDER_NVOCC", "ESTIMATED_TIME_OF_ARRIVAL", "ESTIMATED_TIME_OF_DEPARTURE",
    "EARLIEST_RETURN_DATE", "DOCUMENTATION_CUTOFF_DEADLINE", "CARGO_CUTOFF_DEADLINE",
    "EXPORT_REFERENCE_NUMBER", "CONTAINER_TYPE", "NUMBER_OF_CONTAINERS", "VOYAGE",
    "SCHEDULED_DURATION_HOURS", "APPOINTMENT_DATE", "DAY_OF_WEEK", "IS_FUTURE",
    "IS_ACTIVE", "CREATED_AT", "CREATED_BY", "CREATED_BY_EMAIL", "UPDATED_AT",
    "UPDATED_BY", "UPDATED_BY_EMAIL",
)

BRONZE_SALES_DATA_PRIOR_DAY = string_schema(
    SALES_DATA_PRIOR_DAY_COLUMNS, audit=(ADDED_BY, ADDED_ON))
BRONZE_APPOINTMENT_DATA = string_schema(
    APPOINTMENT_DATA_COLUMNS, audit=(ADDED_BY, ADDED_ON))
SILVER_SALES_DATA_PRIOR_DAY = string_schema(
    SALES_DATA_PRIOR_DAY_COLUMNS, audit=AUDIT_COLUMNS)
# the silver appointment table has no CUSTOMER_NAME
SILVER_APPOINTMENT_DATA = string_schema(
    [c for c in APPOINTMENT_DATA_COLUMNS if c != "CUSTOMER_NAME"], audit=AUDIT_COLUMNS)

GOLD_DIM_APPOINTMENT_DATA = T.StructType([
    T.StructField("APPOINTMENT_DATA_KEY", T.IntegerType()),
    T.StructField("YARD_NAME", T.StringType()),
    T.StructField("SALES_ORDER_ID", T.StringType()),
    T.StructField("CARRIER_NAME", T.StringType()),
    *audit_fields(),
])
GOLD_FACT_SALES = T.StructType([
    T.StructField("SALES_KEY", T.IntegerType()),
    T.StructField("YARD_ID", T.StringType()),
    T.StructField("APPOINTMENT_DATA_KEY", T.IntegerType()),
    T.StructField("COMMODITY_NAME", T.StringType()),
    T.StructField("PRICE", T.FloatType()),
    T.StructField("SELL_PRICE", T.FloatType()),
    T.StructField("INVOICE_TOTAL", T.FloatType()),
    *audit_fields(),
])

# Metadata tables; types are assumptions (only column names are known from use).
OBJECTS_CONFIGURATION = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "OBJECT_NAME", "SOURCE_NAME", "SOURCE_FILE_PATH", "SOURCE_FILE_NAME",
        "ARCHIVE_PATH", "BRONZE_TABLE_NAME", "SILVER_TABLE_NAME", "OPERATION_TYPE",
        "KEY_COLUMN_NAME")]
    + [T.StructField("IS_FULL_LOAD", T.IntegerType()), T.StructField("IS_RUN", T.IntegerType())]
)
OBJECTS_COLUMN_MAPPING = T.StructType([T.StructField(n, T.StringType()) for n in (
    "SOURCE_NAME", "OBJECT_NAME", "SOURCE_COLUMN_NAME", "TARGET_COLUMN_NAME",
    "COLUMN_DATATYPE", "VALUES")])
EDW_CONFIG = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "OBJECT_NAME", "OPERATION_TYPE", "GOLD_KEY_COLUMN_NAME", "GOLD_CATALOG_NAME",
        "GOLD_SCHEMA_NAME", "GOLD_COLUMN_NAMES")]
    + [T.StructField("IS_FULL_LOAD", T.IntegerType()), T.StructField("IS_RUN", T.IntegerType())]
)
PIPELINE_RUN_STATUS = T.StructType([
    T.StructField("PIPELINE_NAME", T.StringType()),
    T.StructField("IS_LAST_RUN_COMPLETED", T.BooleanType()),
])
PIPELINE_AUDIT_LOG = T.StructType([
    T.StructField("PIPELINE_NAME", T.StringType()),
    T.StructField("PIPELINE_RUN_ID", T.StringType()),
    T.StructField("PIPELINE_START_TIME", T.TimestampType()),
    T.StructField("PIPELINE_END_TIME", T.TimestampType()),
])
