"""Shared fixtures of the driver queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN_ID = "run-0001"
RUN_ID_2 = "run-0002"
NOW = "2024-01-01 00:00:00"
NOW_2 = "2024-02-01 12:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def audit_sql(added_by: str = RUN_ID, added_on: str = NOW,
              modified_by: str | None = None, modified_on: str | None = None) -> str:
    """Audit columns as DuckDB literals."""
    mb = modified_by or added_by
    mo = modified_on or added_on
    return (f"'{added_by}' AS ADDED_BY, TIMESTAMP '{added_on}' AS ADDED_ON, "
            f"'{mb}' AS MODIFIED_BY, TIMESTAMP '{mo}' AS MODIFIED_ON")
