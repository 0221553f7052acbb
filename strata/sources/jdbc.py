"""Database sources (S1, S2): config and metadata tables over JDBC.

Connection options (url, user, password, driver) come from the caller, never
from code. A ``dbtable`` read lets Catalyst push later filters and column
selections into the database; a ``query`` read runs the given SQL there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A whole table; ``.where``/``.select`` on the result are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **dict(options or {})).load()


def read_query(spark: SparkSession, url: str, query: str,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """The result of a query that runs in the database."""
    return spark.read.format("jdbc").options(url=url, query=query, **dict(options or {})).load()
