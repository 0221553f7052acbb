"""Metadata: column mappings (P11, P12), gold column lists (P13), config joins.

Config tables are small; where a job needs them as Python values they are
collected once per object (never per column), with ``select(a, b).collect()``
so pairs cannot get misaligned.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.names import split_list
from strata.operators.transform import active, iequals
from strata.schemas import AUDIT_COLUMNS, is_audit

# Fixed value: a gold column that is never updated by a merge.
PROTECTED_GOLD_COLUMNS = ("ACCOUNT_KEY",)


@dataclass(frozen=True)
class ColumnMapping:
    """The mapping rows of one (source, object): rename, default, type per column."""

    source_name: str
    object_name: str
    rows: tuple = field(default=())

    @property
    def renames(self) -> list[tuple[str, str]]:
        return [(r["SOURCE_COLUMN_NAME"], r["TARGET_COLUMN_NAME"]) for r in self.rows
                if r["SOURCE_COLUMN_NAME"] and r["TARGET_COLUMN_NAME"]]

    @property
    def defaults(self) -> dict[str, str]:
        """P6 input: target column -> default text, rows whose VALUES is not null."""
        return {r["TARGET_COLUMN_NAME"]: r["VALUES"] for r in self.rows if r["VALUES"] is not None}

    @property
    def types(self) -> dict[str, str]:
        """P7 input: target column -> Spark type name."""
        return {r["TARGET_COLUMN_NAME"]: r["COLUMN_DATATYPE"] for r in self.rows if r["COLUMN_DATATYPE"]}

    def merge_columns(self, skip: Iterable[str] = AUDIT_COLUMNS) -> list[str]:
        """Distinct target columns, sorted, without audit columns (compared case-insensitively)."""
        skip_l = {s.lower() for s in skip}
        cols = sorted({r["TARGET_COLUMN_NAME"] for r in self.rows if r["TARGET_COLUMN_NAME"]})
        cols = [c for c in cols if c.lower() not in skip_l]
        if not cols:
            raise ValueError(f"no mapped columns for {self.source_name} -> {self.object_name}")
        return cols


def mapping_rows(mapping: DataFrame, source_name: str, object_name: str) -> DataFrame:
    """mapping rows of one source and object, names compared case-insensitively."""
    return mapping.where(iequals("SOURCE_NAME", source_name) & iequals("OBJECT_NAME", object_name))


def load_mapping(mapping: DataFrame, source_name: str, object_name: str) -> ColumnMapping:
    """Collect one object's mapping once; raise if it has none."""
    rows = mapping_rows(mapping, source_name, object_name).select(
        "SOURCE_COLUMN_NAME", "TARGET_COLUMN_NAME", "COLUMN_DATATYPE", "VALUES").collect()
    if not rows:
        raise ValueError(f"no mappings found for {source_name} -> {object_name}")
    return ColumnMapping(source_name, object_name, tuple(r.asDict() for r in rows))


def merge_columns_table(mapping: DataFrame, source_name: str, objects: DataFrame) -> DataFrame:
    """P12 for many objects at once: (OBJECT_NAME, TARGET_COLUMN_NAME) of active objects.

    Filters (F4, F5), a join on the upper-cased object name, ``distinct`` (A1)
    and a sort (O1), all in Spark.
    """
    act = active(objects).select(F.upper("OBJECT_NAME").alias("OBJECT_NAME")).distinct()
    rows = (mapping.where(iequals("SOURCE_NAME", source_name))
            .where(~F.upper("TARGET_COLUMN_NAME").isin(*AUDIT_COLUMNS))
            .select(F.upper("OBJECT_NAME").alias("OBJECT_NAME"), "TARGET_COLUMN_NAME"))
    return rows.join(act, "OBJECT_NAME").distinct().orderBy("OBJECT_NAME", "TARGET_COLUMN_NAME")


def gold_update_columns(columns: Iterable[str], keys: Iterable[str], surrogate: str | None = None) -> list[str]:
    """Columns a gold merge updates: not audit, not a key, not protected, never the surrogate key."""
    keys_l = {k.lower() for k in [*keys, *([surrogate] if surrogate else [])]}
    prot = {p.lower() for p in PROTECTED_GOLD_COLUMNS}
    return [c for c in columns if not is_audit(c) and c.lower() not in keys_l and c.lower() not in prot]


def gold_columns_table(edw_config: DataFrame) -> DataFrame:
    """P13 for every object: (OBJECT_NAME, POSITION, COLUMN_NAME, IS_UPDATED).

    The first list per object is a ``min`` aggregate, so a hot object name is
    reduced map-side; lists are split with ``posexplode``.
    """
    top = edw_config.groupBy("OBJECT_NAME", "GOLD_KEY_COLUMN_NAME").agg(
        F.min("GOLD_COLUMN_NAMES").alias("COLS"))
    items = (top.select("OBJECT_NAME", "GOLD_KEY_COLUMN_NAME",
                        F.posexplode(F.split("COLS", ",")).alias("POSITION", "COLUMN_NAME"))
             .withColumn("COLUMN_NAME", F.trim("COLUMN_NAME"))
             .where(F.col("COLUMN_NAME") != ""))
    keys = F.transform(F.split("GOLD_KEY_COLUMN_NAME", ","), lambda k: F.upper(F.trim(k)))
    upd = (~F.upper("COLUMN_NAME").isin(*AUDIT_COLUMNS)
           & ~F.upper("COLUMN_NAME").isin(*PROTECTED_GOLD_COLUMNS)
           & ~F.array_contains(keys, F.upper("COLUMN_NAME")))
    return items.select("OBJECT_NAME", F.col("POSITION").cast("long").alias("POSITION"),
                        "COLUMN_NAME", upd.alias("IS_UPDATED"))


def gold_config_with_paths(edw_config: DataFrame, objects: DataFrame) -> DataFrame:
    """Active gold config rows with the source and archive paths of their object."""
    e = active(edw_config).alias("e")
    o = objects.select(F.col("BRONZE_TABLE_NAME"), F.col("SOURCE_FILE_PATH"), F.col("ARCHIVE_PATH")).alias("o")
    return (e.join(o, F.col("e.OBJECT_NAME") == F.col("o.BRONZE_TABLE_NAME"), "inner")
            .select("e.*", "o.SOURCE_FILE_PATH", "o.ARCHIVE_PATH"))
