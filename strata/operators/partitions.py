"""Upsert of the partitions that a source touches (K4, K5), instead of the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.names import qcol, resolve_column, resolve_columns
from strata.operators.upsert import upsert
from strata.session import stage
from strata.sources.partitioned import PartitionedTable, in_partitions


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Partitions (columns ``names``) that an upsert changes: those that source rows name and those that hold a matched row.

    A matched row may move to another partition, so both count. Where the keys
    hold all partition columns, a match is in the partition that the source names
    and the target is not read; else its keys and partition columns are, in a semi
    join with the source.
    """
    tkeys = resolve_columns(target.columns, keys, "target key")
    skeys = resolve_columns(source.columns, keys, "source key")
    types = {f.name: f.dataType for f in target.schema.fields}
    at = {n: resolve_column(source.columns, n) for n in names}
    named = source.select(*[(qcol(at[n]) if at[n] else F.lit(None)).cast(types[n]).alias(n) for n in names]).distinct()
    if set(names) <= set(tkeys):
        return named
    s = source.select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(skeys)])
    t = target.select(*[qcol(k).alias(f"__t{i}") for i, k in enumerate(tkeys)], *[qcol(n) for n in names])
    held = t.join(s, [F.col(f"__t{i}") == F.col(f"__k{i}") for i in range(len(tkeys))], "left_semi")
    return named.unionByName(held.select(*[qcol(n) for n in names]).distinct()).distinct()


def upsert_partitions(table: PartitionedTable, source: DataFrame, keys: Sequence[str], *, run_id: str, now=None,
                      update_columns: Sequence[str] | None = None, check: bool = True, null_keys: str = "insert",
                      counts: Observation | None = None) -> int:
    """K4/K5 on a partitioned table: ``upsert`` over the touched partitions; the others' files stay. Returns rows written.

    Null-key target rows count as held only in the partitions that the source names.
    """
    source, _ = stage(source, "upsert-source")      # read for the partitions, the match and the insert
    target = table.read()
    names = resolve_columns(target.columns, table.partition_by, "partition column")
    old = target.where(in_partitions(target, names, touched_partitions(target, source, keys, names)))
    new = upsert(old, source, keys, run_id=run_id, now=now, update_columns=update_columns, check=check,
                 null_keys=null_keys, counts=counts)
    return table.overwrite(new, old)
