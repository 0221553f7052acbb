"""Deduplication on keys (A2).

``dedupe_latest`` is an aggregate, not a window: each map task first keeps one
row per key (partial aggregation), so a key holding a third of all rows is
collapsed before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_column, resolve_columns
from strata.schemas import ADDED_ON

_ROW = "__strata_row"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType | T.VariantType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (ADDED_ON,),
) -> DataFrame:
    """A2: one row per key: the greatest ``order_by`` (newest first).

    Ties are broken by the remaining columns in table order, greatest first,
    so the survivor is fully defined. Null keys form one group, as in
    ``dropDuplicates``.
    """
    keys = resolve_columns(df.columns, keys, "key column")
    order = [c for c in resolve_columns(df.columns, order_by, "order column") if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.select(*[qcol(k) for k in keys]).distinct()
    rank = [c for c in order + rest if _orderable(df.schema[c].dataType)]
    value = F.struct(*[qcol(c) for c in order + rest])
    if rank == order + rest:
        best = F.max(value)
    else:
        best = F.max_by(value, F.struct(*[qcol(c) for c in rank]))
    out = df.groupBy(*[qcol(k) for k in keys]).agg(best.alias(_ROW))
    return out.select(*[qcol(c) if c in keys else F.col(_ROW).getField(c).alias(c) for c in df.columns])


_HELD = "__strata_held"


def newer_rows(
    new: DataFrame,
    held: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (ADDED_ON,),
) -> DataFrame:
    """Rows of ``new`` (one per key) that beat every row of ``held`` with their key, by the order of ``dedupe_latest``.

    One aggregate over both sides; a row that equals a held one does not beat it.
    Of ``held``, only rows whose key is in ``new`` reach the aggregate (null keys
    are one key). A column that ``held`` lacks counts as null there.
    """
    held = held.select(*[(qcol(h) if h else F.lit(None)).cast(new.schema[c].dataType).alias(c)
                         for c, h in ((c, resolve_column(held.columns, c)) for c in new.columns)])
    keys = resolve_columns(new.columns, keys, "key column")
    mine = new.select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = [qcol(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    both = (held.join(mine, same, "left_semi").withColumn(_HELD, F.lit(True))
            .unionByName(new.withColumn(_HELD, F.lit(False))))
    # the flag is the last column to decide: of equal rows, the held one stays
    return dedupe_latest(both, keys, order_by).where(~F.col(_HELD)).drop(_HELD)
