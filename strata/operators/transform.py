"""Column operators (P2-P11) and filters.

Each operator is one projection or one filter, so a chain of them collapses
into a single whole-stage-codegen span and filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import normalize_names, qcol, resolve_column, resolve_columns
from strata.functions.values import as_timestamp
from strata.schemas import ADDED_BY, ADDED_ON, AUDIT_COLUMNS, MODIFIED_BY, MODIFIED_ON


# ---------------------------------------------------------------- P1
def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column by the header rule; raise on collisions."""
    return df.toDF(*normalize_names(df.columns))


# ---------------------------------------------------------------- P2
def stamp_audit(
    df: DataFrame,
    run_id: str,
    now=None,
    columns: Sequence[str] = AUDIT_COLUMNS,
) -> DataFrame:
    """Set audit columns to the run id and one timestamp (equal across rows)."""
    ts = as_timestamp(now)
    values = {ADDED_BY: F.lit(run_id), ADDED_ON: ts, MODIFIED_BY: F.lit(run_id), MODIFIED_ON: ts}
    return df.withColumns({c: values[c] for c in columns})


# ---------------------------------------------------------------- P3 / P4
def conform(df: DataFrame, schema: T.StructType, *, safe: bool = False) -> DataFrame:
    """P3+P4: one select that orders, casts and keeps exactly the target columns.

    Extra columns are dropped; a missing target column raises. A value that does not
    fit its type raises too (ANSI cast), for replace and merge alike; only ``safe``
    (fact measures) uses ``try_cast``, which makes it null.
    """
    names = resolve_columns(df.columns, schema.fieldNames(), "target column")
    out = []
    for actual, field in zip(names, schema.fields):
        c = qcol(actual)
        if df.schema[actual].dataType != field.dataType:
            c = c.try_cast(field.dataType) if safe else c.cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


# ---------------------------------------------------------------- P5 / P10
def rename_columns(df: DataFrame, mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """P5: rename by a mapping in one projection (simultaneous, so swaps work).

    Pairs whose source is absent or equal to the target are skipped; a
    pre-existing column that carries a new name is dropped (P10) unless it is
    itself renamed away.
    """
    pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    rename: dict[str, str] = {}
    for src, tgt in pairs:
        actual = resolve_column(df.columns, src)
        if actual is None or actual == tgt:
            continue
        if actual in rename and rename[actual].lower() != tgt.lower():
            raise ValueError(f"column {actual!r} mapped to both {rename[actual]!r} and {tgt!r}")
        rename[actual] = tgt
    targets: dict[str, str] = {}
    for src, tgt in rename.items():
        if tgt.lower() in targets:
            raise ValueError(f"columns {targets[tgt.lower()]!r} and {src!r} both renamed to {tgt!r}")
        targets[tgt.lower()] = src
    out = []
    for c in df.columns:
        if c in rename:
            out.append(qcol(c).alias(rename[c]))
        elif c.lower() in targets and targets[c.lower()] != c:
            continue  # replaced by a renamed column
        else:
            out.append(qcol(c))
    return df.select(*out)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P10: drop columns (case-insensitive, absent names ignored)."""
    return df.drop(*[qcol(c) for c in (resolve_column(df.columns, n) for n in names) if c])


# ---------------------------------------------------------------- P6
def fill_nulls(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Replace nulls by per-column defaults, all in one projection.

    A default is text from config; it is cast to the column's type, so ``'7'``
    fills an integer column with 7 and an unusable default raises.
    """
    fills = {}
    for name, value in defaults.items():
        actual = resolve_column(df.columns, name)
        if actual is None or value is None:
            continue
        fills[actual] = F.lit(value).cast(df.schema[actual].dataType)
    if not fills:
        return df
    return df.select(*[
        F.coalesce(qcol(c), fills[c]).alias(c) if c in fills else qcol(c) for c in df.columns
    ])


# ---------------------------------------------------------------- P7
def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], *, safe: bool = True) -> DataFrame:
    """Cast columns to type names from config (any Spark DDL type string)."""
    casts = {}
    for name, type_name in types.items():
        actual = resolve_column(df.columns, name)
        if actual is not None and type_name:
            casts[actual] = type_name
    if not casts:
        return df
    # a cast to the column's own type is removed by the optimizer
    return df.select(*[
        (qcol(c).try_cast(casts[c]) if safe else qcol(c).cast(casts[c])).alias(c)
        if c in casts else qcol(c)
        for c in df.columns
    ])


CAST_ERRORS = "CAST_ERRORS"


def cast_with_errors(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """P7, and in the same pass ``CAST_ERRORS``: (column, value, type) of every value that the cast makes null.

    A value that was null before is no error. The errors are of the columns in
    ``types`` that ``df`` has, in their order; a row without any has an empty array.
    """
    named = {resolve_column(df.columns, n): n for n, t in types.items() if t}
    errors = []
    for actual in (c for c in named if c is not None):
        type_ = types[named[actual]]
        text = type_ if isinstance(type_, str) else type_.simpleString()
        errors.append(F.when(
            qcol(actual).isNotNull() & qcol(actual).try_cast(type_).isNull(),
            F.struct(F.lit(actual).alias("column"), qcol(actual).cast("string").alias("value"), F.lit(text).alias("type"))))
    none = F.array().cast("array<struct<column:string,value:string,type:string>>")
    found = F.array_compact(F.array(*errors)) if errors else none
    marked = df.withColumn(CAST_ERRORS, found)
    return cast_columns(marked, {n: types[n] for a, n in named.items() if a is not None})


# ---------------------------------------------------------------- P8 / P9
def select_as(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select fixed columns, optionally aliased ``{source: alias}``."""
    if isinstance(columns, Mapping):
        return df.select(*[qcol(s).alias(a) for s, a in columns.items()])
    return df.select(*[qcol(c) for c in columns])


# ---------------------------------------------------------------- F1-F5
def equals(column: str, value) -> Column:
    """F1."""
    return F.col(column) == F.lit(value)


def not_null(column: str) -> Column:
    """F2."""
    return F.col(column).isNotNull()


def iequals(column: str, value: str) -> Column:
    """case-insensitive equality against a constant."""
    return F.lower(F.col(column)) == F.lit(value.lower())


def active(df: DataFrame, flag: str = "IS_RUN") -> DataFrame:
    """rows whose run flag is 1."""
    return df.where(F.col(flag) == 1)


def rows_of_run(df: DataFrame, run_id: str) -> DataFrame:
    """Rows a run loaded (filter on ADDED_BY, pushed to the scan)."""
    return df.where(F.col(ADDED_BY) == F.lit(run_id))
