"""Gold builders: dimensions and facts with surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_column
from strata.operators.dedupe import dedupe_latest
from strata.operators.keys import assign_keys, dense_number
from strata.operators.transform import conform, select_as, stamp_audit


@dataclass(frozen=True)
class DimensionLookup:
    """How a fact row finds a dimension's surrogate key.

    ``dimension`` holds at least ``dim_on`` and ``key``. It need not be unique
    on ``dim_on``: a join value with several dimension rows gives its smallest
    key, so every fact row keeps exactly one row (never one per matching pair).
    """

    dimension: DataFrame
    fact_on: str
    dim_on: str
    key: str


def lookup_keys(fact: DataFrame, lookups: Sequence[DimensionLookup]) -> DataFrame:
    """J1+P9: left-join each dimension and keep all fact columns plus its key.

    The dimension is first reduced to one key per join value (a partial
    aggregate, so a hot value collapses map-side); the left join then cannot
    multiply fact rows. Join strategy is left to the planner: a small reduced
    dimension is broadcast, a larger one is shuffled (AQE may split skew).
    """
    out = fact
    for i, lk in enumerate(lookups):
        right = (lk.dimension.groupBy(qcol(lk.dim_on).alias(f"__on_{i}"))
                 .agg(F.min(qcol(lk.key)).alias(lk.key)))
        out = out.join(right, out[lk.fact_on] == right[f"__on_{i}"], "left").drop(f"__on_{i}")
    return out


def _finish(df: DataFrame, key: str, schema: T.StructType | None, *, safe: bool = False) -> DataFrame:
    """Conform to the schema; the surrogate key is cast strictly (overflow raises).

    ``safe``: other values that do not fit their type become null instead of raising.
    """
    if schema is None:
        return df
    name = resolve_column(schema.fieldNames(), key)
    if name is not None:
        df = df.withColumn(key, F.col(key).cast(schema[name].dataType))
    return conform(df, schema, safe=safe)


def build_dimension(
    source: DataFrame,
    attributes: Mapping[str, str] | Sequence[str],
    key: str,
    order_by: Sequence[str],
    *,
    run_id: str,
    now=None,
    schema: T.StructType | None = None,
    unique_on: Sequence[str] | None = None,
    source_is_scan: bool = False,
    existing: DataFrame | None = None,
    natural_key: Sequence[str] | None = None,
) -> DataFrame:
    """Project attributes, number them in ``order_by``, stamp audit, conform.

    ``unique_on`` keeps one row per value (the greatest by ``order_by``, then by the
    other columns); by default the rows are kept as they come, one per source row (a
    fact lookup then takes the smallest key per value). With ``existing`` (the current
    dimension) and ``natural_key`` there is one row per natural key, entities already
    there keep their key and new ones are numbered from its maximum + 1 (D11), so
    repeated runs neither grow the dimension nor move a key. ``source_is_scan`` tells
    the numbering that ``source`` gives the same rows when it is computed again (a
    table read, and what exact operators make of it): no row is staged then.
    """
    dim = select_as(source, attributes)
    if unique_on:
        dim = dedupe_latest(dim, unique_on, order_by)
    if existing is not None:
        # Entities already in the current dimension keep their key
        if not natural_key:
            raise ValueError("existing keys need a natural_key to match entities")
        dim = dedupe_latest(dim, natural_key, order_by)
        known = existing.select(*[qcol(c) for c in natural_key], qcol(key))
        dim = assign_keys(dim, known, natural_key, key, order_by, deterministic_input=source_is_scan)
    else:
        low = {c.lower() for c in order_by}
        dim = dense_number(dim, order_by, key, deterministic_input=source_is_scan,
                           total_order=bool(unique_on) and {c.lower() for c in unique_on} <= low)
    return _finish(stamp_audit(dim, run_id, now), key, schema)


def build_fact(
    source: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    lookups: Sequence[DimensionLookup],
    key: str,
    order_by: Sequence[str],
    *,
    run_id: str,
    now=None,
    schema: T.StructType | None = None,
    existing: DataFrame | None = None,
    natural_key: Sequence[str] | None = None,
    source_is_scan: bool = False,
) -> DataFrame:
    """Project, look up dimension keys, number in ``order_by``, stamp, conform.

    With a schema, measures are cast with ``try_cast``: text that is not a
    number becomes null instead of failing the load. With ``existing`` (the current
    fact) and ``natural_key``, facts already there keep their key (D11); a natural
    key that repeats in the source raises, since no row may be lost here.
    """
    fact = lookup_keys(select_as(source, columns), lookups)
    if existing is not None:
        if not natural_key:
            raise ValueError("existing keys need a natural_key to match facts")
        known = existing.select(*[qcol(c) for c in natural_key], qcol(key))
        fact = assign_keys(fact, known, natural_key, key, order_by, deterministic_input=source_is_scan)
    else:
        fact = dense_number(fact, order_by, key, deterministic_input=source_is_scan)
    return _finish(stamp_audit(fact, run_id, now), key, schema, safe=True)
