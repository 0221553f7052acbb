"""Layer jobs driven by config tables.

Config rows are few and are collected; each object's work is one Spark plan
(read, transform, write) and runs distributed.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_column, split_list
from strata.operators.dedupe import dedupe_latest, newer_rows
from strata.operators.partitions import upsert_partitions
from strata.operators.transform import CAST_ERRORS, active, cast_columns, cast_with_errors, fill_nulls, rename_columns, stamp_audit
from strata.operators.upsert import ROW_KINDS, load_mode, replace, upsert
from strata.plans.config import ColumnMapping, gold_update_columns, load_mapping
from strata.plans.control import ControlTables, gated_run
from strata.schemas import ADDED_BY, ADDED_ON
from strata.session import owned_scratch, stage
from strata.sources.csv import REJECTS, load_csv_folder
from strata.sources.partitioned import PartitionedTable
from strata.sources.tables import Lakehouse, LayerTable
from strata.streaming.ingest import ingest_into_table

_LOG = logging.getLogger(__name__)


@dataclass
class LoadContext:
    """What every job needs: where tables live, the run id and its timestamp."""

    spark: SparkSession
    lake: Lakehouse
    source_root: str
    run_id: str
    now: object = None
    glob: str | None = None  # a filter is the caller's choice; by default every file is loaded
    workers: int = 4  # independent objects whose jobs may run side by side
    csv_options: Mapping[str, str] | None = None  # options of Spark's CSV reader, for every file
    hidden_files: bool = False  # load files whose names start with "_" or "." too


def _each(items: Iterable, fn: Callable, workers: int) -> list:
    """Run ``fn`` on independent objects; their Spark jobs may run side by side.

    The first failure is raised (after the running ones finish).
    """
    items = list(items)
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        return list(pool.map(fn, items))


def _each_target(rows: Sequence, target: str, fn: Callable, workers: int) -> dict[str, int]:
    """Run ``fn`` on config rows: rows with one target table in order, different targets side by side.

    Two loads of one table at a time would both build on the same version. Returns rows
    written per target, added up.
    """
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault(r[target].lower(), []).append(r)

    def in_order(group: list) -> tuple[str, int]:
        done = [fn(r) for r in group]
        return done[0][0], sum(n for _, n in done)

    return dict(_each(groups.values(), in_order, workers))


# ------------------------------------------------------------------ bronze
def bronze_object(ctx: LoadContext, source_dir: str, bronze: LayerTable) -> int:
    """G1: load every file of one object folder into its bronze table (append)."""
    return load_csv_folder(ctx.spark, source_dir, bronze, run_id=ctx.run_id, now=ctx.now, glob=ctx.glob,
                           options=ctx.csv_options, hidden=ctx.hidden_files, rejects=reject_table(ctx, bronze))


def reject_table(ctx: LoadContext, bronze: LayerTable) -> LayerTable:
    """Malformed records of a bronze table's files."""
    table = ctx.lake.table("bronze_rejects", bronze.root.rsplit("/", 1)[1])
    return table if table.exists() else table.create(REJECTS)


def run_bronze(ctx: LoadContext, objects: DataFrame, *, active_only: bool = False,
               incremental: bool = False) -> dict[str, int]:
    """Every configured object (all rows, as the reference, unless ``active_only``).

    ``incremental`` loads only files not loaded before (K9) and archives loaded
    files below ``<source root>/<ARCHIVE_PATH>/archive``; the stream's progress is
    kept below the lake root.
    """
    cfg = active(objects) if active_only else objects
    root = ctx.source_root.rstrip("/")

    def one(row) -> tuple[str, int]:
        with owned_scratch(ctx.spark):
            return load(row)

    def load(row) -> tuple[str, int]:
        name = row["BRONZE_TABLE_NAME"]
        folder = f"{root}/{row['SOURCE_FILE_PATH'].strip('/')}"
        table = ctx.lake.table("bronze", name)
        if not incremental:
            return name, bronze_object(ctx, folder, table)
        sub = (row["ARCHIVE_PATH"] or "").strip("/")
        archive = f"{root}/{sub}/archive" if sub else f"{root}/archive"
        return name, ingest_into_table(
            ctx.spark, folder, table, f"{ctx.lake.root}/_ingest/{name.lower()}",
            run_id=ctx.run_id, now=ctx.now, archive_dir=archive, glob=ctx.glob,
            options=ctx.csv_options, hidden=ctx.hidden_files, rejects=reject_table(ctx, table))

    rows = cfg.select("BRONZE_TABLE_NAME", "SOURCE_FILE_PATH", "ARCHIVE_PATH").collect()
    return _each_target(rows, "BRONZE_TABLE_NAME", one, ctx.workers)


# ------------------------------------------------------------------ silver
def silver_transform(bronze: DataFrame, mapping: ColumnMapping, keys: Sequence[str],
                     order_by: Sequence[str] = (ADDED_ON,)) -> DataFrame:
    """Rename (P5), fill (P6), cast (P7), then keep the newest row per key (A2).

    Dedupe comes last: a fill or cast can make two keys equal.
    """
    df = rename_columns(bronze, mapping.renames)
    df = fill_nulls(df, mapping.defaults)
    df = cast_columns(df, mapping.types)
    return dedupe_latest(df, keys, order_by)


def load_table(table: LayerTable | PartitionedTable, df: DataFrame, *, operation_type: str, is_full_load,
               keys: Sequence[str], run_id: str, now=None,
               update_columns: Sequence[str] | None = None, unique_keys: bool = False,
               null_keys: str = "insert", counts: dict | None = None) -> int:
    """K6 dispatch: replace (K2/K3) or upsert (K4/K5); returns rows written (K7).

    ``unique_keys`` says ``df`` is already one row per key (e.g. deduplicated on
    it), so the upsert skips its uniqueness check. An upsert into a partitioned
    table rewrites the touched partitions only. ``counts`` receives the rows
    written by kind: updated, unchanged, inserted, null_key.
    """
    mode = load_mode(operation_type, is_full_load)
    if mode == "replace":
        written = table.replace(replace(df, table.schema, run_id=run_id, now=now))
        (counts if counts is not None else {}).update(dict.fromkeys(ROW_KINDS, 0) | {"inserted": written})
        return written
    kinds = Observation()
    kw = dict(run_id=run_id, now=now, update_columns=update_columns, check=not unique_keys, null_keys=null_keys, counts=kinds)
    if isinstance(table, PartitionedTable):
        written = upsert_partitions(table, df, keys, **kw)
    else:
        written = table.replace(upsert(table.read(), df, keys, **kw))
    # without rows, the plan is cut short before the counts
    seen = {k: kinds.get[k] for k in ROW_KINDS} if written else dict.fromkeys(ROW_KINDS, 0)
    _LOG.info("%s: %s", table, seen)
    (counts if counts is not None else {}).update(seen)
    return written


def consumed_table(ctx: LoadContext, silver_name: str) -> LayerTable:
    """(BRONZE_TABLE_NAME, BATCH): the bronze batches that a silver table has taken in."""
    table = ctx.lake.table("silver_consumed", silver_name)
    return table if table.exists() else table.create(CONSUMED)


def order_table(ctx: LoadContext, silver_name: str, object_name: str) -> LayerTable:
    """The winning bronze row of every key that an object brought into a silver table, one batch per load.

    A batch that comes late is held against it, so an older row cannot replace a newer one.
    """
    return ctx.lake.table("silver_order", f"{silver_name}--{object_name}")


#: loads after which the winners are folded into one row per key again
ORDER_BATCHES = 16


def record_winners(table: LayerTable, won: DataFrame, keys: Sequence[str], *, whole: bool) -> None:
    """Add this load's winning rows; ``whole``: they are all there is."""
    if whole or not table.exists():
        table.replace(won)
        return
    held = table.read()
    if held.schema != won.schema:       # the mapping changed
        table.replace(held.unionByName(won, allowMissingColumns=True).select(*[qcol(c) for c in won.columns]))
    elif len(table.batches()) > ORDER_BATCHES:
        table.replace(dedupe_latest(held.unionByName(won), keys, (ADDED_ON,)))
    else:
        table.append(won)


CONSUMED = T.StructType([T.StructField("BRONZE_TABLE_NAME", T.StringType()), T.StructField("BATCH", T.StringType())])


def split_bad_keys(df: DataFrame, mapping: ColumnMapping, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key columns fit their mapped types, and the others.

    A key that cannot be cast would become null, and the dedupe would fold all
    such rows into one; they are kept apart instead. Other columns become null.
    """
    bad = bad_key(df, mapping, keys)
    return df.where(~bad), df.where(bad)


def bad_key(df: DataFrame, mapping: ColumnMapping, keys: Sequence[str]) -> Column:
    """Whether a row has a key that cannot be cast to its mapped type."""
    types = {k.lower(): t for k, t in mapping.types.items() if t}
    bad = F.lit(False)
    for k in keys:
        actual = resolve_column(df.columns, k)
        if actual is not None and k.lower() in types:
            bad = bad | (qcol(actual).isNotNull() & qcol(actual).try_cast(types[k.lower()]).isNull())
    return bad


def lossy_cast(df: DataFrame, types: Mapping[str, str]) -> Column:
    """Whether a cast to its mapped type makes a value of the row null (a row of ``cast_error_rows``)."""
    named = ((resolve_column(df.columns, n), t) for n, t in types.items() if t)
    return reduce(or_, [qcol(c).isNotNull() & qcol(c).try_cast(t).isNull() for c, t in named if c is not None], F.lit(False))


#: values that a silver cast made null
CAST_ERROR = T.StructType([*(T.StructField(c, T.StringType()) for c in ("OBJECT_NAME", "KEY", "COLUMN_NAME", "VALUE", "TYPE")),
                           T.StructField(ADDED_BY, T.StringType()), T.StructField(ADDED_ON, T.TimestampType())])


def cast_error_rows(rows: DataFrame, types: Mapping[str, str], keys: Sequence[str], object_name: str, run_id: str, now) -> DataFrame:
    """One row per value that a cast to its mapped type makes null, with the row's key as JSON."""
    keyed = [qcol(c).alias(k) for k, c in ((k, resolve_column(rows.columns, k)) for k in keys) if c is not None]
    found = cast_with_errors(rows.withColumn("__strata_key", F.to_json(F.struct(*keyed)) if keyed else F.lit(None).cast("string")), types)
    each = found.where(F.size(CAST_ERRORS) > 0).select("__strata_key", F.explode(CAST_ERRORS).alias("e"))
    return stamp_audit(each.select(
        F.lit(object_name).alias("OBJECT_NAME"), F.col("__strata_key").alias("KEY"), F.col("e.column").alias("COLUMN_NAME"),
        F.col("e.value").alias("VALUE"), F.col("e.type").alias("TYPE")), run_id, now, (ADDED_BY, ADDED_ON))


def stage_winners(whole: DataFrame, m: ColumnMapping, keys: Sequence[str]) -> tuple[DataFrame, dict]:
    """The newest castable row of every key, staged, and what that pass saw: ``bad`` keys, rows with ``lossy`` casts.

    Where nothing was seen, the rows need no pass of their own for rejects and cast
    errors. The counts are missing where Spark cut the plan short (no rows).
    """
    bad = bad_key(whole, m, keys)
    seen = Observation()
    counted = whole.observe(seen, F.count_if(bad).alias("bad"), F.count_if(~bad & lossy_cast(whole, m.types)).alias("lossy"))
    won, n = stage(dedupe_latest(cast_columns(counted.where(~bad), m.types), keys, (ADDED_ON,)), "silver-newest")
    return won, seen.get if n else {}


def run_silver(ctx: LoadContext, objects: DataFrame, mapping: DataFrame, *,
               incremental: bool = True) -> dict[str, int]:
    """Every active object: bronze -> mapped, deduped rows -> silver.

    Upserting objects take in the bronze batches that their silver table has not
    consumed yet, whatever their timestamps; a full load, or ``incremental=False``,
    reads all of bronze. Of a key's rows in several batches the newest wins, in
    whatever order the batches come: a row is upserted only if it beats the row
    that the object brought in before (``order_table``). The batches are recorded
    after the silver version is published: a run that dies in between takes them
    in once more, and since equal rows do not win and null-key rows are inserted
    only where they are missing, that adds nothing. Rows with keys that cannot be
    cast go to the table ``silver_rejects``, other values that a cast makes null to
    ``silver_cast_errors``; both are counted in the log. Staged tables go when an
    object's load ends.
    """
    def one(row) -> tuple[str, int]:
        with owned_scratch(ctx.spark):
            return load(row)

    def load(row) -> tuple[str, int]:
        keys = split_list(row["KEY_COLUMN_NAME"])
        m = load_mapping(mapping, row["SOURCE_NAME"], row["OBJECT_NAME"])
        bronze = ctx.lake.table("bronze", row["BRONZE_TABLE_NAME"])
        name = row["SILVER_TABLE_NAME"]
        silver, consumed = ctx.lake.table("silver", name), consumed_table(ctx, name)
        batches = bronze.batches()      # batches that come later are left to the next run
        rows, seen = bronze.read(), []
        step = incremental and load_mode(row["OPERATION_TYPE"], row["IS_FULL_LOAD"]) == "upsert"
        if step:
            taken = {r["BATCH"] for r in consumed.read().where(F.col("BRONZE_TABLE_NAME") == row["BRONZE_TABLE_NAME"]).collect()}
            seen, batches = [b for b in batches if b in taken], [b for b in batches if b not in taken]
            rows = bronze.read_batches(batches)

        def mapped(some):
            return fill_nulls(rename_columns(some, m.renames), m.defaults)

        whole = mapped(rows)
        good, bad = split_bad_keys(whole, m, keys)
        won, counts = stage_winners(whole, m, keys)
        if m.types:
            batch = f"{ctx.run_id}-{row['OBJECT_NAME']}".lower()
            none = lambda df: ctx.spark.createDataFrame([], df.schema)
            rejects = ctx.lake.table("silver_rejects", name)
            if not rejects.exists():
                rejects.create(bad.schema)
            n = rejects.write_batch(bad if counts.get("bad", 1) else none(bad), batch)
            if n:
                _LOG.warning("%s: %d rows have keys that cannot be cast; see silver_rejects", name, n)
            errors = ctx.lake.table("silver_cast_errors", name)
            if not errors.exists():
                errors.create(CAST_ERROR)
            lost = cast_error_rows(good, m.types, keys, row["OBJECT_NAME"], ctx.run_id, ctx.now)
            n = errors.write_batch(lost if counts.get("lossy", 1) else none(lost), batch)
            if n:
                _LOG.warning("%s: %d values cannot be cast and are null; see silver_cast_errors", name, n)
        winners = order_table(ctx, name, row["OBJECT_NAME"])
        if step and winners.exists():
            won = newer_rows(won, winners.read(), keys, (ADDED_ON,))
        elif step and seen:      # batches taken in before winners were kept
            before = split_bad_keys(mapped(bronze.read_batches(seen)), m, keys)[0]
            won = newer_rows(won, cast_columns(before, m.types), keys, (ADDED_ON,))
        if step and (seen or winners.exists()):
            won, _ = stage(won, "silver-winners")       # upserted, then recorded
        written = load_table(
            silver, won, operation_type=row["OPERATION_TYPE"], is_full_load=row["IS_FULL_LOAD"], keys=keys,
            run_id=ctx.run_id, now=ctx.now, update_columns=m.merge_columns(), unique_keys=True, null_keys="missing")
        record_winners(winners, won, keys, whole=not step)
        if batches:
            consumed.append(ctx.spark.createDataFrame([(row["BRONZE_TABLE_NAME"], b) for b in batches], CONSUMED))
        return name, written

    return _each_target(active(objects).collect(), "SILVER_TABLE_NAME", one, ctx.workers)


# ------------------------------------------------------------------ gold
@dataclass(frozen=True)
class GoldBuilder:
    """How to build one gold object; dimensions are built before facts."""

    name: str
    build: Callable[[LoadContext], DataFrame]
    kind: str = "dimension"
    key: str | None = None  # the surrogate key: set on insert, never updated on a match


def run_gold(ctx: LoadContext, edw_config: DataFrame, builders: Sequence[GoldBuilder]) -> dict[str, int]:
    """Every active gold object, dimensions first; an unknown name raises."""
    by_name = {b.name.lower(): b for b in builders}
    rows = active(edw_config).collect()
    unknown = [r["OBJECT_NAME"] for r in rows if r["OBJECT_NAME"].lower() not in by_name]
    if unknown:
        raise ValueError(f"no gold builder for {unknown}")

    def one(row) -> tuple[str, int]:
        with owned_scratch(ctx.spark):
            return load(row)

    def load(row) -> tuple[str, int]:
        b = by_name[row["OBJECT_NAME"].lower()]
        keys = split_list(row["GOLD_KEY_COLUMN_NAME"])
        table = ctx.lake.table("gold", row["OBJECT_NAME"])
        listed = split_list(row["GOLD_COLUMN_NAMES"]) or table.schema.fieldNames()
        built = b.build(ctx)
        if load_mode(row["OPERATION_TYPE"], row["IS_FULL_LOAD"]) == "upsert":
            built, _ = stage(built, "gold-built")       # an upsert reads its source several times
        return row["OBJECT_NAME"], load_table(
            table, built, operation_type=row["OPERATION_TYPE"], is_full_load=row["IS_FULL_LOAD"],
            keys=keys, run_id=ctx.run_id, now=ctx.now, update_columns=gold_update_columns(listed, keys, b.key))

    dims = [r for r in rows if by_name[r["OBJECT_NAME"].lower()].kind == "dimension"]
    facts = [r for r in rows if by_name[r["OBJECT_NAME"].lower()].kind != "dimension"]
    return {**_each_target(dims, "OBJECT_NAME", one, ctx.workers), **_each_target(facts, "OBJECT_NAME", one, ctx.workers)}


# ------------------------------------------------------------------ whole run
@dataclass
class LayerConfig:
    objects: DataFrame
    mapping: DataFrame
    edw: DataFrame
    builders: Sequence[GoldBuilder] = field(default_factory=tuple)


def create_tables(lake: Lakehouse, schemas: Mapping[tuple[str, str], T.StructType]) -> None:
    """K8: create every (layer, name) table that does not exist yet."""
    def one(item) -> None:
        (layer, name), schema = item
        t = lake.table(layer, name)
        if not t.exists():
            t.create(schema)

    _each(schemas.items(), one, 4)


def run_layers(ctx: LoadContext, cfg: LayerConfig, control: ControlTables, pipeline: str,
               *, incremental: bool = False, incremental_silver: bool = True, **gate) -> str:
    """Bronze, silver and gold under the run gate.

    ``incremental``: bronze loads only new files (K9); ``incremental_silver``:
    silver upserts only the bronze batches that it has not consumed.
    """
    def work():
        run_bronze(ctx, cfg.objects, incremental=incremental)
        run_silver(ctx, cfg.objects, cfg.mapping, incremental=incremental_silver)
        run_gold(ctx, cfg.edw, cfg.builders)
    return gated_run(control, pipeline, ctx.run_id, work, **gate)
