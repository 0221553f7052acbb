"""Upsert (K4/K5 with J3), full replace (K2/K3) and the load dispatch (K6).

Spark's built-in tables refuse MERGE, so the upsert is a pure function
``(target, source) -> new table contents``:

* matched target rows take the listed columns from the source, keep ADDED_*,
  and get MODIFIED_* of this run;
* source rows with no match are inserted with all four audit columns;
* target rows with no match stay as they are (there is no delete);
* ``=`` on keys, so a null key never matches: null-key source rows are inserted.

It is planned as a left join target -> source plus an anti join of the source
against the matched keys, rather than a full outer join: AQE can split a
skewed key on the target side of a left (or semi) join, and the matched keys
are collapsed by partial aggregation before their shuffle. A small source is
broadcast by the planner's own size check, so a large target is then read but
never shuffled.

``null_keys="missing"`` makes inserts of null-key rows repeatable: of equal rows,
only as many are inserted as the target does not hold yet, so a batch that is
taken in again adds nothing. ``counts`` observes what became of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import qcol, resolve_column, resolve_columns
from strata.functions.values import as_timestamp
from strata.operators.transform import conform, stamp_audit
from strata.schemas import ADDED_BY, ADDED_ON, AUDIT_COLUMNS, MODIFIED_BY, MODIFIED_ON, is_audit


class DuplicateKeyError(ValueError):
    """More than one source row for one non-null key (MERGE would fail too)."""


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """§2.9 item 5: raise if a non-null key occurs twice in the source (counted where equal keys meet)."""
    keys = resolve_columns(source.columns, keys, "key column")
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & qcol(k).isNotNull()
    width = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dup = (source.where(not_null).select(*[qcol(k) for k in keys]).repartition(width, *[qcol(k) for k in keys])
           .groupBy(*[qcol(k) for k in keys]).count()
           .where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"source has duplicate keys {keys}: e.g. {dup[0].asDict()}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    run_id: str,
    now=None,
    update_columns: Sequence[str] | None = None,
    check: bool = True,
    null_keys: str = "insert",
    counts: Observation | None = None,
) -> DataFrame:
    """K4/K5: the target's new contents, in target column order and types.

    ``update_columns`` (default: every non-key, non-audit column both sides
    have) are copied on match; audit columns and keys are never updated from
    the source. Insert binds source columns to target columns by name.
    ``null_keys``: ``insert`` every null-key source row, or only the ``missing`` ones.
    ``counts`` receives the numbers of updated, unchanged, inserted and null_key
    (inserted with a null key) rows when the result is written.
    """
    if null_keys not in ("insert", "missing"):
        raise ValueError(f"null_keys is 'insert' or 'missing', not {null_keys!r}")
    tcols = target.columns
    tkeys = resolve_columns(tcols, keys, "target key")
    skeys = resolve_columns(source.columns, keys, "source key")
    if check:
        check_unique(source, skeys)
    shared = {c: resolve_column(source.columns, c) for c in tcols}
    shared = {c: s for c, s in shared.items() if s is not None and not is_audit(c)}
    if update_columns is None:
        updates = [c for c in shared if c not in tkeys]
    else:
        wanted = resolve_columns(tcols, update_columns, "update column")
        updates = [c for c in wanted if c not in tkeys and not is_audit(c)]
        missing = [c for c in updates if c not in shared]
        if missing:
            raise ValueError(f"update columns {missing} are not in the source")
    ttype = {f.name: f.dataType for f in target.schema.fields}
    ts = as_timestamp(now)
    stamp = {MODIFIED_BY: F.lit(run_id), MODIFIED_ON: ts, ADDED_BY: F.lit(run_id), ADDED_ON: ts}

    # Source rows with every key set are the only ones that can match. One
    # projection of them feeds the match and the insert, so the two branches
    # need the same shuffle of the source and Spark reuses it (a deduplicated
    # source is then aggregated once, not once per branch).
    set_keys = None
    for k in skeys:
        set_keys = qcol(k).isNotNull() if set_keys is None else set_keys & qcol(k).isNotNull()
    values = [c for c in shared if c not in tkeys]
    val_index = {c: j for j, c in enumerate(values)}
    src = source.where(set_keys).select(
        *[qcol(k).alias(f"__sk{i}") for i, k in enumerate(skeys)],
        *[qcol(shared[c]).cast(ttype[c]).alias(f"__sv{j}") for j, c in enumerate(values)],
    )
    t = target.alias("__t")
    tq = lambda c: F.col("__t.`" + c.replace("`", "``") + "`")
    sq = lambda c: F.col("__s.`" + c.replace("`", "``") + "`")
    # target rows with a null key never match; sent past the join, they cannot meet in one partition
    t_keyed = None
    for k in tkeys:
        t_keyed = tq(k).isNotNull() if t_keyed is None else t_keyed & tq(k).isNotNull()
    matched = t.where(t_keyed).join(src, [tq(k) == F.col(f"__sk{i}") for i, k in enumerate(tkeys)], "left")
    past = t.where(~t_keyed).select(*[tq(c).alias(c) for c in tcols], F.lit("unchanged").alias(_KIND))
    hit = F.col("__sk0").isNotNull()  # src keys are never null, so set only on a match
    kept = []
    for c in tcols:
        old = tq(c)
        if c in updates:
            kept.append(F.when(hit, F.col(f"__sv{val_index[c]}")).otherwise(old).alias(c))
        elif c.upper() in (MODIFIED_BY, MODIFIED_ON):
            kept.append(F.when(hit, stamp[c.upper()].cast(ttype[c])).otherwise(old).alias(c))
        else:
            kept.append(old.alias(c))
    kind = lambda name: F.lit(name).alias(_KIND)
    kept_rows = matched.select(*kept, F.when(hit, "updated").otherwise("unchanged").alias(_KIND))

    # keys present on both sides: a semi join of target keys against source keys
    # (a small source is broadcast, so the target is not shuffled), then distinct. The
    # salted shuffle in between keeps the join's layout from being reused by distinct,
    # which would forbid AQE to split a hot key of the target
    tk = target.where(F.expr(" AND ".join(f"`{k.replace('`', '``')}` IS NOT NULL" for k in tkeys))).select(*[qcol(k).alias(f"__tk{i}") for i, k in enumerate(tkeys)])
    sk = src.select(*[F.col(f"__sk{i}").alias(f"__qk{i}") for i in range(len(skeys))])
    both = tk.join(sk, [F.col(f"__tk{i}") == F.col(f"__qk{i}") for i in range(len(tkeys))],
                   "left_semi")
    width = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (both.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(16)))
            .repartition(width, *[F.col(f"__tk{i}") for i in range(len(tkeys))], "__salt")
            .drop("__salt").distinct())
    new = src.join(both, [F.col(f"__sk{i}") == F.col(f"__tk{i}") for i in range(len(skeys))], "left_anti")
    key_index = {c: i for i, c in enumerate(tkeys)}
    inserted = new.select(*[
        (stamp[c.upper()] if c.upper() in AUDIT_COLUMNS
         else F.col(f"__sk{key_index[c]}") if c in key_index
         else F.col(f"__sv{val_index[c]}") if c in val_index
         else F.lit(None)).cast(ttype[c]).alias(c)
        for c in tcols
    ], kind("inserted"))
    # rows with a null key never match (``=`` on keys): inserted as they are
    plain = [c for c in tcols if not is_audit(c)]
    unkeyed = source.alias("__s").where(~set_keys).select(*[
        (sq(shared[c]) if c in shared else F.lit(None)).cast(ttype[c]).alias(c) for c in plain])
    if null_keys == "missing":
        unkeyed = missing_rows(unkeyed, past.select(*[qcol(c) for c in plain]))
    unkeyed = unkeyed.select(*[
        (stamp[c.upper()].cast(ttype[c]) if is_audit(c) else qcol(c)).alias(c) for c in tcols], kind("null_key"))
    out = kept_rows.unionByName(past).unionByName(inserted).unionByName(unkeyed)
    if counts is not None:
        out = out.observe(counts, *[F.count_if(F.col(_KIND) == k).alias(k) for k in ROW_KINDS])
    return out.drop(_KIND)


#: what an upsert did with a row of the new contents
ROW_KINDS = ("updated", "unchanged", "inserted", "null_key")
_KIND = "__strata_kind"

#: copies of one row that one task writes
_COPIES = 100_000


def missing_rows(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows that ``held`` (same columns) has too few of: n equal rows against m leave n - m.

    Equal rows are counted by a hash of the whole row (partial aggregates, so a row that
    repeats without end is no hot key) and written out again in parts of 100,000 copies.
    """
    cols = rows.columns
    row = F.struct(*[qcol(c) for c in cols])
    by_hash = lambda df, *aggs: df.groupBy(_row_hash(cols).alias("__h")).agg(*aggs)
    want = by_hash(rows, F.count(F.lit(1)).alias("__n"), F.first(row).alias("__row"))
    have = by_hash(held, F.count(F.lit(1)).alias("__m"))
    short = want.join(have, "__h", "left").withColumn("__k", F.col("__n") - F.coalesce("__m", F.lit(0))).where("__k > 0")
    parts = (short.select("__row", "__k", F.explode(F.expr(f"sequence(0L, (__k - 1) div {_COPIES})")).alias("__p"))
             .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    copies = parts.select("__row", F.explode(F.expr(f"sequence(1L, least({_COPIES}L, __k - __p * {_COPIES}))")).alias("__c"))
    return copies.select(*[F.col("__row").getField(c).alias(c) for c in cols])


def _row_hash(cols: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[qcol(c).alias(f"c{i}") for i, c in enumerate(cols)])), 256)


def replace(
    source: DataFrame,
    schema: T.StructType,
    *,
    run_id: str,
    now=None,
) -> DataFrame:
    """K2/K3 contents: source stamped with every audit column the schema has, conformed."""
    audit = tuple(c for c in AUDIT_COLUMNS if c in schema.fieldNames())
    return conform(stamp_audit(source, run_id, now, audit), schema)


def load_mode(operation_type: str | None, is_full_load) -> str:
    """K6: ``upsert`` (any case) with full-load flag 1 -> replace, else merge.

    Any other operation type raises instead of silently doing nothing.
    """
    if (operation_type or "").strip().lower() != "upsert":
        raise ValueError(f"unknown operation type {operation_type!r}; only 'upsert' is defined")
    return "replace" if int(is_full_load or 0) == 1 else "upsert"
