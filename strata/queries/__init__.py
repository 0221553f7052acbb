"""Driver queries: each runs one or more operators over the given tables.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from
them) and has, where SQL can say it, a DuckDB oracle with the same column
names. Audit values are fixed by ``RUN_ID`` / ``NOW`` so they compare.
"""

from __future__ import annotations

from strata.queries import ingest, keys, marts, merge, silver, upsert, control, e2e, rerun

QUERIES = {}
ORACLE = {}
for _m in (marts, keys, ingest, silver, upsert, control, e2e, rerun, merge):
    QUERIES.update(_m.QUERIES)
    ORACLE.update(_m.ORACLE)
