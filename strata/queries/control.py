"""Run-gate query (S9, K10, K11, G7) around a real load of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.upsert import replace
from strata.operators.transform import stamp_audit
from strata.plans.control import ControlTables, gated_run
from strata.queries.common import NOW, RUN_ID, RUN_ID_2, table
from strata.schemas import ADDED_BY
from strata.session import scratch_dir
from strata.sources.tables import LayerTable

PIPELINE = "orders_daily"


def run_gate(spark, sf_dir):
    """Run 1 loads orders and completes; run 2 fails (flag stays 0); run 3 is refused."""
    root = scratch_dir(spark, "control")
    control = ControlTables(LayerTable(spark, f"{root}/status"), LayerTable(spark, f"{root}/audit")).create()
    control.register(PIPELINE, True)
    silver = LayerTable(spark, f"{root}/silver_orders")
    orders = table(spark, sf_dir, "orders")
    clock = iter(["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-02 00:00:00",
                  "2024-01-02 00:01:00", "2024-01-03 00:00:00"])

    def load_ok():
        silver.replace(stamp_audit(orders, RUN_ID, NOW))

    def load_bad():
        schema = silver.schema.add("NOT_IN_SOURCE", "string")
        silver.replace(replace(orders, schema, run_id=RUN_ID_2, now=NOW))  # missing column: raises

    states = [gated_run(control, PIPELINE, RUN_ID, load_ok, clock=lambda: next(clock))]
    try:
        gated_run(control, PIPELINE, RUN_ID_2, load_bad, clock=lambda: next(clock))
    except ValueError:
        states.append("failed")
    states.append(gated_run(control, PIPELINE, "run-0003", load_ok, clock=lambda: next(clock)))
    assert states == ["completed", "failed", "skipped"], states
    loaded = silver.read().groupBy(ADDED_BY).agg(F.count(F.lit(1)).alias("ROWS_LOADED"))
    status = control.status.read()
    return (control.audit.read()
            .join(loaded, F.col("PIPELINE_RUN_ID") == F.col(ADDED_BY), "left").drop(ADDED_BY)
            .join(status, "PIPELINE_NAME", "left"))


QUERIES = {"run_gate": run_gate}

ORACLE = {
    "run_gate": f"""
        SELECT '{PIPELINE}' AS PIPELINE_NAME, '{RUN_ID}' AS PIPELINE_RUN_ID,
               TIMESTAMP '2024-01-01 00:00:00' AS PIPELINE_START_TIME,
               TIMESTAMP '2024-01-01 00:05:00' AS PIPELINE_END_TIME,
               count(*) AS ROWS_LOADED, false AS IS_LAST_RUN_COMPLETED
        FROM orders""",
}
