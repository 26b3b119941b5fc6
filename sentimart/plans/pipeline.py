"""The batch pipeline in the reference's stage order: ingest -> raw gate -> transform ->
processed gate (SURVEY 3.1-3.3, Q2, Q3, S9, S11, S12).

Tables live under one root in the shared storage, one folder per run
(``raw/batch=<run>``, ``processed/batch=<run>``, ``watermarks/batch=<run>``). A run only
overwrites its own folders and reads the tables without them, so re-running a failed run gives
the same result; the watermark is written after the raw rows it covers (it never advances past
rows that were not committed). Every written table also cuts the lineage for the next stage.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sentimart import schemas as S
from sentimart.operators import process as P
from sentimart.operators import quality as Q
from sentimart.streaming.ingest import _read_or_empty, commit_batch, raw_table


@dataclass
class RunResult:
    run_id: int
    raw_inserted: int
    processed_inserted: int
    raw_gate: list[tuple[str, int, bool]]
    processed_gate: list[tuple[str, int, bool]]


def processed_table(spark: SparkSession, root: str, exclude_batch: int | None = None) -> DataFrame:
    return _read_or_empty(spark, os.path.join(root, "processed"), S.PROCESSED, exclude_batch)


def _gate(report: DataFrame, enforce: bool) -> list[tuple[str, int, bool]]:
    rows = [(r["check"], int(r["value"]), bool(r["passed"])) for r in report.collect()]
    if enforce and not all(p for _, _, p in rows):
        raise Q.GateFailed("gate failed: " + ", ".join(c for c, _, p in rows if not p))
    return rows


def run_pipeline(spark: SparkSession, feed_rows: DataFrame, root: str, run_id: int,
                 max_per_app: int | None = None, raw_min_rows: int = 100,
                 processed_min_rows: int = 50, enforce_gates: bool = True,
                 resources: P.TextResources | None = None) -> RunResult:
    """One scheduled run over ``feed_rows`` (raw-table shaped rows of all apps)."""
    # 1. ingest: watermark filter, insert-or-ignore; raw rows first, then the watermark.
    commit_batch(feed_rows, run_id, root, max_per_app)
    # 2. raw gate: the figures of all runs and the rows of this one.
    raw_new = spark.read.schema(S.RAW).parquet(os.path.join(root, "raw", f"batch={run_id}"))
    raw_gate = _gate(Q.gate_of_runs(spark, Q.RAW_METRICS, os.path.join(root, "raw_metrics"), raw_new, raw_min_rows), enforce_gates)
    raw_n = _run_rows(spark, root, "raw_metrics", run_id)

    # 3. transform: only raw rows not processed yet (anti join before any text work).
    existing = processed_table(spark, root, exclude_batch=run_id)
    new_p = P.process_reviews(raw_table(spark, root), resources, existing=existing)
    proc_n = Q.write_observed(new_p.select(*S.PROCESSED_COLUMNS), Q.PROCESSED_METRICS,
                              os.path.join(root, "processed", f"batch={run_id}"),
                              os.path.join(root, "processed_metrics", f"batch={run_id}"))["row_count"]

    # 4. processed gate, from the figures of all runs; every stored raw row is valid and must have a processed row.
    proc_gate = _gate(Q.gate_of_runs(spark, Q.PROCESSED_METRICS, os.path.join(root, "processed_metrics"), min_rows=processed_min_rows), enforce_gates)
    total = {c: v for c, v, _ in raw_gate}["row_count"]
    missing = total - {c: v for c, v, _ in proc_gate}["row_count"]
    proc_gate.append(("unprocessed_rows", missing, missing == 0))
    if enforce_gates and missing:
        raise Q.GateFailed(f"gate failed: {missing} valid raw rows have no processed row")
    return RunResult(run_id, raw_n, proc_n, raw_gate, proc_gate)


def _run_rows(spark: SparkSession, root: str, metrics: str, run_id: int) -> int:
    return int(spark.read.parquet(os.path.join(root, metrics, f"batch={run_id}")).first()["row_count"])
