"""Run log: steps are appended as events and folded to one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.clock import iso_text

RUNNING = "running"
NEVER_RUN = "never_run"


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state per run: the latest event wins, the first one dates the start."""
    latest = F.max(
        F.struct(
            "ts", "seq", "flow_name", "status",
            "records_loaded", "records_quarantined", "error_message",
        )
    )
    folded = events.groupBy("run_id").agg(F.min("ts").alias("started_at"), latest.alias("last"))
    return folded.select(
        "run_id", "last.flow_name", "last.status", "started_at",
        F.when(F.col("last.status") != RUNNING, F.col("last.ts")).alias("finished_at"),
        "last.records_loaded", "last.records_quarantined", "last.error_message",
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc_nulls_first("started_at"), "run_id").limit(limit)


def last_run_status(runs: DataFrame) -> DataFrame:
    """One row: status and finish time of the newest run, ``never_run`` without any."""
    newest = recent_runs(runs.select("run_id", "started_at", "status", "finished_at"), 1)
    return newest.agg(
        F.count(F.lit(1)).alias("_runs"),
        F.max("status").alias("_status"),
        F.max("finished_at").alias("_finished_at"),
    ).select(
        F.when(F.col("_runs") == 0, F.lit(NEVER_RUN)).otherwise(F.col("_status"))
        .alias("pipeline_status"),
        iso_text(F.col("_finished_at")).alias("last_pipeline_run"),
    )
