"""Controlled runs: trigger, decision, run, status, and the wait for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.triggers import decide_triggers


def published_statuses(triggers: DataFrame, results: DataFrame, chunk: Column | None = None) -> DataFrame:
    """The status each trigger is answered with.

    Repeats and manual runs are answered at once; executed ones by the result of
    their run. ``results`` holds one row per executed trigger, named by partition and offset, with
    ``run_status``, ``run_error``, ``duration_us``. A run without a result is
    still going and gets no status.
    """
    decided = decide_triggers(triggers, chunk=chunk)
    done = results.select("partition", "offset", "run_status", "run_error", "duration_us")
    ran = F.col("decision") == "execute"
    met = decided.join(done, ["partition", "offset"], "left").withColumn("took", F.when(ran, F.col("duration_us")).otherwise(0))
    return met.where(~ran | F.col("run_status").isNotNull()).select(
        "partition", "offset", "product", "stage", "pipeline_type", "pipeline_role", "run_id",
        "decision",
        F.when(ran, F.col("run_status")).otherwise(F.col("decision")).alias("status"),
        F.when(ran, F.col("run_error")).alias("error"),
        (F.col("took") / 1000.0).alias("duration_ms"),
        F.timestamp_micros(F.unix_micros("timestamp") + F.col("took")).alias("timestamp"),
    )
