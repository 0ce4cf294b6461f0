"""Step timers: which start an end belongs to and how long the step took."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import chunk_by_time, previous_value

ENDS = ("completed", "failed")


def step_durations(events: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Each end with its duration in milliseconds.

    An end pairs with the latest start of its run and operation if that start is
    the row just before it; a second start replaces an open one, and an end
    without an open start lasts 0. Skips and banners leave the timers alone.
    """
    timers = events.where(F.col("event").isin("started", *ENDS))
    seen = previous_value(
        timers,
        ("run_id", "operation"),
        ("ts", "event_id"),
        F.struct(F.col("event").alias("event"), F.col("ts").alias("ts")),
        "before",
        chunk_by_time("ts", 86_400) if chunk is None else chunk,
    )
    micros = F.unix_micros("ts") - F.unix_micros("before.ts")
    return (
        seen.where(F.col("event").isin(*ENDS))
        .withColumn(
            "duration_ms",
            F.when(F.col("before.event") == "started", F.round(micros / 1000.0, 3)).otherwise(0.0),
        )
        .drop("before")
    )


def timed_steps(events: DataFrame, chunk: Column | None = None) -> DataFrame:
    """All step events; ends carry their duration."""
    ends = step_durations(events, chunk)
    others = events.where(~F.col("event").isin(*ENDS))
    return ends.unionByName(others, allowMissingColumns=True)
