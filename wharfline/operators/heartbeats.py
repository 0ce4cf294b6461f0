"""Heartbeat records: numbering, uptime and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import chunk_by_time, following_value, running_sum

DEFAULT_INTERVAL = 300  # fixed value: seconds between heartbeats


def heartbeats(beats: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Number the beats of each start of a component and add whole seconds of uptime."""
    numbered = running_sum(
        beats,
        ("component", "started_at"),
        ("ts", "event_id"),
        F.lit(1),
        "sequence",
        chunk_by_time("ts") if chunk is None else chunk,
    )
    up = (F.unix_micros("ts") - F.unix_micros("started_at")) / 1_000_000
    return numbered.withColumn("uptime_seconds", up.cast("bigint")).withColumn(
        "status", F.lit("healthy")
    )


def missed_heartbeats(
    beats: DataFrame, interval: int = DEFAULT_INTERVAL, tolerance: int = 0, chunk: Column | None = None
) -> DataFrame:
    """Gaps between beats of a component that are longer than allowed."""
    seen = following_value(
        beats.select("component", "ts", "event_id"),
        ("component",),
        ("ts", "event_id"),
        F.col("ts"),
        "next_ts",
        chunk_by_time("ts", 86_400) if chunk is None else chunk,
    )
    gap = F.unix_micros("next_ts") - F.unix_micros("ts")
    allowed = (interval + tolerance) * 1_000_000
    return seen.where(gap > allowed).select(
        "component",
        F.col("ts").alias("last_seen"),
        "next_ts",
        gap.alias("gap_us"),
        F.floor(gap / (interval * 1_000_000)).cast("bigint").alias("missed"),
    )
