"""Drain batches: runs of messages that are not interrupted by a long silence.

Only handled messages reset the clock. Others belong to the batch that is open when they come; those that come when
none is open wait for the next one. Where no handled message follows they make a batch without handled messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import chunk_by_time, previous_value, running_sum

DRAIN_IDLE_SECS = 15  # fixed value: default silence that ends a drain run


def number_batches(
    messages: DataFrame,
    gap_secs: float = DRAIN_IDLE_SECS,
    keys: Sequence[str] = ("topic", "partition"),
    chunk: Column | None = None,
    handled: Column | None = None,
) -> DataFrame:
    """Add ``batch_no`` per topic partition; ``gap_secs`` or more without a handled message start a new one.

    Without ``handled`` every message counts as handled; a null counts as not handled.
    """
    cut = chunk_by_time("timestamp") if chunk is None else chunk
    order = ("timestamp", "offset")
    done = F.lit(True) if handled is None else F.coalesce(handled, F.lit(False))
    seen = previous_value(messages, keys, order, F.when(done, F.col("timestamp")), "before", cut)
    quiet = F.unix_micros("timestamp") - F.unix_micros("before") >= int(gap_secs * 1_000_000)
    closed = F.when(F.col("before").isNull() | quiet, 1).otherwise(0)
    flagged = seen.withColumn("closed", closed).drop("before")
    numbered = running_sum(flagged, keys, order, F.when(done, F.col("closed")).otherwise(0), "batch_no", cut)
    if handled is not None:
        numbered = numbered.withColumn("batch_no", F.col("batch_no") + F.when(done, 0).otherwise(F.col("closed")))
    return numbered.drop("closed")


def drain_batches(
    messages: DataFrame,
    gap_secs: float = DRAIN_IDLE_SECS,
    keys: Sequence[str] = ("topic", "partition"),
    chunk: Column | None = None,
    handled: Column | None = None,
) -> DataFrame:
    """One row per batch: size, handled messages, time span and offsets."""
    done = F.lit(True) if handled is None else F.coalesce(handled, F.lit(False))
    cut = chunk_by_time("timestamp") if chunk is None else chunk
    narrow = messages.select(*keys, "offset", "timestamp", done.alias("handled"), cut.alias("cut"))
    return (
        number_batches(narrow, gap_secs, keys, F.col("cut"), None if handled is None else F.col("handled"))
        .groupBy(*keys, "batch_no")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_if("handled").alias("handled"),
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )
