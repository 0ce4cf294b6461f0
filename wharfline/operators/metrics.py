"""Counters, histograms and outcome statistics over metric points and step events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col

# Default upper bounds of a duration histogram.
DEFAULT_BOUNDS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
STEP_TAGS = ("stage", "type", "role", "operation", "mode")


def counters(points: DataFrame) -> DataFrame:
    """Sum of each counter by name and attributes (maps that are equal as sets are one group)."""
    return (
        points.where(F.col("kind") == "counter")
        .groupBy("name", "attributes")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("points"))
    )


def updown(points: DataFrame) -> DataFrame:
    """Current level of each up-down counter."""
    return (
        points.where(F.col("kind") == "updown")
        .groupBy("name", "attributes")
        .agg(F.sum("value").alias("level"))
    )


def bucket_counts(value: Column | str, bounds: Sequence[float] = DEFAULT_BOUNDS) -> Column:
    """Counts per bucket; a bucket holds values above the last bound up to its own."""
    v = col(value)
    edges = [None, *bounds, None]
    counts = []
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else v > low
        if high is not None:
            inside = inside & (v <= high)
        counts.append(F.count_if(inside))
    return F.array(*counts)


def histogram(points: DataFrame, bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Distribution of each histogram by name and attributes."""
    return (
        points.where(F.col("kind") == "histogram")
        .groupBy("name", "attributes")
        .agg(
            F.count("value").alias("count"),
            F.sum("value").alias("sum"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            bucket_counts("value", bounds).alias("buckets"),
        )
    )


def metric_windows(points: DataFrame, secs: int = 60, lateness: str | None = None) -> DataFrame:
    """Counter sums per export interval; with a lateness also for streams."""
    source = points if lateness is None else points.withWatermark("ts", lateness)
    return (
        source.groupBy(F.window("ts", f"{secs} seconds").alias("slot"), "name")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("points"))
        .select(
            F.col("slot.start").alias("window_start"),
            F.col("slot.end").alias("window_end"),
            "name",
            "total",
            "points",
        )
    )


def window_totals(messages: DataFrame, ts: str, secs: int, handled: Column) -> DataFrame:
    """Processed, forwarded and skipped messages of each time-boxed run."""
    return (
        messages.groupBy(F.window(ts, f"{secs} seconds").alias("slot"))
        .agg(
            F.count(F.lit(1)).alias("processed"),
            F.count_if(handled).alias("forwarded"),
        )
        .select(
            F.col("slot.start").alias("window_start"),
            "processed",
            "forwarded",
            (F.col("processed") - F.col("forwarded")).alias("skipped"),
        )
    )


def errors_total(errors: DataFrame, *keys: str) -> DataFrame:
    """Number of errors by type and message."""
    return errors.groupBy(*keys, "error_type", "error_message").agg(F.count(F.lit(1)).alias("errors"))


def call_stats(calls: DataFrame) -> DataFrame:
    """Calls and their time by function, status and error class."""
    status = F.when(F.col("error_type").isNull(), "success").otherwise("error")
    return (
        calls.withColumn("status", status)
        .groupBy("function", "status", "error_type")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.sum("duration_us").alias("total_us"),
            F.max("duration_us").alias("max_us"),
        )
    )


def step_stats(timed: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Outcome counts and the last duration of each step, as its gauge shows it."""
    event = F.col("event")
    is_end = event.isin("completed", "failed")
    return timed.groupBy(*STEP_TAGS).agg(
        *[F.count_if(event == e).alias(e) for e in ("started", "completed", "failed", "skipped")],
        F.max_by("duration_ms", F.when(is_end, F.struct(*order))).alias("last_duration_ms"),
    )


def discovered(listing: DataFrame, *keys: str) -> DataFrame:
    """Objects and bytes found per container."""
    return listing.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files_discovered_total"), F.sum("length").alias("bytes")
    )


def copy_counters(plan: DataFrame, *keys: str) -> DataFrame:
    """File counters of a cycle by true status and by the status the reports use.

    Reports call everything that was not copied ``skipped``; refused keys raise.
    """
    true_status = (
        F.when(F.col("copied"), "success").when(F.col("skipped"), "skipped").otherwise("error")
    )
    reported = (
        F.when(F.col("copied"), "success")
        .when(F.col("reason") == "unsafe object key", "error")
        .otherwise("skipped")
    )
    return plan.groupBy(
        *keys, true_status.alias("status"), reported.alias("reference_status")
    ).agg(F.sum("requests").alias("files_processed_total"))


def metric_lines(points: DataFrame) -> DataFrame:
    """Export lines ``name|#k:v,k:v:value|c`` (counters) or ``|g`` with three decimals (gauges).

    ``tags`` is an array of key/value structs, in the order to be printed.
    """
    tags = F.array_join(
        F.transform("tags", lambda t: F.concat(t["key"], F.lit(":"), t["value"])), ","
    )
    head = F.when(F.size("tags") > 0, F.concat(F.col("name"), F.lit("|#"), tags)).otherwise(F.col("name"))
    number = F.when(F.col("kind") == "counter", F.col("value").cast("bigint").cast("string")).otherwise(
        F.format_string("%.3f", F.col("value").cast("double"))
    )
    ending = F.when(F.col("kind") == "counter", "|c").otherwise("|g")
    return points.select(F.concat(head, F.lit(":"), number, ending).alias("value"))
