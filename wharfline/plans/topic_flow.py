"""Topic products: forward, enrich and route messages. Every step is one narrow projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import (
    ROUTING,
    append_headers,
    enriched_headers,
    strict_fields,
    traceparent_entry,
    with_trace,
)
from ..functions.topics import sanitize, target_topic
from ..operators.screening import check_metadata, valid_metadata


def forward(messages: DataFrame, mapper_topic: str, *, run: str | None = None) -> DataFrame:
    """Pass messages on to the mapper topic with their key, value and headers.

    A consumer starts a new trace per message; a producer (``run`` given) puts
    all messages of its run in one trace. The trace header is added at the end.
    """
    return with_trace(messages, new_root=True, run=run).select(
        "key",
        "value",
        F.lit(mapper_topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        append_headers("headers", traceparent_entry(F.col("trace"))).alias("headers"),
    )


def enrich_static(
    messages: DataFrame, org: str, schema: str, product: str, processed_at: Column
) -> DataFrame:
    """Producer side: stamp the run's own metadata and send all to one target topic."""
    o, s, p = (sanitize(F.lit(x)) for x in (org, schema, product))
    return with_trace(messages, new_root=False).select(
        "key",
        "value",
        target_topic("producer", o, s, p).alias("topic"),
        enriched_headers(s, o, p, processed_at, "offset").alias("headers"),
        "partition",
        "offset",
        "timestamp",
        "trace",
    )


def check_route(messages: DataFrame) -> DataFrame:
    """Consumer side: routing columns, ``target`` topic and, for bad metadata, a reason.

    The name is made of sanitised parts, so it needs no fallback of its own.
    """
    named = target_topic("consumer", F.col("org_name"), F.col("schema_type"), F.col("product_type"))
    return check_metadata(messages).withColumn(
        "target", F.when(F.col("reject_reason").isNull(), named)
    )


def stamp_route(checked: DataFrame, processed_at: Column, *, strict_stamp: bool = False) -> DataFrame:
    """The outgoing messages of checked rows that have a target."""
    stamp = strict_fields("headers") if strict_stamp else {n: F.col(n) for n in ROUTING}
    return with_trace(valid_metadata(checked), new_root=False).select(
        "key",
        "value",
        F.col("target").alias("topic"),
        enriched_headers(
            stamp["schema_type"], stamp["org_name"], stamp["product_type"], processed_at, "offset"
        ).alias("headers"),
        "partition",
        "offset",
        "timestamp",
        "trace",
    )


def route(messages: DataFrame, processed_at: Column, *, strict_stamp: bool = False) -> DataFrame:
    """Consumer side: send each message to the topic its headers name.

    The stamped values are those used for routing; ``strict_stamp`` reads them
    by exact header spelling instead.
    """
    return stamp_route(check_route(messages), processed_at, strict_stamp=strict_stamp)
