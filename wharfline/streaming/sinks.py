"""Sinks that split a micro-batch. Each batch of each query owns a folder, so a repeated batch replaces itself alone."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..operators.screening import dead_letters
from ..plans.topic_flow import check_route, stamp_route


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps in its checkpoint over restarts; it is there before the first batch runs."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def split_stream(
    checked: DataFrame,
    good: Callable[[DataFrame], DataFrame],
    out: str,
    dead: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Write accepted rows below ``out``, a folder per topic, and rejected ones below ``dead``.

    The batch is cached, as both writes read it. Before the write, rows are rebalanced by topic: small
    topics share tasks, a hot one is split by its size. Several queries may write below one ``out``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"query={query_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        batch.persist()
        try:
            accepted = good(batch).hint("rebalance", "topic")
            accepted.write.mode("overwrite").partitionBy("topic").parquet(f"{out}/{own}")
            dead_letters(batch).write.mode("overwrite").parquet(f"{dead}/{own}")
        finally:
            batch.unpersist()

    return checked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def route_stream(
    messages: DataFrame, processed_at: Column, out: str, dead: str, checkpoint: str
) -> DataStreamWriter:
    """Route each message to the topic its headers name; the rest are dead letters."""

    def good(batch: DataFrame) -> DataFrame:
        return stamp_route(batch, processed_at)

    return split_stream(check_route(messages), good, out, dead, checkpoint)
