"""Topics: Kafka through its connector, or the same rows in files.

Message rows: ``key binary, value binary, topic string, partition int,
offset bigint, timestamp timestamp, headers array<struct<key, value>>``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.events import encode_event
from ..functions.headers import HEADERS_TYPE

MESSAGE = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    f"timestamp timestamp, headers {HEADERS_TYPE}"
)
# Delivery settings of the producer.
PRODUCER = {"kafka.acks": "all", "kafka.compression.type": "lz4"}


def reader_options(bootstrap: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        **(extra or {}),
    }


def writer_options(bootstrap: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "includeHeaders": "true", **PRODUCER, **(extra or {})}


def read_topic(
    spark: SparkSession, bootstrap: str, topic: str, *, streaming: bool, extra: Mapping[str, str] | None = None
) -> DataFrame:
    """Messages of a topic from its beginning. Needs the Kafka connector."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("kafka").options(**reader_options(bootstrap, topic, extra)).load()
    return rows.select("key", "value", "topic", "partition", "offset", "timestamp", "headers")


def read_topic_files(
    spark: SparkSession, path: str, *, streaming: bool, files_per_batch: int | None = None
) -> DataFrame:
    """The same rows from Parquet files."""
    if not streaming:
        return spark.read.schema(MESSAGE).parquet(path)
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_messages(events: DataFrame, topic: str, event: str = "event") -> DataFrame:
    """Events as keyless JSON messages of one topic; existing headers go along."""
    headers = (
        F.col("headers") if "headers" in events.columns else F.array().cast(HEADERS_TYPE)
    )
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        encode_event(F.col(event)).alias("value"),
        F.lit(topic).alias("topic"),
        headers.alias("headers"),
    )


def raw_messages(df: DataFrame) -> DataFrame:
    """Messages passed on as they are: key, value, topic and headers."""
    return df.select("key", "value", "topic", "headers")


def write_messages(df: DataFrame, bootstrap: str, extra: Mapping[str, str] | None = None) -> None:
    """Send messages, each to the topic in its ``topic`` column. Needs the Kafka connector."""
    raw_messages(df).write.format("kafka").options(**writer_options(bootstrap, extra)).save()


def stream_messages(df: DataFrame, bootstrap: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer to Kafka with per-row topics. Needs the Kafka connector."""
    return (
        raw_messages(df)
        .writeStream.format("kafka")
        .options(**writer_options(bootstrap))
        .option("checkpointLocation", checkpoint)
    )


def stream_message_files(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer to Parquet, one folder per target topic."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("topic")
        .outputMode("append")
    )
