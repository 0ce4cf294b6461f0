"""Structured logs as one JSON document per line, and metric export lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = (
    "timestamp timestamp, observed_timestamp timestamp, severity_number int, severity_text string, "
    "body string, resource map<string,string>, attributes map<string,string>, "
    "trace_id string, span_id string, trace_flags string"
)


def log_lines(records: DataFrame) -> DataFrame:
    """One JSON document per record."""
    stamp = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return records.select(F.to_json(F.struct(*records.columns), stamp).alias("value"))


def write_log(records: DataFrame, path: str) -> None:
    log_lines(records).write.text(path)


def read_log(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LOG).json(path)


def write_metric_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.text(path)
