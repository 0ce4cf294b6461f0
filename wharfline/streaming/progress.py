"""Progress of streams as step events."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .runs import run_drain

STEP_EVENTS = (
    "run_id string, operation string, event string, at string, batch_id bigint, "
    "input_rows bigint, duration_ms double, observed map<string,string>, error_message string"
)


def observed(df: DataFrame, name: str, **totals: Column) -> DataFrame:
    """Count on the fly what passes; the totals show up in the progress records."""
    return df.observe(name, *[c.alias(n) for n, c in totals.items()])


class StepEvents(StreamingQueryListener):
    """Appends one small record per query start, micro-batch and end to a log folder.

    Each record is a folder with one JSON file, written by Spark, so any file system will do and
    nothing is held on the driver. ``event_table`` makes a table of the records.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def _add(self, *row) -> None:
        record = self._spark.createDataFrame([row], STEP_EVENTS).coalesce(1)
        record.write.option("ignoreNullFields", "true").json(f"{self._path}/{uuid.uuid4().hex}")

    def onQueryStarted(self, event) -> None:
        self._add(str(event.runId), event.name, "started", str(event.timestamp), None, None, None, None, None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = {f"{n}.{k}": str(v) for n, r in p.observedMetrics.items() for k, v in r.asDict().items()}
        took = float(p.durationMs.get("triggerExecution", 0))
        self._add(str(p.runId), p.name, "progress", p.timestamp, p.batchId, p.numInputRows, took, seen, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = "failed" if event.exception else "completed"
        self._add(str(event.runId), None, name, None, None, None, None, None, event.exception)


def read_events(spark: SparkSession, path: str, *, streaming: bool = False, clean: bool = False) -> DataFrame:
    """The records of a log folder; ``clean`` deletes a file once a stream has finished the batch after its own."""
    reader = spark.readStream if streaming else spark.read
    if clean:
        reader = reader.option("cleanSource", "delete")
    return reader.schema(STEP_EVENTS).json(f"{path}/*")


def event_table(spark: SparkSession, path: str, table: str, checkpoint: str, *, clean: bool = False) -> DataFrame:
    """Move what is new in a log folder into a table of few files, each record once, also after a restart."""
    stream = read_events(spark, path, streaming=True, clean=clean).coalesce(1)
    run_drain(stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint))
    return spark.read.schema(STEP_EVENTS).parquet(table)


def deliveries(events: DataFrame) -> DataFrame:
    """Totals per run: micro-batches, rows and whether it failed."""
    return events.groupBy("run_id").agg(
        F.count_if(F.col("event") == "progress").alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.bool_or(F.col("event") == "failed"), F.lit(False)).alias("failed"),
    )
