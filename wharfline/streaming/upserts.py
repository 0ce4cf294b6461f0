"""A keyed table kept by a stream: each micro-batch brings the rows that changed, the latest one of a key counts.

An append stream gives a window only once the watermark has passed its end, so a drained stream lacks its last windows.
Here the stream runs in update mode: every batch writes the windows it touched, open or closed, to a folder of its own.
A batch that is repeated replaces itself; nothing is read back or merged while the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .sinks import query_id


def upsert_stream(changes: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Write the changed rows of an aggregation below ``out``, by query and batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"{out}/query={query_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(own)

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def latest(spark: SparkSession, out: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """The table as of the stream's last batch: of each key the row of the highest batch.

    Only what the stream with this checkpoint wrote counts. Keys may be null; a batch holds each key once.
    """
    rows = spark.read.option("basePath", out).parquet(f"{out}/query={query_id(spark, checkpoint)}")
    columns = [c for c in rows.columns if c not in ("query", "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return newest.select("row.*")

