"""What a stream's runs have read and finished, taken from its checkpoint as tables.

Spark keeps the last ``spark.sql.streaming.minBatchesToRetain`` batches (100) of the offset and commit logs, and all
names of a file source. Read the logs often enough, or raise the setting, where older batches matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    """batch_id and lines of every entry of a log folder; names that are no number are passed over."""
    rows = spark.read.text(folder, wholetext=True)
    batch = F.col("_metadata.file_name").try_cast("bigint")
    return rows.select(batch.alias("batch_id"), F.split("value", "\n").alias("lines")).where("batch_id IS NOT NULL")


def batch_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per batch and source: batch_id, source (0, 1, ...), end_offset (JSON text, null for none), committed."""
    planned = _entries(spark, f"{checkpoint}/offsets")
    done = _entries(spark, f"{checkpoint}/commits").select("batch_id", F.lit(True).alias("committed"))
    # a version line and a line of metadata come first
    ends = planned.select("batch_id", F.posexplode(F.slice("lines", 3, F.greatest(F.size("lines") - 2, F.lit(0)))).alias("source", "end"))
    return ends.join(done, "batch_id", "left").select(
        "batch_id", "source", F.nullif("end", F.lit("-")).alias("end_offset"), F.coalesce("committed", F.lit(False)).alias("committed")
    )


def topic_ranges(log: DataFrame) -> DataFrame:
    """First and next offset of every batch, topic and partition of a topic source.

    The first is null in the oldest batch that is kept: where it began isn't in the log.
    """
    ends = log.select("batch_id", "source", "committed", F.explode(F.from_json("end_offset", "map<string,map<string,bigint>>")).alias("topic", "ends"))
    each = ends.select("batch_id", "source", "committed", "topic", F.explode("ends").alias("partition", "next_offset"))
    earlier = Window.partitionBy("source", "topic", "partition").orderBy("batch_id")
    return each.select(
        "batch_id", "source", "topic", F.col("partition").cast("int").alias("partition"), F.lag("next_offset").over(earlier).alias("first_offset"), "next_offset", "committed"
    )


def file_name(path: Column | str) -> Column:
    """One spelling of a local file's address."""
    return F.regexp_replace(F.col(path) if isinstance(path, str) else path, "^file:/+", "file:/")


def batch_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """Files of a file source by the batch that reads them: file, batch_id, committed.

    A file that was noticed, but is in no planned batch yet, has a null batch.
    """
    lines = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId bigint")
    named = lines.select(file_name(entry["path"]).alias("file"), entry["batchId"].alias("noticed")).distinct()
    ends = batch_log(spark, checkpoint).where(F.col("source") == source)
    end = F.from_json("end_offset", "logOffset bigint")["logOffset"]
    ranges = ends.select("batch_id", "committed", end.alias("last"), F.coalesce(F.lag(end).over(Window.orderBy("batch_id")), F.lit(-1)).alias("before"))
    turns = ranges.where("last > before").select("batch_id", "committed", F.explode(F.sequence(F.col("before") + 1, F.col("last"))).alias("noticed"))
    return named.join(turns, "noticed", "left").select("file", "batch_id", "committed")


def delivered(written: DataFrame, files: DataFrame, keys: Sequence[str] = ("partition",), offset: str = "offset") -> DataFrame:
    """First and last offset that each batch wrote per partition. ``written`` names each row's file in ``source_file``."""
    named = written.select(*keys, F.col(offset).alias("__offset"), file_name("source_file").alias("file"))
    return (
        named.join(files, "file", "left")
        .groupBy("batch_id", "committed", *keys)
        .agg(F.min("__offset").alias("first_offset"), F.max("__offset").alias("last_offset"), F.count(F.lit(1)).alias("messages"))
    )


def delivery_gaps(expected: DataFrame, written: DataFrame, keys: Sequence[str] = ("partition",), offset: str = "offset") -> DataFrame:
    """Per partition: messages, those written more than once, those missing, and those that nobody sent."""
    def counted(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, F.col(offset).alias("__offset"), *[F.lit(int(side == s)).alias(s) for s in ("sent", "got")])

    both = counted(expected, "sent").unionByName(counted(written, "got"))
    each = both.groupBy(*keys, "__offset").agg(F.sum("sent").alias("sent"), F.sum("got").alias("got"))
    here = F.col("got") > 0
    return each.groupBy(*keys).agg(
        F.min(F.when(here, F.col("__offset"))).alias("first_offset"),
        F.max(F.when(here, F.col("__offset"))).alias("last_offset"),
        F.sum("got").alias("messages"),
        F.sum(F.greatest(F.col("got") - F.greatest("sent", F.lit(1)), F.lit(0))).alias("doubled"),
        F.sum(F.greatest(F.col("sent") - F.col("got"), F.lit(0))).alias("missing"),
        F.count_if(F.col("sent") == 0).alias("unknown"),
    )
