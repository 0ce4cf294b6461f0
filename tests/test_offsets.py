"""Offsets of a stream's runs, read from its checkpoint."""

import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wharfline.session import run_folder
from wharfline.streaming.offsets import batch_files, batch_log, delivered, delivery_gaps, topic_ranges
from wharfline.streaming.progress import observed
from wharfline.streaming.runs import run_drain, run_until_idle

SCHEMA = "partition int, offset bigint"


def test_batches_of_a_broken_stream(spark):
    folder = run_folder(spark, "t-offsets")
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).selectExpr("int(id % 2) AS partition", "id AS offset").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    read = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    rows = read.select("partition", "offset", F.col("_metadata.file_path").alias("source_file"))

    def drain(stream):
        run_drain(stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp"))

    broken = F.when(F.col("offset") == 35, F.raise_error(F.lit("x"))).otherwise(F.col("offset")).cast("bigint")
    with pytest.raises(StreamingQueryException):
        drain(rows.withColumn("offset", broken))
    log = {r.batch_id: r.committed for r in batch_log(spark, f"{folder}/cp").collect()}
    assert log == {0: True, 1: True, 2: True, 3: False}
    written = spark.read.parquet(f"{folder}/out")
    sent = spark.read.schema(SCHEMA).parquet(f"{folder}/in")
    assert {(r.partition, r.messages, r.missing, r.doubled) for r in delivery_gaps(sent, written).collect()} == {(0, 15, 15, 0), (1, 15, 15, 0)}
    drain(rows)
    written = spark.read.parquet(f"{folder}/out")
    got = delivered(written, batch_files(spark, f"{folder}/cp")).collect()
    assert len(got) == 12 and {(r.batch_id, r.committed) for r in got} == {(k, True) for k in range(6)}
    assert {(r.partition, r.first_offset, r.last_offset, r.messages) for r in got} == {(p, k * 10 + p, k * 10 + 8 + p, 5) for k in range(6) for p in (0, 1)}
    assert {tuple(r) for r in delivery_gaps(sent, written).collect()} == {(0, 0, 58, 30, 0, 0, 0), (1, 1, 59, 30, 0, 0, 0)}
    twice = written.unionByName(written.where("offset IN (2, 4)")).unionByName(written.limit(1).withColumn("offset", F.lit(99).cast("bigint")).withColumn("partition", F.lit(0)))
    row = delivery_gaps(sent, twice).where("partition = 0").first()
    assert (row.messages, row.doubled, row.missing, row.unknown) == (33, 2, 0, 1)
    assert delivery_gaps(sent.limit(0), written.limit(0)).count() == 0


def test_idle_clock(spark):
    """Rows that come a second before the limit are handled and set the clock back; those not handled don't."""
    folder = run_folder(spark, "t-idle")

    def put(offset, partition):
        spark.range(1).selectExpr(f"{partition} AS partition", f"{offset}L AS offset").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    put(0, 1)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    seen = observed(stream, "totals", handled=F.count_if(F.col("partition") == 1))
    writer = seen.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
    feeds = [threading.Timer(secs, put, (secs, partition)) for secs, partition in ((4, 1), (8, 1), (12, 0), (40, 1))]
    start = time.monotonic()
    for feed in feeds:
        feed.start()
    try:
        query = run_until_idle(writer, 6, "100 milliseconds", ("totals", "handled"))
    finally:
        feeds[-1].cancel()
    took = time.monotonic() - start
    assert not query.isActive and 14 <= took < 25  # 6 seconds after the row of second 8, not after that of second 12
    got = {r.offset for r in spark.read.schema(SCHEMA).parquet(f"{folder}/out").collect()}
    assert got == {0, 4, 8, 12}


def test_idle_run_raises_failures(spark):
    folder = run_folder(spark, "t-idle-bad")
    spark.range(3).selectExpr("1 AS partition", "id AS offset").write.parquet(f"{folder}/in")
    bad = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in").select(F.raise_error(F.lit("x")).alias("e"))
    with pytest.raises(StreamingQueryException):
        run_until_idle(bad.writeStream.format("noop").option("checkpointLocation", f"{folder}/cp"), 5)


def test_topic_ranges(spark):
    log = spark.createDataFrame(
        [(0, 0, '{"a":{"0":5,"1":7}}', True), (1, 0, '{"a":{"0":9,"1":7},"b":{"0":1}}', False), (1, 1, None, False)],
        "batch_id bigint, source int, end_offset string, committed boolean",
    )
    got = {(r.batch_id, r.topic, r.partition): (r.first_offset, r.next_offset, r.committed) for r in topic_ranges(log).collect()}
    assert got == {
        (0, "a", 0): (None, 5, True), (0, "a", 1): (None, 7, True), (1, "a", 0): (5, 9, False), (1, "a", 1): (7, 7, False), (1, "b", 0): (None, 1, False),
    }
