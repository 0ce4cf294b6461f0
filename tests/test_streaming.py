"""Run modes, restarts, keyed processors and progress; streams must equal batches."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wharfline.functions.headers import header_exact
from wharfline.plans.topic_flow import forward
from wharfline.session import run_folder
from wharfline.sources.topics import MESSAGE, read_topic_files, stream_message_files
from wharfline.streaming import runs
from wharfline.streaming.files import file_cycle
from wharfline.streaming.progress import StepEvents, deliveries, event_table, observed, read_events
from wharfline.streaming.sinks import route_stream
from wharfline.streaming.stateful import missed_heartbeats_stream, trigger_processor, use_rocksdb

T0 = datetime(2026, 1, 1)


def put(spark, folder, first, n):
    """A file of topic messages."""
    rows = [
        (b"k", b"v", "src", 0, i, T0 + timedelta(seconds=i), [("schema_type", b"eq" if i % 4 else b""), ("org_name", b"o"), ("product_type", b"p")])
        for i in range(first, first + n)
    ]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def test_drain_restarts_from_its_checkpoint(spark):
    folder = run_folder(spark, "t-drain")
    put(spark, f"{folder}/in", 0, 10)

    def drain():
        stream = forward(read_topic_files(spark, f"{folder}/in", streaming=True, files_per_batch=1), "mapper")
        return runs.run_drain(stream_message_files(stream, f"{folder}/out", f"{folder}/cp"))

    drain()
    put(spark, f"{folder}/in", 10, 5)
    drain()
    drain()
    got = spark.read.parquet(f"{folder}/out")
    assert sorted(r.offset for r in got.select("offset").collect()) == list(range(15))
    batch = forward(read_topic_files(spark, f"{folder}/in", streaming=False), "mapper")
    trace = header_exact("headers", "traceparent")
    assert sorted(got.select("offset", trace).collect()) == sorted(batch.select("offset", trace).collect())


def test_route_stream_splits_and_repeats_safely(spark):
    folder = run_folder(spark, "t-route")
    put(spark, f"{folder}/in", 0, 40)
    for n in (1, 2):  # a second checkpoint is a query of its own: it adds its rows and erases none
        stream = read_topic_files(spark, f"{folder}/in", streaming=True)
        runs.run_drain(route_stream(stream, F.lit("t"), f"{folder}/out", f"{folder}/dead", f"{folder}/cp{n}"))
    good, dead = spark.read.parquet(f"{folder}/out"), spark.read.parquet(f"{folder}/dead")
    assert good.count() == 60 and dead.count() == 20
    assert {r.topic for r in good.select("topic").collect()} == {"dpn-consumer-o-eq-p-target"}
    assert {r.reject_reason for r in dead.collect()} == {"unknown metadata: schema_type"}


def test_window_and_interval_runs(spark):
    folder = run_folder(spark, "t-window")
    put(spark, f"{folder}/in", 0, 10)
    stream = read_topic_files(spark, f"{folder}/in", streaming=True)
    start = time.time()
    query = runs.run_window(stream_message_files(stream, f"{folder}/out", f"{folder}/cp"), 8)
    assert 7 < time.time() - start < 60 and not query.isActive
    assert spark.read.parquet(f"{folder}/out").count() == 10
    query = runs.run_interval(stream_message_files(stream, f"{folder}/out2", f"{folder}/cp2"), 3600)
    try:  # the first cycle starts at once; the next one would come in an hour
        deadline = time.time() + 60
        while not (query.lastProgress and query.lastProgress.numInputRows) and time.time() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert spark.read.parquet(f"{folder}/out2").count() == 10


def test_forever_restarts_after_failures(spark):
    folder = run_folder(spark, "t-forever")
    put(spark, f"{folder}/in", 0, 10)
    seen = []

    def write(batch, batch_id):
        seen.append(batch_id)
        if len(seen) < 3:
            raise RuntimeError("broker away")
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    def writer():
        stream = read_topic_files(spark, f"{folder}/in", streaming=True)
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True)

    assert runs.run_forever(writer, retry_secs=0) == 2
    assert seen == [0, 0, 0] and spark.read.parquet(f"{folder}/out").count() == 10

    def broken():
        bad = read_topic_files(spark, f"{folder}/in", streaming=True).select(F.raise_error(F.lit("x")))
        return bad.writeStream.format("noop").option("checkpointLocation", f"{folder}/cp2").trigger(availableNow=True)

    with pytest.raises(StreamingQueryException):
        runs.run_forever(broken, retry_secs=0, keep_going=lambda n: n < 2)


def test_progress_records(spark):
    folder = run_folder(spark, "t-progress")
    log = StepEvents(spark, f"{folder}/log")
    table = (spark, f"{folder}/log", f"{folder}/table", f"{folder}/log-cp")
    for turn in (1, 2):  # the second run reads the table that the first one began
        put(spark, f"{folder}/in", turn * 100, turn * 10)
        spark.streams.addListener(log)
        try:
            stream = observed(read_topic_files(spark, f"{folder}/in", streaming=True), "totals", handled=F.count(F.lit(1)))
            runs.run_drain(stream_message_files(stream, f"{folder}/out", f"{folder}/cp"))
            for _ in range(100):
                if read_events(spark, f"{folder}/log").where("event = 'completed'").count() == turn:
                    break
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(log)
        events = event_table(*table, clean=turn == 2)
        assert events.where("event = 'started'").count() == turn
        assert {r.observed["totals.handled"] for r in events.where("input_rows > 0").collect()} == ({"10"} if turn == 1 else {"10", "20"})
        assert {(r.rows, r.failed) for r in deliveries(events).collect()} == ({(10, False)} if turn == 1 else {(10, False), (20, False)})
    assert event_table(*table).count() == events.count()  # nothing new, nothing twice


def loop(rows):
    """The runner, one trigger at a time, with its guard."""
    state, out = {}, {}
    for product, stage, _, offset, run, mode, start, took in sorted(rows, key=lambda r: r[3]):
        last, busy = state.get((product, stage), (None, None))
        if busy is not None and start < busy:
            out[offset] = "failed"
        elif run == last:
            out[offset] = "completed"
        elif (mode or "").strip().lower() == "manual":
            out[offset] = "skipped"
        else:
            out[offset] = "execute"
            state[product, stage] = (run, start + took)
    return out


def test_trigger_processor_matches_the_loop_over_batches_and_restarts(spark):
    use_rocksdb(spark)
    rng = random.Random(9)
    rows = [
        ("hot" if rng.random() < 0.5 else rng.choice("pq"), rng.choice("st"), 0, i, f"r{rng.randint(0, 3)}",
         rng.choice(["manual", None, "automatic"]), i * 10, rng.choice([0, 5, 40]))
        for i in range(400)
    ]
    schema = (
        "product string, stage string, partition int, offset bigint, run_id string, execution_mode string, "
        "start_us bigint, duration_us bigint"
    )
    folder = run_folder(spark, "t-triggers")
    for part in range(4):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schema).coalesce(2).write.mode("append").parquet(f"{folder}/in")
        stream = trigger_processor(spark.readStream.schema(schema).parquet(f"{folder}/in"))
        runs.run_drain(
            stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        )
    got = {r.offset: r.decision for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == loop(rows)


def test_heartbeat_alarms(spark):
    use_rocksdb(spark)
    folder = run_folder(spark, "t-beats")
    schema = "component string, ts timestamp"
    sec = lambda s: T0 + timedelta(seconds=s)
    for batch in ([("a", 0), ("b", 0), ("a", 300)], [("a", 1500), ("b", 295)], [("c", 9000)]):
        spark.createDataFrame([(c, sec(s)) for c, s in batch], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        alarms = missed_heartbeats_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), 300, 60)
        runs.run_drain(
            alarms.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        )
    got = spark.read.parquet(f"{folder}/out").selectExpr("component", "timestamp_micros(last_seen_us) t").collect()
    assert sorted(map(tuple, got)) == [("a", sec(300)), ("a", sec(1500)), ("b", sec(295))]


def test_file_cycle_can_be_repeated(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.txt").write_bytes(b"abc")
    (tmp_path / "src/empty").write_bytes(b"")
    args = (spark, str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "out"))
    for cycle in ("0", "0"):  # the same cycle again gives the same events
        got = file_cycle(*args, cycle, container="t", tasks=2)
        assert {r.object_key: r.copied for r in got.collect()} == {"a.txt": True, "empty": True}
        assert spark.read.parquet(str(tmp_path / "out/cycle=0/events")).count() == 2
    assert {r.skipped for r in file_cycle(*args, "1", container="t", tasks=2).collect()} == {True}
