"""The stream forms, run over the tables as file streams until they are drained.

Each run writes to a new folder below the shared one and is read back from there.
"""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators import metrics as m
from ..operators.batches import drain_batches
from ..operators.screening import REASON, decode_documents
from ..session import run_folder
from ..sources.records import LOG, read_log, write_log
from ..sources.topics import MESSAGE, stream_message_files
from ..streaming import stateful as st
from ..streaming.controlled import controlled_stream, status_wait_stream
from ..streaming.files import file_ready_stream
from ..streaming.offsets import batch_files, delivered, delivery_gaps
from ..streaming.progress import StepEvents, event_table, observed, read_events
from ..streaming.runs import run_drain, run_until_idle, run_window
from ..streaming.sinks import route_stream
from ..streaming.upserts import latest, upsert_stream
from . import tables as t
from ..sources.objects import write_objects
from .file_queries import _OBJECTS, _hashes, document_objects
from .metric_queries import DRAIN_GAP, DRAIN_SQL, MISSED_SECS, WINDOW_SQL, log_columns, log_rows, window_rows
from .registry import ORACLES, query
from .run_queries import DECISION_SQL, run_results
from .sql import us, with_
from .topic_queries import FORWARD_SQL, PROCESSED_AT, forwarded


def _drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run an append stream to its end and read back what it wrote."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    run_drain(writer)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@query(FORWARD_SQL)
def stream_forward(spark: SparkSession, sf: str) -> DataFrame:
    return _drain(forwarded(t.messages(spark, sf, streaming=True)), run_folder(spark, "forward"))


@query(
    with_("checked")
    + """SELECT coalesce(target, 'dead letter: ' || reject_reason) AS topic, count(*) AS messages, min("offset") AS first_offset,
  max("offset") AS last_offset FROM checked GROUP BY 1"""
)
def stream_route(spark: SparkSession, sf: str) -> DataFrame:
    """Routed messages and dead letters of one stream."""
    folder = run_folder(spark, "route")
    stream = t.messages(spark, sf, streaming=True)
    run_drain(route_stream(stream, F.lit(PROCESSED_AT), f"{folder}/out", f"{folder}/dead", f"{folder}/checkpoint"))
    good = spark.read.parquet(f"{folder}/out").select("topic", "offset")
    dead = spark.read.parquet(f"{folder}/dead").select(
        F.concat(F.lit("dead letter: "), "reject_reason").alias("topic"), "offset"
    )
    return good.unionByName(dead).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query(
    with_("control_topic")
    + """SELECT partition, min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS messages, 0 AS doubled, 0 AS missing,
  0 AS unknown, true AS all_committed FROM control_topic GROUP BY 1"""
)
def stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """A topic in many files, read by a time box, by a run that fails half way and by one that drains the rest."""
    folder = run_folder(spark, "offsets")
    topic = t.control_topic(spark, sf).select("partition", "offset", "value")
    topic.repartitionByRange(12, "offset").write.parquet(f"{folder}/in")
    read = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    rows = read.select("partition", "offset", F.col("_metadata.file_path").alias("source_file"))
    half = topic.agg(F.max("offset").alias("m")).first().m // 2

    def writer(stream: DataFrame) -> DataStreamWriter:
        options = {"path": f"{folder}/out", "checkpointLocation": f"{folder}/checkpoint"}
        return stream.writeStream.format("parquet").options(**options)

    run_window(writer(rows), 1.5, "100 milliseconds")
    broken = F.when(F.col("offset") == half, F.raise_error(F.lit("half way"))).otherwise(F.col("offset"))
    try:
        run_drain(writer(rows.withColumn("offset", broken.cast("bigint"))))
    except StreamingQueryException:
        pass  # the half may be through already
    run_drain(writer(rows))
    written = spark.read.parquet(f"{folder}/out")
    batches = delivered(written, batch_files(spark, f"{folder}/checkpoint"))
    committed = batches.groupBy("partition").agg(F.bool_and(F.coalesce("committed", F.lit(False))).alias("all_committed"))
    return delivery_gaps(topic, written).join(committed, "partition")


@query(
    """SELECT 'completed' AS event, 2 AS runs, 0::BIGINT AS input_rows UNION ALL
SELECT 'progress', 2, count(*) FROM events UNION ALL SELECT 'started', 2, 0"""
)
def stream_step_log(spark: SparkSession, sf: str) -> DataFrame:
    """The lifecycle of a stream over two runs, from the table its records were moved to."""
    folder = run_folder(spark, "step-log")
    log = StepEvents(spark, f"{folder}/log")
    topic = t.control_topic(spark, sf).select("partition", "offset")
    for turn in range(2):
        topic.where(F.col("offset") % 2 == turn).write.mode("append").parquet(f"{folder}/in")
        spark.streams.addListener(log)
        try:
            stream = spark.readStream.schema(topic.schema).parquet(f"{folder}/in")
            _drain(stream, folder)
            for _ in range(300):  # the last record comes after the run's end
                if read_events(spark, f"{folder}/log").where("event = 'completed'").count() > turn:
                    break
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(log)
        events = event_table(spark, f"{folder}/log", f"{folder}/table", f"{folder}/table-checkpoint")
    return events.groupBy("event").agg(
        F.count_distinct("run_id").cast("int").alias("runs"), F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows")
    )


@query(
    with_("control_checked")
    + """SELECT partition, count(*) AS messages, count(*) FILTER (reason IS NULL) AS handled, min("offset") AS first_offset, max("offset") AS last_offset
FROM control_checked GROUP BY 1"""
)
def stream_until_idle(spark: SparkSession, sf: str) -> DataFrame:
    """A control topic read until nothing was handled for two seconds."""
    folder = run_folder(spark, "until-idle")
    checked = decode_documents(t.control_topic(spark, sf, streaming=True)).select("partition", "offset", REASON)
    stream = observed(checked, "totals", handled=F.count_if(F.col(REASON).isNull()))
    options = {"path": f"{folder}/out", "checkpointLocation": f"{folder}/checkpoint"}
    run_until_idle(stream.writeStream.format("parquet").options(**options), 2, "200 milliseconds", ("totals", "handled"))
    return spark.read.schema(checked.schema).parquet(f"{folder}/out").groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col(REASON).isNull()).alias("handled"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query(
    f"""SELECT severity_number, severity_text, body, resource, attributes, trace_id, epoch_us(e.ts) AS at_us, count(*) AS n
FROM ({ORACLES["log_records"]}) JOIN events e USING (event_id) GROUP BY ALL"""
)
def stream_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log records written as lines and read back as a stream."""
    folder = run_folder(spark, "log")
    rows = log_rows(spark, sf)
    fields = T.StructType.fromDDL(LOG).names
    write_log(rows.select(*[c for c in rows.columns if c in fields]), f"{folder}/lines")
    back = _drain(read_log(spark, f"{folder}/lines", streaming=True), folder)
    return back.select(*log_columns(), F.unix_micros("timestamp").alias("at_us")).groupBy(
        "severity_number", "severity_text", "body", "resource", "attributes", "trace_id", "at_us"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(DRAIN_SQL)
def stream_drain(spark: SparkSession, sf: str) -> DataFrame:
    """A topic drained into files, one folder per topic, then cut into its batches."""
    folder = run_folder(spark, "drain")
    stream = t.messages(spark, sf, streaming=True)
    run_drain(stream_message_files(stream, f"{folder}/out", f"{folder}/checkpoint"))
    landed = spark.read.schema(MESSAGE).parquet(f"{folder}/out")
    return drain_batches(landed, DRAIN_GAP).select(
        "topic",
        "partition",
        "batch_no",
        "messages",
        F.unix_micros("first_at").alias("first_us"),
        F.unix_micros("last_at").alias("last_us"),
        "first_offset",
        "last_offset",
    )


@query(DECISION_SQL)
def stream_triggers(spark: SparkSession, sf: str) -> DataFrame:
    """Trigger decisions by the keyed processor; runs that take no time never overlap."""
    st.use_rocksdb(spark)
    triggers = t.triggers_of(t.table_stream(spark, sf, "orders")).withColumn("duration_us", F.lit(0).cast("bigint"))
    decided = _drain(st.trigger_processor(triggers), run_folder(spark, "triggers"))
    return decided.select("product", "stage", "offset", "run_id", "mode", "decision")


_LATE = 10
_LAST = "(SELECT max(k) FROM runs)"
_CLOSED = f"k * 60 + 600 < {_LAST} * 60 - {_LATE}"


@query(
    with_("awaited")
    + """SELECT "offset", run_id, stage, product, coalesce(status_offset, -1) AS status_offset, status, outcome
FROM awaited WHERE run_id IS NOT NULL"""
)
def stream_await_status(spark: SparkSession, sf: str) -> DataFrame:
    """Triggers that wait for their status; closing rows push the clock past the last deadline.

    Statuses come in log order after their trigger, so the first one within the
    deadline is the first at or after the start offset.
    """
    st.use_rocksdb(spark)
    folder = run_folder(spark, "await")
    asks = t.triggers(spark, sf).where(F.col("run_id").isNotNull()).select(
        "run_id", "stage", "product", "offset", "start_offset", "timestamp"
    )
    replies = t.statuses(spark, sf).select("partition", "run_id", "stage", "product", "offset", "status", "timestamp")

    waiting = status_wait_stream(_closed(asks, f"{folder}/asks"), _closed(replies, f"{folder}/replies"), 600)
    answers = _drain(waiting, folder).where("run_id <> 'closing'")
    return answers.select(
        F.col("trigger_offset").alias("offset"),
        "run_id",
        "stage",
        "product",
        F.coalesce("status_offset", F.lit(-1)).alias("status_offset"),
        "status",
        "outcome",
    )


def _closed(rows: DataFrame, folder: str) -> DataFrame:
    """The rows, then two closing rows long after, as a stream of three batches; the last lets the timers see the clock."""
    last = rows.agg(F.max("timestamp").alias("at"))
    rows.write.parquet(f"{folder}/part=1")
    for part in (2, 3):
        closing = last.select(
            *[
                (F.col("at") + F.expr(f"INTERVAL {part * 30} DAYS") if f.name == "timestamp" else F.lit("closing") if f.name == "run_id" else F.lit(0).cast(f.dataType) if f.name in ("partition", "start_offset", "offset") else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in rows.schema.fields
            ]
        )
        closing.coalesce(1).write.parquet(f"{folder}/part={part}")
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())])
    return rows.sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(folder).drop("part")


_RUN_SECS = 900


@query(
    with_("decided", "statuses")
    + f"""SELECT d.product, d.stage, d.decision, CASE WHEN d.decision <> 'execute' THEN d.decision ELSE coalesce(r.run_status, 'timeout') END AS status,
  CASE WHEN d.decision = 'execute' THEN CASE WHEN r.run_status IS NULL THEN 'no result in time' ELSE r.run_error END END AS error, count(*) AS runs,
  sum(CASE WHEN d.decision = 'execute' THEN coalesce(r.took, {_RUN_SECS * 1_000_000}) ELSE 0 END)::BIGINT AS total_us
FROM decided d LEFT JOIN (SELECT k AS "offset", CASE WHEN c % 11 = 0 THEN 'failed' ELSE 'completed' END AS run_status,
    CASE WHEN c % 11 = 0 THEN 'ValueError: bad input' END AS run_error, c % 40 * 20000000 AS took FROM runs WHERE c % 9 <> 0) r USING ("offset")
GROUP BY 1, 2, 3, 4, 5"""
)
def stream_controlled_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Trigger, decide, run, answer as a stream; runs that never gave a result are timed out."""
    st.use_rocksdb(spark)
    folder = run_folder(spark, "controlled")
    triggers = t.triggers(spark, sf).where("run_id IS NOT NULL").select("product", "stage", "partition", "offset", "run_id", "execution_mode", "timestamp")
    results = run_results(spark, sf).join(triggers.select("partition", "offset", "product", "stage", "timestamp"), ["partition", "offset"])
    results = results.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=F.col("duration_us") / 1_000_000))
    answers = _drain(controlled_stream(_closed(triggers, f"{folder}/triggers"), _closed(results, f"{folder}/results"), _RUN_SECS), folder)
    told = answers.where("kind = 'status' AND product IS NOT NULL")
    return told.groupBy("product", "stage", "decision", "status", "error").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.round(F.col("duration_ms") * 1000).cast("bigint")).alias("total_us")
    )


_WM = 600  # seconds the metric stream waits for late points


@query(with_("points") + WINDOW_SQL)
def stream_metric_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All export windows of a drained stream, open ones too: each batch upserts the windows it touched."""
    folder = run_folder(spark, "windows")
    windows = m.metric_windows(t.points(spark, sf, streaming=True), 60, f"{_WM} seconds")
    run_drain(upsert_stream(windows, f"{folder}/out", f"{folder}/checkpoint"))
    return window_rows(latest(spark, f"{folder}/out", f"{folder}/checkpoint", ["window_start", "name"]))


@query(
    with_("beats")
    + f"""SELECT component, {us("ts")} AS last_seen_us FROM (SELECT *, lead(ts) OVER (PARTITION BY component ORDER BY ts, event_id) AS nx FROM beats)
WHERE epoch_us(nx) - epoch_us(ts) > {MISSED_SECS * 1_000_000 + 60_000_000}
   OR (nx IS NULL AND epoch_us(ts) + {MISSED_SECS * 1_000_000 + 60_000_000} < (SELECT max(epoch_us(ts)) FROM beats) - 10000000)"""
)
def stream_missed_heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """Alarms of the heartbeat watch, by timers on event time."""
    st.use_rocksdb(spark)
    alarms = st.missed_heartbeats_stream(t.beats(spark, sf, streaming=True), MISSED_SECS, 60)
    return _drain(alarms, run_folder(spark, "alarms")).select("component", "last_seen_us")


@query(f"SELECT object_key, 1::BIGINT AS copies, 1::BIGINT AS events, md5(body) AS hash FROM {_OBJECTS}")
def stream_file_ready(spark: SparkSession, sf: str) -> DataFrame:
    """New objects are copied and announced as they appear: half of them, then the rest under a new checkpoint.

    The second stream writes below the same folder; nothing of the first one is replayed or lost.
    """
    root = run_folder(spark, "ready")
    objects, src, dst = document_objects(spark, sf), f"{root}/source", f"{root}/target"
    for n in (0, 1):
        half = objects.where(F.col("doc_id") % 2 == n)
        write_objects(half, src).write.parquet(f"{root}/written-{n}")
        run_drain(file_ready_stream(spark, src, dst, f"{root}/out", f"{root}/checkpoint-{n}", container="target"))
    results = spark.read.parquet(f"{root}/out/query=*/cycle=*/results").where("copied")
    events = spark.read.parquet(f"{root}/out/query=*/cycle=*/events").select(
        F.from_json(F.col("value").cast("string"), "path string")["path"].alias("object_key")
    )
    count = F.count(F.lit(1))
    met = results.groupBy("object_key").agg(count.alias("copies"))
    met = met.join(events.groupBy("object_key").agg(count.alias("events")), "object_key", "full")
    return met.join(_hashes(spark, dst).select("object_key", "hash"), "object_key", "full")
