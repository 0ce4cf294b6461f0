"""Steps, counters, histograms, heartbeats, batches, windows, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.context import log_record, whole_ms
from ..functions.objects import provider_label
from ..functions.text import json_of_map
from ..operators import metrics as m
from ..operators.batches import drain_batches as batches
from ..operators.heartbeats import heartbeats as number_beats
from ..operators.heartbeats import missed_heartbeats as missed
from ..operators.ordered import row_chunks
from ..operators.screening import REASON, decode_documents
from ..operators.steps import step_durations as durations
from ..operators.steps import timed_steps
from ..plans.topic_flow import check_route
from . import tables as t
from .registry import query
from .sql import us, with_


@query(
    with_("timed") + "SELECT event_id, run_id, operation, event, duration_ms FROM timed"
)
def step_durations(spark: SparkSession, sf: str) -> DataFrame:
    return durations(t.step_events(spark, sf)).select("event_id", "run_id", "operation", "event", "duration_ms")


_TAGS = "stage, type, role, operation, mode"


@query(
    with_("steps", "timed")
    + f"""SELECT {_TAGS}, count(*) FILTER (event = 'started') AS started, count(*) FILTER (event = 'completed') AS completed,
  count(*) FILTER (event = 'failed') AS failed, count(*) FILTER (event = 'skipped') AS skipped,
  arg_max(duration_ms, (ts, event_id)) FILTER (event IN ('completed', 'failed')) AS last_duration_ms
FROM (SELECT s.*, t.duration_ms FROM steps s LEFT JOIN timed t USING (event_id)) GROUP BY {_TAGS}"""
)
def step_stats(spark: SparkSession, sf: str) -> DataFrame:
    return m.step_stats(timed_steps(t.step_events(spark, sf)))


@query(
    with_("timed")
    + """SELECT 'pipeline.step.duration_ms|#stage:' || stage || ',type:' || type || ',role:' || role || ',operation:' || operation
  || ',mode:' || mode || ':' || printf('%.3f', duration_ms) || '|g' AS value FROM timed
UNION ALL SELECT 'pipeline.step.' || event || '|#stage:' || stage || ',type:' || type || ',role:' || role || ',operation:' || operation
  || ',mode:' || mode || ':1|c' FROM timed"""
)
def metric_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Export lines of every finished step: its gauge and its counter."""
    ended = durations(t.step_events(spark, sf))
    tags = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in m.STEP_TAGS])
    gauge = F.struct(
        F.lit("pipeline.step.duration_ms").alias("name"), F.lit("gauge").alias("kind"), F.col("duration_ms").alias("value")
    )
    count = F.struct(
        F.concat(F.lit("pipeline.step."), "event").alias("name"), F.lit("counter").alias("kind"), F.lit(1.0).alias("value")
    )
    points = ended.select(tags.alias("tags"), F.explode(F.array(gauge, count)).alias("p")).select("tags", "p.*")
    return m.metric_lines(points)


@query(
    with_("steps")
    + """SELECT operation AS function, CASE WHEN error_type IS NULL THEN 'success' ELSE 'error' END AS status, error_type, count(*) AS calls,
  sum(duration_us)::BIGINT AS total_us, max(duration_us) AS max_us FROM steps GROUP BY 1, 2, 3"""
)
def call_stats(spark: SparkSession, sf: str) -> DataFrame:
    return m.call_stats(t.step_events(spark, sf).withColumn("function", F.col("operation")))


@query(
    with_("points")
    + """SELECT name, attributes, round(sum(value), 2) AS total, count(*) AS points FROM points WHERE kind = 'counter' GROUP BY 1, 2"""
)
def counters(spark: SparkSession, sf: str) -> DataFrame:
    return m.counters(t.points(spark, sf)).select(
        "name", json_of_map("attributes").alias("attributes"), F.round("total", 2).alias("total"), "points"
    )


@query(
    with_("points")
    + "SELECT name, attributes, round(sum(value), 2) AS level FROM points WHERE kind = 'updown' GROUP BY 1, 2"
)
def updown(spark: SparkSession, sf: str) -> DataFrame:
    return m.updown(t.points(spark, sf)).select(
        "name", json_of_map("attributes").alias("attributes"), F.round("level", 2).alias("level")
    )


def _bucket_sql() -> str:
    edges = [None, *m.DEFAULT_BOUNDS, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        tests = [f"value > {low}"] if low is not None else []
        tests += [f"value <= {high}"] if high is not None else []
        parts.append(f"count(*) FILTER ({' AND '.join(tests)})")
    return " || ',' || ".join(parts)


@query(
    with_("points")
    + f"""SELECT name, attributes, count(*) AS count, round(sum(value), 2) AS sum, min(value) AS min, max(value) AS max,
  {_bucket_sql()} AS buckets FROM points WHERE kind = 'histogram' GROUP BY 1, 2"""
)
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return m.histogram(t.points(spark, sf)).select(
        "name",
        json_of_map("attributes").alias("attributes"),
        "count",
        F.round("sum", 2).alias("sum"),
        "min",
        "max",
        F.array_join(F.col("buckets").cast("array<string>"), ",").alias("buckets"),
    )


@query(
    with_("beats")
    + f"""SELECT event_id, component, row_number() OVER (PARTITION BY component, started_at ORDER BY ts, event_id) AS sequence,
  ({us("ts")} - {us("started_at")}) // 1000000 AS uptime_seconds, 'healthy' AS status FROM beats"""
)
def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    return number_beats(t.beats(spark, sf)).select("event_id", "component", "sequence", "uptime_seconds", "status")


MISSED_SECS = 6 * 3600


@query(
    with_("beats")
    + f"""SELECT component, {us("ts")} AS last_seen_us, gap AS gap_us, gap // {MISSED_SECS * 1_000_000} AS missed
FROM (SELECT *, {us("lead(ts) OVER (PARTITION BY component ORDER BY ts, event_id)")} - {us("ts")} AS gap FROM beats)
WHERE gap > {MISSED_SECS * 1_000_000 + 60_000_000}"""
)
def missed_heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    return missed(t.beats(spark, sf), MISSED_SECS, 60).select(
        "component", F.unix_micros("last_seen").alias("last_seen_us"), "gap_us", "missed"
    )


def _drain_sql(gap: int) -> str:
    return (
        with_("messages")
        + f"""SELECT topic, partition, batch_no, count(*) AS messages, {us('min("timestamp")')} AS first_us, {us('max("timestamp")')} AS last_us,
  min("offset") AS first_offset, max("offset") AS last_offset
FROM (SELECT *, sum(opens) OVER (PARTITION BY topic, partition ORDER BY "timestamp", "offset")::BIGINT AS batch_no
  FROM (SELECT topic, partition, "offset", "timestamp", CASE WHEN coalesce({us('"timestamp"')} - {us('lag("timestamp") OVER (PARTITION BY topic, partition ORDER BY "timestamp", "offset")')}, {gap * 1_000_000}) >= {gap * 1_000_000} THEN 1 ELSE 0 END AS opens
    FROM messages)) GROUP BY 1, 2, 3"""
    )


DRAIN_GAP = 3600
DRAIN_SQL = _drain_sql(DRAIN_GAP)


def drained(spark: SparkSession, sf: str, gap: int) -> DataFrame:
    return drained_rows(batches(t.messages(spark, sf), gap))


def drained_rows(found: DataFrame) -> DataFrame:
    return found.select(
        "topic",
        "partition",
        "batch_no",
        "messages",
        F.unix_micros("first_at").alias("first_us"),
        F.unix_micros("last_at").alias("last_us"),
        "first_offset",
        "last_offset",
    )


@query(_drain_sql(15))
def drain_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches cut at the default silence."""
    return drained(spark, sf, 15)


@query(DRAIN_SQL)
def drain_batches_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Batches cut at an hour of silence."""
    return drained(spark, sf, DRAIN_GAP)


CHUNK_ROWS = 1000


@query(
    with_("messages")
    + f"""SELECT partition, chunk, sum(n)::BIGINT AS messages, min(first_us) AS first_us, max(last_us) AS last_us
FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY partition ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // {CHUNK_ROWS} AS chunk
  FROM (SELECT partition, {us('"timestamp"')} // 86400000000 AS day, count(*) AS n, min({us('"timestamp"')}) AS first_us, max({us('"timestamp"')}) AS last_us
    FROM messages GROUP BY 1, 2)) GROUP BY 1, 2"""
)
def chunk_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """How a topic's partitions are cut by counted rows: by day, after every thousand messages."""
    cut = row_chunks(t.messages(spark, sf).select("partition", "timestamp"), ["partition"], "timestamp", CHUNK_ROWS, 86_400)
    return cut.groupBy("partition", "chunk").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min(F.unix_micros("timestamp")).alias("first_us"),
        F.max(F.unix_micros("timestamp")).alias("last_us"),
    )


@query(DRAIN_SQL)
def drain_batches_by_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Batches cut at an hour of silence, found in chunks bounded by rows."""
    cut = row_chunks(t.messages(spark, sf).select("topic", "partition", "offset", "timestamp"), ["topic", "partition"], "timestamp", CHUNK_ROWS)
    return drained_rows(batches(cut, DRAIN_GAP, chunk=F.col("chunk")))


@query(
    with_("control_checked")
    + f"""SELECT partition, batch_no, count(*) AS messages, count(*) FILTER (handled) AS handled, min(at_us) AS first_us, max(at_us) AS last_us,
  min("offset") AS first_offset, max("offset") AS last_offset
FROM (SELECT *, (sum(CASE WHEN handled AND quiet THEN 1 ELSE 0 END) OVER w + CASE WHEN quiet AND NOT handled THEN 1 ELSE 0 END)::BIGINT AS batch_no
  FROM (SELECT *, coalesce(at_us - max(CASE WHEN handled THEN at_us END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= {DRAIN_GAP * 1_000_000}, true) AS quiet
    FROM (SELECT partition, "offset", {us('"timestamp"')} AS at_us, reason IS NULL AS handled FROM control_checked)
    WINDOW w AS (PARTITION BY partition ORDER BY at_us, "offset"))
  WINDOW w AS (PARTITION BY partition ORDER BY at_us, "offset")) GROUP BY 1, 2"""
)
def drain_batches_handled(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of a topic where more than half of the messages can't be handled and leave the clock alone."""
    checked = decode_documents(t.control_topic(spark, sf))
    return batches(checked, DRAIN_GAP, handled=F.col(REASON).isNull()).select(
        "partition",
        "batch_no",
        "messages",
        "handled",
        F.unix_micros("first_at").alias("first_us"),
        F.unix_micros("last_at").alias("last_us"),
        "first_offset",
        "last_offset",
    )


@query(
    with_("checked")
    + """SELECT epoch_us("timestamp") // 600000000 * 600000000 AS window_us, count(*) AS processed, count(target) AS forwarded,
  count(*) - count(target) AS skipped FROM checked GROUP BY 1"""
)
def window_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of each ten-minute run."""
    checked = check_route(t.messages(spark, sf))
    totals = m.window_totals(checked, "timestamp", 600, F.col("target").isNotNull())
    return totals.select(F.unix_micros("window_start").alias("window_us"), "processed", "forwarded", "skipped")


WINDOW_SQL = """SELECT epoch_us(ts) // 60000000 * 60000000 AS window_us, name, round(sum(value), 2) AS total, count(*) AS points
FROM points GROUP BY 1, 2"""


def window_rows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.unix_micros("window_start").alias("window_us"), "name", F.round("total", 2).alias("total"), "points"
    )


@query(with_("points") + WINDOW_SQL)
def metric_windows(spark: SparkSession, sf: str) -> DataFrame:
    return window_rows(m.metric_windows(t.points(spark, sf), 60))


@query(
    """SELECT event_id, CASE event_type WHEN 'error' THEN 17 WHEN 'view' THEN 5 WHEN 'purchase' THEN 13 WHEN 'signup' THEN 21 ELSE 9 END AS severity_number,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' WHEN 'purchase' THEN 'WARN' WHEN 'signup' THEN 'FATAL' ELSE 'INFO' END AS severity_text,
  'handled ' || props AS body, '{"service.name":"exchange","service.version":"1.0.0"}' AS resource,
  '{"code.filepath":"/app/main.py","code.function":"run","code.lineno":"' || event_id % 400 || '"'
  || CASE WHEN event_type = 'error' THEN ',"exception.message":"code ' || event_id % 5 || '","exception.type":"ValueError"' ELSE '' END
  || ',"file":"f' || user_id || '","logger.name":"' || CASE WHEN event_id % 4 = 0 THEN 'override' ELSE 'exchange' END || '"}' AS attributes,
  CASE WHEN event_id % 2 = 0 THEN md5(user_id::VARCHAR) END AS trace_id,
  CASE WHEN event_type = 'error' AND event_id % 6 IN (1, 5) THEN 'Azure' WHEN event_type = 'error' AND event_id % 6 IN (0, 4) THEN 'AWS S3'
    WHEN event_type = 'error' AND event_id % 6 = 2 THEN 'GCP' ELSE '' END AS provider,
  floor(value * 1000)::BIGINT // 1000 AS took_ms
FROM events"""
)
def log_records(spark: SparkSession, sf: str) -> DataFrame:
    return log_rows(spark, sf).select("event_id", *log_columns(), "provider", "took_ms")


def log_columns() -> list[Column]:
    texts = [json_of_map(c).alias(c) for c in ("resource", "attributes")]
    return [F.col("severity_number"), F.col("severity_text"), F.col("body"), *texts, F.col("trace_id")]


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A log record for every event."""
    e, kind = F.col("event_id"), F.col("event_type")
    failed = kind == "error"
    level = (
        F.when(failed, "ERROR").when(kind == "view", "DEBUG").when(kind == "purchase", "WARNING")
        .when(kind == "signup", "CRITICAL").otherwise("NOTSET")
    )
    extras = F.map_filter(
        F.create_map(
            F.lit("file"), F.concat(F.lit("f"), F.col("user_id").cast("string")),
            F.lit("levelname"), F.lit("dropped"),
            F.lit("logger.name"), F.when(e % 4 == 0, "override"),
        ),
        lambda _, v: v.isNotNull(),
    )
    trace = F.struct(
        F.when(e % 2 == 0, F.md5(F.col("user_id").cast("string"))).alias("trace_id"),
        F.lit(None).cast("string").alias("span_id"),
        F.lit(None).cast("string").alias("flags"),
    )
    ts = F.col("ts").cast("timestamp")
    columns = log_record(
        ts,
        level,
        F.concat(F.lit("handled "), "props"),
        F.lit("exchange"),
        F.lit("1.0.0"),
        {
            "code.filepath": F.lit("/app/main.py"),
            "code.lineno": e % 400,
            "code.function": F.lit("run"),
            "logger.name": F.lit("exchange"),
        },
        extras,
        {
            "type": F.when(failed, "ValueError"),
            "message": F.when(failed, F.concat(F.lit("code "), (e % 5).cast("string"))),
        },
        trace,
    )
    end = F.timestamp_micros(F.unix_micros(ts) + F.floor(F.col("value") * 1000))
    return t.table(spark, sf, "events").select(
        "event_id",
        *columns,
        provider_label(F.when(failed, t.error_type())).alias("provider"),
        whole_ms(ts, end).alias("took_ms"),
    )
