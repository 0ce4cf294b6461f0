"""Topic messages: names, headers, routing, dead letters, catalogue, handlers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import header_exact
from ..functions.objects import error_record, provider_label
from ..functions.topics import control_group, resolve_topic, sanitize, sensor_group, target_topic
from ..operators.catalogue import missing_topics as missing
from ..operators.catalogue import present_topics as present
from ..operators.handlers import apply_handler as handle
from ..operators.handlers import run_stages
from ..operators.screening import REASON, dead_letters, decode_events
from ..plans.topic_flow import check_route, enrich_static, forward, route
from . import tables as t
from .registry import query
from .sql import sanitize as sql_sanitize
from .sql import strip as sql_strip
from .sql import with_

PROCESSED_AT = "2026-01-01T00:00:00+00:00"


def _processed_at() -> Column:
    return F.lit(PROCESSED_AT)


def _text(headers: Column) -> Column:
    return F.array_join(
        F.transform(headers, lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ";"
    )


_RAW = (
    "CASE c_custkey % 10 WHEN 0 THEN '!!!' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN chr(9) || ' ' "
    "WHEN 4 THEN ' ' || c_name || chr(10) ELSE c_name END"
)


@query(
    f"""SELECT c_custkey, {sql_sanitize("raw")} AS org, {sql_sanitize("raw", "fallback")} AS org_fallback,
  coalesce(nullif({sql_strip("coalesce(raw, '')")}, ''), 'src-topic-trfm') AS resolved,
  'dpn-producer-' || {sql_sanitize("raw")} || '-' || {sql_sanitize("c_mktsegment")} || '-unknown-target' AS target,
  {sql_sanitize("c_mktsegment")} || '-adaptor-control' AS control_id,
  'airflow-sensor-' || substr(replace('run:' || c_custkey || ':' || c_name || ':' || c_mktsegment || ':2026-01-01T00:00:00', ':', '-'), 1, 50) || '-adaptor' AS sensor_id
FROM (SELECT *, {_RAW} AS raw FROM customer)"""
)
def sanitize_topics(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = (
        F.when(k % 10 == 0, "!!!")
        .when(k % 10 == 1, F.lit(None))
        .when(k % 10 == 2, "")
        .when(k % 10 == 3, "\t ")
        .when(k % 10 == 4, F.concat(F.lit(" "), "c_name", F.lit("\n")))
        .otherwise(F.col("c_name"))
    )
    segment = sanitize("c_mktsegment")
    run = F.concat_ws(":", F.lit("run"), k.cast("string"), "c_name", "c_mktsegment", F.lit("2026-01-01T00:00:00"))
    return t.table(spark, sf, "customer").withColumn("raw", raw).select(
        "c_custkey",
        sanitize("raw").alias("org"),
        sanitize("raw", "fallback").alias("org_fallback"),
        resolve_topic("raw", F.lit("src-topic"), "trfm").alias("resolved"),
        target_topic("producer", sanitize("raw"), segment, sanitize(F.lit(None).cast("string"))).alias("target"),
        control_group(segment, F.lit("adaptor")).alias("control_id"),
        sensor_group(run, F.lit("adaptor")).alias("sensor_id"),
    )


@query(
    with_("checked")
    + """SELECT "offset", schema_type, org_name, product_type, target AS topic, reject_reason FROM checked"""
)
def header_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return check_route(t.messages(spark, sf)).select(
        "offset", "schema_type", "org_name", "product_type", F.col("target").alias("topic"), REASON
    )


@query(
    with_("checked")
    + f"""SELECT "offset", target AS topic, 'schemaType=' || schema_type || ';orgName=' || org_name || ';productType='
  || product_type || ';processedAt={PROCESSED_AT};offset=' || "offset" AS stamped,
  CASE WHEN trace IS NULL THEN substr(digest, 1, 32) ELSE split_part(trace, '-', 2) END AS trace_id,
  CASE WHEN trace IS NOT NULL THEN split_part(trace, '-', 3) END AS parent_id,
  substr(digest, 33, 16) AS span_id, '01' AS flags,
  key, coalesce(strlen(value), 0) AS value_bytes
FROM checked WHERE target IS NOT NULL"""
)
def enrich_headers(spark: SparkSession, sf: str) -> DataFrame:
    return route(t.messages(spark, sf), _processed_at()).select(
        "offset",
        "topic",
        _text(F.col("headers")).alias("stamped"),
        "trace.trace_id",
        "trace.parent_id",
        "trace.span_id",
        "trace.flags",
        F.col("key").cast("string").alias("key"),
        F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint").alias("value_bytes"),
    )




@query(
    with_("checked", "header_spellings")
    + f"""SELECT c."offset", 'schemaType=' || {sql_sanitize("s.v")} AS stamped_schema
FROM checked c LEFT JOIN (SELECT "offset",
    coalesce(nullif(max(v) FILTER (k = 'schema_type'), ''), nullif(max(v) FILTER (k = 'schematype'), ''),
             nullif(max(v) FILTER (k = 'schemaType'), '')) AS v FROM header_spellings GROUP BY 1) s USING ("offset")
WHERE c.target IS NOT NULL"""
)
def strict_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = route(t.messages(spark, sf), _processed_at(), strict_stamp=True)
    return stamped.select("offset", F.element_at(F.split(_text(F.col("headers")), ";"), 1).alias("stamped_schema"))


@query(
    with_("checked")
    + """SELECT target AS topic, count(*) AS messages, count(key) AS keyed, coalesce(sum(strlen(value)), 0)::BIGINT AS value_bytes,
  max("offset") AS last_offset FROM checked WHERE target IS NOT NULL GROUP BY 1"""
)
def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The consumer topic flow: look up, screen, route, enrich, count per target topic."""
    return (
        route(t.messages(spark, sf), _processed_at())
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count("key").alias("keyed"),
            F.coalesce(F.sum(F.octet_length("value").cast("bigint")), F.lit(0)).alias("value_bytes"),
            F.max("offset").alias("last_offset"),
        )
    )


@query(
    with_("messages")
    + f"""SELECT 'dpn-producer-quay-eqbd-eqbdpggas-target' AS topic, partition, count(*) AS messages, min("offset") AS first_offset,
  max("offset") AS last_offset, count(*) FILTER ("offset" % 3 = 0) AS inherited,
  max('schemaType=eqbd;orgName=quay;productType=eqbdpggas;processedAt={PROCESSED_AT};offset=' || "offset") AS last_stamp
FROM messages GROUP BY partition"""
)
def static_route(spark: SparkSession, sf: str) -> DataFrame:
    """The producer topic flow: every message to one topic with the run's own metadata."""
    out = enrich_static(t.messages(spark, sf), "QUAY", "EQBD", "EQBD PG Gas", _processed_at())
    return out.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_if(F.col("trace.parent_id").isNotNull()).alias("inherited"),
        F.max(_text(F.col("headers"))).alias("last_stamp"),
    )


FORWARD_SQL = (
    with_("messages")
    + """SELECT "offset", 'mapper-topic' AS topic, len(headers) + 1 AS n_headers,
  '00-' || substr(d, 1, 32) || '-' || substr(d, 33, 16) || '-01' AS traceparent, key, value
FROM (SELECT *, sha256('src-topic-' || partition || '-' || "offset") AS d FROM messages)"""
)


def forwarded(messages: DataFrame) -> DataFrame:
    return forward(messages, "mapper-topic").select(
        "offset",
        "topic",
        F.size("headers").cast("bigint").alias("n_headers"),
        header_exact("headers", "traceparent").alias("traceparent"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


@query(FORWARD_SQL)
def forward_messages(spark: SparkSession, sf: str) -> DataFrame:
    return forwarded(t.messages(spark, sf))


@query(
    with_("checked", "decoded")
    + """SELECT 'topic' AS flow, reject_reason AS reason, count(*) AS rejected FROM checked WHERE reject_reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'file', reason, count(*) FROM decoded WHERE reason IS NOT NULL GROUP BY 2"""
)
def dead_letter_reasons(spark: SparkSession, sf: str) -> DataFrame:
    topic = dead_letters(check_route(t.messages(spark, sf))).select(F.lit("topic").alias("flow"), REASON)
    file = dead_letters(decode_events(t.file_messages(spark, sf))).select(F.lit("file").alias("flow"), REASON)
    both = topic.unionByName(file)
    return both.groupBy("flow", F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("rejected"))


@query(
    with_("steps")
    + """SELECT CASE WHEN label = '' THEN 'Unknown' ELSE label END AS provider, error_type, error_message, count(*) AS errors
FROM (SELECT *, CASE WHEN error_type IN ('HttpResponseError', 'AzureError') THEN 'Azure'
  WHEN error_type IN ('ClientError', 'BotoCoreError') THEN 'AWS S3' WHEN error_type = 'GoogleAPIError' THEN 'GCP' ELSE '' END AS label
  FROM steps WHERE error_type IS NOT NULL) GROUP BY 1, 2, 3"""
)
def errors_total(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.metrics import errors_total as total

    failed = t.step_events(spark, sf).where(F.col("error_type").isNotNull())
    record = error_record(provider_label("error_type"), "error_type", "error_message")
    return total(failed.withColumn("provider", record["provider"]), "provider")


@query(
    with_("checked", "known_topics")
    + "SELECT DISTINCT target AS topic FROM checked WHERE target IS NOT NULL AND target NOT IN (SELECT topic FROM known_topics)"
)
def missing_topics(spark: SparkSession, sf: str) -> DataFrame:
    return missing(route(t.messages(spark, sf), _processed_at()), t.catalogue(spark, sf))


@query(
    with_("checked", "known_topics")
    + "SELECT DISTINCT target AS topic FROM checked WHERE target IN (SELECT topic FROM known_topics)"
)
def present_topics(spark: SparkSession, sf: str) -> DataFrame:
    return present(route(t.messages(spark, sf), _processed_at()), t.catalogue(spark, sf))


def _double_k(payload: dict) -> int:
    """A user handler for the registered query: fails on odd values above 90."""
    k = payload["k"]
    if k > 90 and k % 2:
        raise ValueError("k is too odd")
    return k * 2


@query(
    with_("messages")
    + """SELECT "offset", CASE WHEN NOT bad THEN (2 * k)::VARCHAR END AS result,
  CASE WHEN value IS NULL THEN 'TypeError' WHEN bad THEN 'ValueError' END AS error_type
FROM (SELECT *, value IS NULL OR (k > 90 AND k % 2 = 1) AS bad FROM
  (SELECT *, json_extract(value, '$.k')::BIGINT AS k FROM messages))"""
)
def apply_handler(spark: SparkSession, sf: str) -> DataFrame:
    def decode(df: DataFrame, ctx) -> DataFrame:
        return handle(df.select("offset", "value"), _double_k)

    def keep(df: DataFrame, ctx) -> DataFrame:
        return df.select("offset", "result", "error_type")

    return run_stages(t.messages(spark, sf), {"run_id": "run"}, decode, keep)
