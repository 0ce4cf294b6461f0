"""Exchange records derived from the shared test tables.

Every derivation is a narrow projection (at most a join with the 25 fixed
nations), so it runs at scan speed and works on streams as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import HEADERS_TYPE

BASE = "2026-01-01 00:00:00"
BASE_SECS = 1_767_225_600  # that moment in seconds


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same table as a stream of its files.

    The pattern lets a table be one file or a folder of files; a stream source
    takes a plain path for a folder only.
    """
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{sf}/{name}.parquet*")


def at(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds + F.lit(BASE_SECS))


def pick(index: Column, *values: str | None) -> Column:
    """The value at ``index`` of a short list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# --- topic messages ----------------------------------------------------------


def messages_of(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Topic messages; headers in five styles, some missing, doubled or broken."""
    e, style = F.col("event_id"), F.col("event_id") % 5
    named = events.withColumn("n_nationkey", (F.col("user_id") % 25).cast("int")).join(
        nation.select("n_nationkey", "n_name"), "n_nationkey"
    )
    schema = (
        F.when((F.col("event_type") == "error") & (e % 2 == 0), F.lit(None))
        .when(F.col("event_type") == "error", "Un-Known")
        .otherwise(F.concat(F.lit("EQ "), F.col("event_type")))
    )
    product = (
        F.when(F.col("value") < 5, "Gas Low").when(F.col("value") < 25, "gas-MID").otherwise("Gas_High #1")
    )

    def entry(key: Column, value: Column) -> Column:
        return F.when(
            key.isNotNull() & value.isNotNull(),
            F.struct(key.alias("key"), value.cast("binary").alias("value")),
        )

    some = F.col("s").isNotNull()
    entries = F.array(
        entry(F.when((style == 3) & some, "Schema_Type").when((style == 4) & some, "schema_type"),
              F.when(style == 3, "stale").otherwise("")),
        entry(pick(style, "schema_type", "schemaType", "SCHEMATYPE", "schema_type", "schematype"), F.col("s")),
        entry(F.when(style == 3, "Schema_Type"), F.concat("s", F.lit(" v2"))),
        entry(pick(style, "org_name", "orgName", "ORGNAME", "org_name", "org_name"), F.col("n_name")),
        entry(pick(style, "product_type", "productType", "PRODUCTTYPE", "product_type", "product_type"), product),
        entry(
            F.when(e % 3 == 0, "traceparent"),
            F.concat(
                F.lit("00-"), F.md5(e.cast("string")), F.lit("-"),
                F.substring(F.md5(F.concat(F.lit("s"), e.cast("string"))), 1, 16), F.lit("-01"),
            ),
        ),
        entry(F.when(e % 101 == 0, "note"), F.unhex(F.lit("FF"))),
    )
    return named.withColumn("s", schema).select(
        F.when(e % 13 != 0, F.col("user_id").cast("string")).cast("binary").alias("key"),
        F.when(e % 97 != 0, F.col("props")).cast("binary").alias("value"),
        F.lit("src-topic").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        e.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.filter(entries, lambda h: h.isNotNull()).cast(HEADERS_TYPE).alias("headers"),
    )


def control_topic(spark: SparkSession, sf: str, *, streaming: bool = False) -> DataFrame:
    """Raw control messages; six of eleven hold no JSON object, run ids are texts, numbers or missing."""
    e, number = F.col("event_id"), F.col("event_id").cast("string")
    run = F.when(e % 7 == 0, "").when(e % 5 == 0, F.concat(F.lit(',"run_id":'), number))
    body = F.concat(
        F.lit('{"stage":"'), F.col("event_type"), F.lit('","product":"p'), (F.col("user_id") % 7).cast("string"), F.lit('"'),
        F.coalesce(run, F.concat(F.lit(',"run_id":"r'), number, F.lit('"'))), F.lit(',"extra":'), F.col("props"), F.lit("}"),
    )
    odd = (
        F.when(e % 11 == 0, F.lit(None).cast("binary"))
        .when(e % 11 == 1, F.substring(body, 1, 20).cast("binary"))
        .when(e % 11 == 2, F.concat(F.lit("["), body, F.lit("]")).cast("binary"))
        .when(e % 11 == 3, F.concat(body.cast("binary"), F.unhex(F.lit("FF"))))
        .when(e % 11 == 4, number.cast("binary"))
        .when(e % 11 == 5, F.concat(body, F.lit("} x")).cast("binary"))
    )
    return (table_stream if streaming else table)(spark, sf, "events").select(
        number.cast("binary").alias("key"),
        F.when(e % 11 > 5, body.cast("binary")).otherwise(odd).alias("value"),
        F.lit("control").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        e.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf: str, *, streaming: bool = False) -> DataFrame:
    events = (table_stream if streaming else table)(spark, sf, "events")
    return messages_of(events, table(spark, sf, "nation"))


# --- objects -----------------------------------------------------------------


def object_key() -> Column:
    bare = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return F.when(F.col("page_id") % 5 == 0, F.col("url")).otherwise(
        F.concat(bare, F.lit("/"), F.col("page_id").cast("string"))
    )


def keyed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url", "html", object_key().alias("object_key"))


def source_listing(spark: SparkSession, sf: str, *, content: bool = False) -> DataFrame:
    """Source container; some requested objects are not in it."""
    p = F.col("page_id")
    extra = [F.col("html").cast("binary").alias("content")] if content else []
    return (
        keyed_pages(spark, sf)
        .where(p % 29 != 7)
        .select(
            "object_key",
            at(p * 3600).alias("modified"),
            F.octet_length("html").cast("bigint").alias("length"),
            F.concat(F.lit("container-"), (p % 7).cast("string")).alias("container"),
            *extra,
        )
    )


def target_listing(spark: SparkSession, sf: str, dest: Column | None = None) -> DataFrame:
    """Target container: a third is absent, the rest an hour older, equal or newer."""
    p = F.col("page_id")
    return (
        keyed_pages(spark, sf)
        .where(p % 3 != 0)
        .select(
            (F.col("object_key") if dest is None else dest).alias("object_key"),
            at(p * 3600 + (F.floor(p / 3) % 3 - 1) * 3600).alias("modified"),
            F.octet_length("html").cast("bigint").alias("length"),
        )
    )


def requested(spark: SparkSession, sf: str) -> DataFrame:
    """Requests; one key in ten is asked for three times."""
    p = F.col("page_id")
    times = F.when(p % 10 == 1, 3).otherwise(1)
    return keyed_pages(spark, sf).select(
        "object_key", p.alias("order_no"), F.explode(F.sequence(F.lit(1), times)).alias("nth")
    )


def file_messages(spark: SparkSession, sf: str) -> DataFrame:
    """File-ready messages, six in eleven damaged in one way each."""
    p = F.col("page_id")
    good = F.to_json(
        F.struct(F.lit("S3").alias("sourceType"), F.lit("staging").alias("storageContainer"),
                 F.col("object_key").alias("path"))
    )
    text = (
        F.when(p % 11 == 5, "bad")
        .when(p % 11 == 6, "[]")
        .when(p % 11 == 7, '[{"path":"z"}]')
        .when(p % 11 == 8, '{"sourceType":"S3"}')
        .when(p % 11 == 9, '{"path":""}')
        .when(p % 11 != 10, good)
    )
    broken = F.when(p % 31 == 30, F.unhex(F.lit("7B22FF227D"))).otherwise(text.cast("binary"))
    return keyed_pages(spark, sf).select(
        F.lit(None).cast("binary").alias("key"),
        broken.alias("value"),
        F.lit("mapper-topic").alias("topic"),
        F.lit(0).alias("partition"),
        p.alias("offset"),
        at(p).alias("timestamp"),
        F.array().cast(HEADERS_TYPE).alias("headers"),
    )


# --- triggers and statuses ---------------------------------------------------

TICKS = 100_000  # status offsets per second of log time


def _run(k: Column) -> Column:
    return F.floor(k / 4).cast("bigint")


def _stage(k: Column) -> Column:
    run = _run(k)
    return F.when(
        F.when(run % 3 == 0, k % 2 == 0).otherwise(k % 4 < 2), "adaptor"
    ).otherwise("schema_mapper")


def orders_as_runs(orders: DataFrame) -> DataFrame:
    """Four orders make a run: both stages, each triggered twice."""
    k = F.col("o_orderkey")
    run = _run(k)
    return orders.select(
        k.alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderstatus").alias("s"),
        F.concat(F.lit("run:"), run.cast("string")).alias("run_id"),
        F.concat(F.lit("p"), (run % 5).cast("string")).alias("product"),
        _stage(k).alias("stage"),
        F.when(run % 3 < 2, "file").otherwise("topic").alias("pipeline_type"),
        F.when(run % 4 < 3, "producer").otherwise("consumer").alias("pipeline_role"),
    )


def triggers_of(orders: DataFrame) -> DataFrame:
    k = F.col("k")
    mode = (
        F.when((F.col("s") == "O") & (k % 2 == 0), "manual")
        .when(F.col("s") == "O", " MANUAL\t")
        .when(F.col("s") == "P", "automatic")
        .when(k % 3 == 0, F.lit(None))
        .otherwise("x")
    )
    return orders_as_runs(orders).select(
        F.lit(0).alias("partition"),
        k.alias("offset"),
        "stage",
        "pipeline_type",
        "pipeline_role",
        "product",
        F.when(k % 41 != 40, F.col("run_id")).alias("run_id"),
        F.concat(F.lit("dag-"), F.col("run_id")).alias("dag_run_id"),
        F.when(k % 7 != 0, "exchange").alias("dag_id"),
        mode.alias("execution_mode"),
        F.lit("airflow").alias("triggered_by"),
        at(k * 60).alias("timestamp"),
        (k * 60 * TICKS).alias("start_offset"),
        ((k * 60 + BASE_SECS) * 1_000_000).alias("start_us"),
        (F.col("c") % 40 * 20_000_000).alias("duration_us"),
        (F.col("c") % 11 == 0).alias("run_failed"),
    )


def triggers(spark: SparkSession, sf: str) -> DataFrame:
    return triggers_of(table(spark, sf, "orders"))


def statuses_of(orders: DataFrame) -> DataFrame:
    k, c = F.col("k"), F.col("c")
    secs = k * 60 + c % 40 * 20
    return (
        orders_as_runs(orders)
        .where(c % 9 != 0)
        .select(
            F.when(k % 5 == 4, 1).otherwise(0).alias("partition"),
            # the second partition counts on its own
            F.when(k % 5 == 4, k).otherwise(secs * TICKS + k % TICKS).alias("offset"),
            "stage",
            "pipeline_type",
            "pipeline_role",
            "product",
            "run_id",
            F.concat(F.lit("dag-"), F.col("run_id")).alias("dag_run_id"),
            F.lit("exchange").alias("dag_id"),
            F.when(c % 11 == 0, "failed").when(c % 7 == 0, "skipped").otherwise("completed").alias("status"),
            F.when(c % 11 == 0, "ValueError: bad input").alias("error"),
            ((c % 40 * 20_000_000 + k % 1000) / 1000.0).alias("duration_ms"),
            at(secs).alias("timestamp"),
        )
    )


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    return statuses_of(table(spark, sf, "orders"))


# --- steps, metrics, heartbeats ----------------------------------------------


def error_type() -> Column:
    return pick(F.col("event_id") % 6, "ClientError", "AzureError", "GoogleAPIError", "ValueError", "BotoCoreError", "HttpResponseError")


def step_events(spark: SparkSession, sf: str) -> DataFrame:
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    failed = t == "error"
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("run-"), u.cast("string")).alias("run_id"),
        F.when(u % 3 == 0, "adaptor").when(u % 3 == 1, "extractor").otherwise("schema_mapper").alias("stage"),
        F.when(u % 2 == 0, "file").otherwise("topic").alias("type"),
        F.when(u % 5 < 3, "producer").otherwise("consumer").alias("role"),
        F.when(u % 7 == 0, "manual").otherwise("automatic").alias("mode"),
        F.concat(F.lit("op"), (e % 2).cast("string")).alias("operation"),
        F.when(t.isin("signup", "click"), "started")
        .when(t == "purchase", "completed")
        .when(failed, "failed")
        .otherwise("skipped")
        .alias("event"),
        F.when(failed, error_type()).alias("error_type"),
        F.when(failed, F.concat(F.lit("code "), (e % 5).cast("string"))).alias("error_message"),
        F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("duration_us"),
    )


def points_of(events: DataFrame) -> DataFrame:
    """Metric points; attributes come in either entry order."""
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    kind = F.when(t.isin("click", "view", "error"), "counter").when(t == "purchase", "histogram").otherwise("updown")
    provider = F.when(u % 3 == 0, "azure").otherwise("aws")
    status = F.when(t == "error", "error").when(u % 5 == 0, "skipped").otherwise("success")
    one = F.create_map(F.lit("cloud_provider"), provider, F.lit("status"), status)
    other = F.create_map(F.lit("status"), status, F.lit("cloud_provider"), provider)
    return events.select(
        F.concat(t, F.lit("_total")).alias("name"),
        kind.alias("kind"),
        F.when((kind == "updown") & (e % 2 == 0), -F.col("value")).otherwise(F.col("value")).alias("value"),
        F.when(e % 2 == 0, one).otherwise(other).alias("attributes"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def points(spark: SparkSession, sf: str, *, streaming: bool = False) -> DataFrame:
    return points_of((table_stream if streaming else table)(spark, sf, "events"))


def beats_of(events: DataFrame) -> DataFrame:
    """Heartbeats; each component starts anew every day."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("component-"), F.col("user_id").cast("string")).alias("component"),
        F.date_trunc("day", ts).alias("started_at"),
        ts.alias("ts"),
        "event_id",
    )


def beats(spark: SparkSession, sf: str, *, streaming: bool = False) -> DataFrame:
    return beats_of((table_stream if streaming else table)(spark, sf, "events"))


# --- settings ----------------------------------------------------------------


def configs(spark: SparkSession, sf: str) -> DataFrame:
    """One component per customer; kinds rotate and faults are put in by key."""
    c = F.col("c_custkey")
    kind = pick(c % 6, "cloud", "kafka", "adaptor", "mapper", "consumer-extractor", "consumer-mapper")
    q = F.floor(c / 6).cast("bigint")
    provider = pick(q % 5, "azure", " AWS ", "aws", "gcp", None)
    good64 = F.base64(F.col("c_name").cast("binary"))
    conn = (
        F.when(q % 7 == 0, "!!!!").when(q % 7 == 1, "abc").when(q % 7 == 2, " ").when(q % 7 == 3, "ab=c=\nd=")
        .otherwise(good64)
    )
    servers = pick(q % 8, "host:9092", "a:1,b:2", "host", "", " a:1 ", "a:1, b", "a:1,,c", None)
    topic = pick(q % 7, "eq-topic", "", " eq", "e q", "eq ", None, "ok.topic")
    other = pick(q % 5, "map-topic", "", "ma p ", None, "m")
    version = pick(q % 6, "0.0.1", "v1.2.3", "invalid", "1.2", "", "1.2.3\n")
    named = {
        "cloudProviderType": provider,
        "srcConnectionString": conn,
        "mapperConnectionString": good64,
        "targetConnectionString": F.when(q % 3 != 0, good64),
        "AWS_ACCESS_KEY_ID": F.when(q % 4 != 0, F.lit("key")),
        "AWS_SECRET_ACCESS_KEY": F.when(q % 6 == 0, "  ").otherwise("secret"),
        "AWS_REGION": F.lit("eu-west-2"),
        "AWS_ENDPOINT_URL": F.when(q % 9 != 0, F.lit("http://store:9000")),
        "bootstrapServer": servers,
        "srcTopicName": topic,
        "mapperTopicName": F.when(kind.isin("mapper", "consumer-mapper"), topic).otherwise(other),
        "targetTopicName": other,
        "orgName": F.when(q % 10 == 0, " quay").when(q % 10 == 1, "").otherwise("quay"),
        "schemaType": F.when(q % 11 == 0, "eq ").otherwise("eq"),
        "productType": F.when(q % 13 != 0, F.lit("gas")),
        "SERVICE_NAME": F.when(q % 12 == 0, "").otherwise("svc"),
        "SERVICE_VERSION": version,
    }
    flat = [x for k, v in named.items() for x in (F.lit(k), v)]
    return table(spark, sf, "customer").select(
        F.concat(F.lit("component-"), c.cast("string")).alias("component"),
        kind.alias("kind"),
        F.map_filter(F.create_map(*flat), lambda _, v: v.isNotNull()).alias("config"),
    )


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Existing topics: some topics of every second nation outside one region."""
    nation = table(spark, sf, "nation").where(F.col("n_nationkey") % 2 == 0)
    org = F.lower(F.regexp_replace("n_name", "[^A-Za-z0-9]", ""))
    region = table(spark, sf, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .where(F.col("r_name") != "ASIA")
        .select(org.alias("org"), F.explode(F.array(
            F.struct(F.lit("eqclick").alias("schema"), F.lit("gaslow").alias("product")),
            F.struct(F.lit("eqview").alias("schema"), F.lit("gasmid").alias("product")),
            F.struct(F.lit("eqview").alias("schema"), F.lit("gashigh1").alias("product")),
        )).alias("x"))
        .select(F.concat_ws("-", F.lit("dpn-consumer"), "org", "x.schema", "x.product", F.lit("target")).alias("topic"))
    )
