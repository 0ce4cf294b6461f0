"""Objects: keys, names, copy plans, gates, real copies and moves, settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.objects import file_ready, is_safe_key, mapped_name, provider, source_type
from ..operators import validation as v
from ..operators.copies import attach_content, copy_plan as make_plan, copy_plan_of_listing
from ..operators.copies import cycle_summary as summarise
from ..operators.copies import needs_copy
from ..operators.metrics import copy_counters, discovered
from ..operators.screening import non_empty
from ..plans.file_flow import consumer_flow, producer_flow
from ..plans.staged_cycle import STAGES, run_cycle
from ..session import run_folder
from ..sources.objects import (
    execute_copy as run_copy,
    execute_move as run_move,
    fetch_objects,
    make_folder,
    write_objects,
    list_objects as list_all,
    read_objects as scan,
)
from . import tables as t
from .registry import query
from .sql import SAFE, strip, with_


@query(
    with_("src")
    + "SELECT container, count(*) AS files_discovered_total, sum(length)::BIGINT AS bytes FROM src GROUP BY 1"
)
def discovered_counts(spark: SparkSession, sf: str) -> DataFrame:
    return discovered(t.source_listing(spark, sf), "container")


@query(
    with_("keyed")
    + f"""SELECT p AS page_id, regexp_matches(url, '{SAFE}') AS url_safe, regexp_matches(object_key, '{SAFE}') AS key_safe,
  regexp_matches(object_key || CASE p % 4 WHEN 0 THEN chr(10) WHEN 1 THEN ' x' WHEN 2 THEN chr(13) ELSE 'é;' END, '{SAFE}') AS odd_safe
FROM keyed"""
)
def object_key_check(spark: SparkSession, sf: str) -> DataFrame:
    odd = t.pick(F.col("page_id") % 4, "\n", " x", "\r", "é;")
    return t.keyed_pages(spark, sf).select(
        "page_id",
        is_safe_key("url").alias("url_safe"),
        is_safe_key("object_key").alias("key_safe"),
        is_safe_key(F.concat("object_key", odd)).alias("odd_safe"),
    )


@query(
    with_("keyed")
    + """SELECT p AS page_id, 'naturalgas-mole-' || lower(replace(replace(object_key, ' ', '_'), '-', '_')) AS producer_name,
  object_key AS consumer_name, CASE WHEN vendor = 'aws' THEN 'S3' ELSE upper(vendor) END AS source_type,
  CASE WHEN lower(vendor) IN ('aws', 'azure') THEN lower(vendor) ELSE 'unsupported' END AS provider,
  '{"sourceType":"' || CASE WHEN vendor = 'aws' THEN 'S3' ELSE upper(vendor) END || '","storageContainer":"target-container","path":"' || object_key || '"}' AS event
FROM (SELECT *, ['aws', 'Azure', 'gcp'][p % 3 + 1] AS vendor FROM keyed)"""
)
def mapped_names(spark: SparkSession, sf: str) -> DataFrame:
    vendor = t.pick(F.col("page_id") % 3, "aws", "Azure", "gcp")
    return t.keyed_pages(spark, sf).select(
        "page_id",
        mapped_name(F.lit("NaturalGas"), F.lit("Mole"), "object_key").alias("producer_name"),
        F.col("object_key").alias("consumer_name"),
        source_type(vendor).alias("source_type"),
        provider(vendor).alias("provider"),
        F.to_json(file_ready(F.lit("target-container"), "object_key", vendor)).alias("event"),
    )


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    return make_plan(t.requested(spark, sf), t.source_listing(spark, sf), t.target_listing(spark, sf))


@query(
    with_("plan")
    + """SELECT object_key, requests::BIGINT AS requests, reason IN ('created', 'overwritten') AS copied, reason LIKE 'target%' AS skipped, reason
FROM plan"""
)
def copy_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).select("object_key", "requests", "copied", "skipped", "reason")


@query(with_("plan") + "SELECT object_key, reason FROM plan WHERE reason IN ('created', 'overwritten')")
def delta_listing(spark: SparkSession, sf: str) -> DataFrame:
    return needs_copy(_plan(spark, sf)).select("object_key", "reason")


@query(
    with_("plan")
    + """SELECT sum(requests)::BIGINT AS total, count(*) FILTER (reason IN ('created', 'overwritten')) AS copied,
  (sum(requests) FILTER (reason LIKE 'target%'))::BIGINT + (sum(requests - 1) FILTER (reason IN ('created', 'overwritten')))::BIGINT AS skipped,
  (sum(requests) FILTER (reason LIKE 'source%' OR reason LIKE 'unsafe%'))::BIGINT AS failed,
  (sum(requests) FILTER (reason LIKE 'target%' OR reason LIKE 'source%'))::BIGINT + (sum(requests - 1) FILTER (reason IN ('created', 'overwritten')))::BIGINT AS reference_skipped
FROM plan"""
)
def cycle_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarise(_plan(spark, sf))


@query(
    with_("plan")
    + """SELECT status, reference_status, sum(requests)::BIGINT AS files_processed_total FROM (SELECT requests,
  CASE WHEN reason IN ('created', 'overwritten') THEN 'success' WHEN reason LIKE 'target%' THEN 'skipped' ELSE 'error' END AS status,
  CASE WHEN reason IN ('created', 'overwritten') THEN 'success' WHEN reason LIKE 'unsafe%' THEN 'error' ELSE 'skipped' END AS reference_status
FROM plan) GROUP BY 1, 2"""
)
def file_counters(spark: SparkSession, sf: str) -> DataFrame:
    return copy_counters(_plan(spark, sf))


@query(
    """SELECT d.source, o.path IS NOT NULL AS found, coalesce(o.valid, false) AS passed, count(*) AS events,
  coalesce(sum(o.length), 0)::BIGINT AS bytes
FROM documents d LEFT JOIN (SELECT source || '/' || doc_id AS path, strlen(text) AS length,
    strlen(text) > 0 AND strlen(text) >= 400 AND lang <> 'de' AS valid FROM documents WHERE doc_id % 17 <> 3) o
  ON o.path = d.source || '/' || d.doc_id
GROUP BY 1, 2, 3"""
)
def schema_gate(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.table(spark, sf, "documents")
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    objects = docs.where(F.col("doc_id") % 17 != 3).select(
        path.alias("object_key"), F.col("text").cast("binary").alias("content"), "lang"
    )
    rule = non_empty("content") & (F.octet_length("content") >= 400) & (F.col("lang") != "de")
    met = attach_content(docs.select("source", path.alias("path")), objects, rule)
    return met.groupBy("source", "found", F.coalesce("valid", F.lit(False)).alias("passed")).agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum("length"), F.lit(0).cast("bigint")).alias("bytes"),
    )


# --- containers with real objects --------------------------------------------
#
# Each document is an object of its own, nested by source and language. Some are
# empty, some have hidden names, and one folder holds no file at all.

_OBJECTS = """(SELECT source || '/' || lang || '/' || CASE doc_id % 50 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE 'd' END || doc_id || '.txt' AS object_key,
  CASE WHEN doc_id % 97 = 5 THEN '' ELSE text END AS body, doc_id FROM documents)"""


def document_objects(spark: SparkSession, sf: str) -> DataFrame:
    """object_key and content of one object per document."""
    i = F.col("doc_id")
    name = F.concat(F.when(i % 50 == 0, "_").when(i % 50 == 1, ".").otherwise("d"), i.cast("string"), F.lit(".txt"))
    body = F.when(i % 97 == 5, "").otherwise(F.col("text")).cast("binary")
    return t.table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "lang", name).alias("object_key"), body.alias("content"), "doc_id"
    )


def _container(spark: SparkSession, sf: str, label: str) -> str:
    root = run_folder(spark, label)
    make_folder(spark, f"{root}/source/no/files/here")
    write_objects(document_objects(spark, sf), f"{root}/source").write.parquet(f"{root}/written")
    return root


def _hashes(spark: SparkSession, root: str) -> DataFrame:
    """Key, length and hash of every object below a root, read back from it."""
    listed = list_all(spark, root).select("object_key", "length")
    got = fetch_objects(listed, root).select("object_key", F.md5("content").alias("hash"))
    return listed.join(got, "object_key")


@query(f"SELECT object_key, strlen(body)::BIGINT AS length, true AS has_time FROM {_OBJECTS}")
def list_objects(spark: SparkSession, sf: str) -> DataFrame:
    root = _container(spark, sf, "list")
    listed = list_all(spark, f"{root}/source").unionByName(list_all(spark, f"{root}/source", provider="gcp"))
    return listed.select("object_key", "length", F.col("modified").isNotNull().alias("has_time"))


@query(f"SELECT object_key, md5(body) AS hash FROM {_OBJECTS} UNION ALL SELECT 'gone.txt', 'absent'")
def read_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Every object, and one that isn't there; tasks follow the listed bytes."""
    root = f"{_container(spark, sf, 'read')}/source"
    gone = spark.range(1).select(F.lit("gone.txt").alias("object_key"), F.lit(0).cast("bigint").alias("length"))
    keys = list_all(spark, root).select("object_key", "length").unionByName(gone)
    return fetch_objects(keys, root).select("object_key", F.coalesce(F.md5("content"), F.lit("absent")).alias("hash"))


@query(f"SELECT object_key, md5(body) AS hash FROM {_OBJECTS} WHERE body <> '' AND doc_id % 50 > 1 AND doc_id % 3 = 0")
def scan_objects(spark: SparkSession, sf: str) -> DataFrame:
    """A share of a container's data files by a scan of all."""
    root = f"{_container(spark, sf, 'scan')}/source"
    keys = document_objects(spark, sf).where("doc_id % 3 = 0 AND octet_length(content) > 0").select("object_key")
    return scan(spark, root, keys).select("object_key", F.md5("content").alias("hash"))


@query(
    f"""SELECT cycle, object_key, cycle = 1 AS copied, cycle = 2 AS skipped, strlen(body)::BIGINT AS length, md5(body) AS hash
FROM {_OBJECTS}, (VALUES (1), (2)) v(cycle)"""
)
def execute_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Copy a container twice: the second cycle finds everything up to date. Hashes are those of the target."""
    root = _container(spark, sf, "copy")
    src, dst = f"{root}/source", f"{root}/target"
    source = list_all(spark, src)
    results = []
    for n in (1, 2):
        plan = copy_plan_of_listing(source, list_all(spark, dst, may_be_absent=True), " AWS ")
        results.append(run_copy(plan, src, dst, f"{root}/cycle-{n}").withColumn("cycle", F.lit(n)))
    landed = _hashes(spark, dst).withColumnRenamed("object_key", "dest_key")
    done = results[0].unionByName(results[1]).drop("length").join(landed, "dest_key", "full")
    return done.select("cycle", "object_key", "copied", "skipped", "length", "hash")


@query(
    f"""SELECT object_key, 'moved/' || object_key AS dest_key, 'moved' AS reason, md5(body) AS hash, false AS still_there FROM {_OBJECTS}
UNION ALL SELECT 'gone.txt', 'moved/gone.txt', 'source blob not found', 'absent', false"""
)
def execute_move(spark: SparkSession, sf: str) -> DataFrame:
    """Move a container below another name: afterwards the source is empty."""
    root = _container(spark, sf, "move")
    src, dst = f"{root}/source", f"{root}/target"
    source = list_all(spark, src)
    gone = spark.range(1).select(F.lit("gone.txt").alias("object_key"))
    asked = source.select("object_key").unionByName(gone)
    to = F.concat(F.lit("moved/"), "object_key")
    moved = run_move(asked, source, src, dst, f"{root}/moved", dest=to, vendor="Azure")
    left = list_all(spark, src).select("object_key", F.lit(True).alias("still_there"))
    landed = _hashes(spark, dst).select(F.col("object_key").alias("dest_key"), "hash")
    return moved.join(landed, "dest_key", "full").join(left, "object_key", "left").select(
        "object_key", "dest_key", "reason",
        F.coalesce("hash", F.lit("absent")).alias("hash"), F.coalesce("still_there", F.lit(False)).alias("still_there"),
    )


# --- whole file flows --------------------------------------------------------

_COPIED_AT = "2026-03-01 00:00:00"
_STAGING = "SELECT object_key, modified + INTERVAL 30 MINUTES AS modified FROM tgt WHERE p % 2 = 0"


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    """The staging container: every second object of the target, half an hour later."""
    p = F.col("page_id")
    return t.keyed_pages(spark, sf).where((p % 3 != 0) & (p % 2 == 0)).select(
        "object_key", t.at(p * 3600 + (F.floor(p / 3) % 3 - 1) * 3600 + 1800).alias("modified")
    )


def _flow_sql(dest: str, rule: str) -> str:
    return (
        with_("src", "tgt")
        + f""", staged AS (SELECT s.* FROM src s LEFT JOIN ({_STAGING}) g USING (object_key)
    WHERE regexp_matches(object_key, '{SAFE}') AND (g.modified IS NULL OR s.modified > g.modified)),
  ready AS (SELECT s.object_key, {dest} AS dest_key FROM staged s WHERE {rule}),
  landed AS (SELECT r.* FROM ready r LEFT JOIN (SELECT {dest} AS dest_key, max(modified) AS modified FROM tgt s GROUP BY 1) t USING (dest_key)
    WHERE t.modified IS NULL OR TIMESTAMP '{_COPIED_AT}' > t.modified)
SELECT min(object_key) AS object_key, dest_key, '{{"sourceType":"S3","storageContainer":"target","path":"' || dest_key || '"}}' AS event
FROM landed GROUP BY dest_key"""
    )


_MAPPED = "'naturalgas-mole-' || lower(replace(replace(s.object_key, ' ', '_'), '-', '_'))"


def _events(flow: DataFrame) -> DataFrame:
    return flow.select("object_key", "dest_key", F.to_json("event").alias("event"))


@query(_flow_sql(_MAPPED, "strlen(s.html) > 1200"))
def producer_file_events(spark: SparkSession, sf: str) -> DataFrame:
    renamed = mapped_name(F.lit("NaturalGas"), F.lit("Mole"), "object_key")
    target = t.target_listing(spark, sf, renamed).groupBy("object_key").agg(F.max("modified").alias("modified"))
    return _events(
        producer_flow(
            t.source_listing(spark, sf, content=True),
            _staging(spark, sf),
            target,
            schema="NaturalGas",
            org="Mole",
            staging_container="staging",
            target_container="target",
            provider="aws",
            copied_at=F.lit(_COPIED_AT).cast("timestamp"),
            rule=F.octet_length("content") > 1200,
        )
    )


@query(_flow_sql("s.object_key", "true"))
def consumer_file_events(spark: SparkSession, sf: str) -> DataFrame:
    return _events(
        consumer_flow(
            t.source_listing(spark, sf),
            _staging(spark, sf),
            t.target_listing(spark, sf),
            staging_container="staging",
            target_container="target",
            provider="aws",
            copied_at=F.lit(_COPIED_AT).cast("timestamp"),
        )
    )


# --- settings ----------------------------------------------------------------


def _listed(kind: str, *checks: str) -> str:
    """Error rows of one kind: checks are SQL expressions giving a text, null or a list."""
    parts = ", ".join(f"coalesce({c}, [])" if c.startswith("list") else f"[{c}]" for c in checks)
    return f"""SELECT component, kind, list_filter(flatten([{parts}]), lambda e: e IS NOT NULL) AS errors
FROM configs WHERE kind = '{kind}'"""


def _rows(body: str) -> str:
    return (
        with_("configs")
        + f""", checked AS ({body})
SELECT component, (generate_subscripts(errors, 1) - 1)::INTEGER AS position, unnest(errors) AS error FROM checked"""
    )


_LENIENT = r"^(?:=*[^=]=*[^=]=?[^=][^=])*(?:=*\z|=*[^=]=*[^=](?:==|=?[^=]=))"


def _b64(c: str) -> str:
    kept = f"regexp_replace({c}, '[^A-Za-z0-9+/=]', '', 'g')"
    return f"regexp_matches({kept}, '{_LENIENT}')"


def _azure(name: str, c: str) -> str:
    s = strip(c)
    return (
        f"CASE WHEN {s} = '' THEN '[azure] ''{name}'' is required but empty' "
        f"WHEN NOT {_b64(s)} THEN '[azure] ''{name}'' is not valid base64' END"
    )


def _aws(name: str, c: str, text: str) -> str:
    return f"CASE WHEN {strip(c)} = '' THEN '[aws] ''{name}'' is required but empty ({text})' END"


_KIND = strip("lower(coalesce(provider, ''))")
_CLOUD = f"""SELECT component, kind, list_filter(CASE {_KIND}
  WHEN 'azure' THEN [{_azure("srcConnectionString", "conn")}, {_azure("mapperConnectionString", "mconn")}, {_azure("targetConnectionString", "tconn")}]
  WHEN 'aws' THEN [{_aws("AWS_ACCESS_KEY_ID", "akey", "AWS / MinIO access key ID")}, {_aws("AWS_SECRET_ACCESS_KEY", "asecret", "AWS / MinIO secret access key")},
    {_aws("AWS_REGION", "aregion", "AWS region")}, {_aws("AWS_ENDPOINT_URL", "aurl", "S3-compatible endpoint URL")}]
  ELSE ['Unknown cloudProviderType ''' || coalesce(provider, 'None') || '''. Expected ''azure'' or ''aws'''] END, lambda e: e IS NOT NULL) AS errors
FROM configs WHERE kind = 'cloud'"""


def _entries(tag: str, c: str) -> str:
    return (
        f"list_transform(list_filter(CASE WHEN {c} = '' THEN [] ELSE string_split({c}, ',') END, lambda s: NOT contains(s, ':')), "
        f"lambda s: '[{tag}] invalid bootstrap entry ''' || s || ''' (expected host:port)')"
    )


def _spaces(tag: str, name: str, c: str) -> str:
    return f"CASE WHEN contains({c}, ' ') THEN '[{tag}] ''{name}'' must not contain spaces' END"


def _empty(tag: str, name: str, c: str, text: str) -> str:
    return f"CASE WHEN {c} = '' THEN '[{tag}] ''{name}'' {text}' END"


def _edge(tag: str, name: str, c: str, text: str) -> str:
    return f"CASE WHEN {c} <> '' AND {strip(c)} <> {c} THEN '[{tag}] ''{name}'' {text}' END"


_BOOT = strip("boot")
_KAFKA = _listed(
    "kafka",
    _empty("kafka", "bootstrapServer", _BOOT, "is required but empty"),
    _spaces("kafka", "bootstrapServer", _BOOT),
    _entries("kafka", _BOOT),
    _empty("kafka", "mapperTopicName", strip("map_topic"), "is required but empty"),
    _empty("kafka", "targetTopicName", strip("tgt_topic"), "is required but empty"),
)


def _producer(kind: str, tag: str, first: tuple[str, str], second: tuple[str, str]) -> str:
    need, edge = "is required but empty", "must not have leading/trailing spaces"
    meta = {"orgName": "org", "schemaType": "schema_t", "productType": "product", "SERVICE_NAME": "svc"}
    return _listed(
        kind,
        *[_empty(tag, n, c, need) for n, c in {**meta, "SERVICE_VERSION": "version"}.items()],
        *[_edge(tag, n, c, edge) for n, c in meta.items()],
        f"CASE WHEN version <> '' AND NOT regexp_matches(version, '^v?\\d+\\.\\d+\\.\\d+\\n?\\z') THEN '[{tag}] ''SERVICE_VERSION'' must follow format X.Y.Z' END",
        _empty(tag, "bootstrapServer", "boot", need),
        _empty(tag, "bootstrapServer", "boot", need),
        _spaces(tag, "bootstrapServer", "boot"),
        _entries(tag, "boot"),
        _empty(tag, first[0], first[1], need),
        _edge(tag, first[0], first[1], edge),
        _spaces(tag, first[0], first[1]),
        _edge(tag, second[0], second[1], edge),
        _spaces(tag, second[0], second[1]),
    )


_ADAPTOR = _producer("adaptor", "adaptor", ("srcTopicName", "src_topic"), ("mapperTopicName", "map_topic"))
_MAPPER = _producer("mapper", "schema-mapper", ("mapperTopicName", "map_topic"), ("targetTopicName", "tgt_topic"))


def _consumer(kind: str, tag: str, source: tuple[str, str], others: tuple[tuple[str, str], ...]) -> str:
    need, edge = "is required", "has leading/trailing spaces"
    tail = [f(tag, n, c, *a) for n, c in (source, *others) for f, a in ((_edge, (edge,)), (_spaces, ()))]
    return _listed(
        kind,
        _empty(tag, "bootstrapServer", "boot", need),
        _empty(tag, source[0], source[1], need),
        _empty(tag, "bootstrapServer", "boot", need),
        _spaces(tag, "bootstrapServer", "boot"),
        _entries(tag, "boot"),
        *tail,
    )


_EXTRACTOR = _consumer(
    "consumer-extractor", "extractor", ("srcTopicName", "src_topic"), (("mapperTopicName", "map_topic"),)
)
_CONSUMER_MAPPER = _consumer("consumer-mapper", "schema-mapper", ("mapperTopicName", "map_topic"), ())
_CONSUMER = f"{_EXTRACTOR} UNION ALL {_CONSUMER_MAPPER}"


def _kind(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    return t.configs(spark, sf).where(F.col("kind").isin(*kinds))


@query(_rows(_CLOUD))
def config_errors_cloud(spark: SparkSession, sf: str) -> DataFrame:
    return v.error_rows(v.validate_cloud(_kind(spark, sf, "cloud")), "component")


@query(_rows(_KAFKA))
def config_errors_kafka(spark: SparkSession, sf: str) -> DataFrame:
    return v.error_rows(v.validate_kafka(_kind(spark, sf, "kafka")), "component")


@query(_rows(_ADAPTOR))
def config_errors_adaptor(spark: SparkSession, sf: str) -> DataFrame:
    return v.error_rows(v.validate_adaptor(_kind(spark, sf, "adaptor")), "component")


@query(_rows(_MAPPER))
def config_errors_mapper(spark: SparkSession, sf: str) -> DataFrame:
    return v.error_rows(v.validate_mapper(_kind(spark, sf, "mapper")), "component")


@query(_rows(_CONSUMER))
def config_errors_consumer(spark: SparkSession, sf: str) -> DataFrame:
    extractor = v.validate_consumer(_kind(spark, sf, "consumer-extractor"), "extractor")
    mapper = v.validate_consumer(_kind(spark, sf, "consumer-mapper"), "schema-mapper")
    return v.error_rows(extractor.unionByName(mapper), "component")


@query(
    with_("configs")
    + f""", checked AS ({" UNION ALL ".join([_CLOUD, _KAFKA, _ADAPTOR, _MAPPER, _CONSUMER])})
SELECT component, upper(CASE kind WHEN 'mapper' THEN 'schema-mapper' WHEN 'consumer-extractor' THEN 'extractor'
    WHEN 'consumer-mapper' THEN 'schema-mapper' ELSE kind END)
  || CASE WHEN kind LIKE 'consumer%' THEN ' validation failed:' ELSE ' configuration validation failed' END AS summary,
  len(errors)::INTEGER AS error_count, array_to_string(errors, chr(10)) AS error_list
FROM checked WHERE len(errors) > 0"""
)
def config_report(spark: SparkSession, sf: str) -> DataFrame:
    return v.validation_report(v.validate_by_kind(t.configs(spark, sf)), "component")


# --- whole cycles over real objects -------------------------------------------
#
# Of the documents' objects some are staged already, some are lost from the staging area while the cycle
# stands still, and some don't pass the gate.

_LEAST_BYTES = 400


def _cycle_sql(dest: str) -> str:
    return f"""SELECT object_key, CASE WHEN outcome IN ('copied', 'refused', 'failed') THEN dest_key END AS dest_key, outcome,
  CASE outcome WHEN 'copied' THEN 'created' WHEN 'refused' THEN 'schema rule not met' WHEN 'failed' THEN 'source object not found' ELSE 'target up-to-date' END AS reason,
  CASE WHEN outcome = 'copied' THEN md5(body) END AS target_hash,
  CASE WHEN outcome = 'failed' THEN 'AWS S3: FileNotFoundError: source object not found' END AS error,
  (outcome = 'copied')::BIGINT AS events
FROM (SELECT object_key, {dest} AS dest_key, body,
  CASE WHEN doc_id % 10 = 3 THEN 'skipped' WHEN doc_id % 7 = 4 THEN 'failed' WHEN strlen(body) < {_LEAST_BYTES} OR body LIKE 'D%' THEN 'refused' ELSE 'copied' END AS outcome
  FROM {_OBJECTS})"""


def _cycle(spark: SparkSession, sf: str, label: str, dest: Column | None) -> DataFrame:
    """A cycle that is cut off after every stage, and loses staged objects on the way."""
    root = _container(spark, sf, label)
    out, source, staging, target = (f"{root}/{x}" for x in ("cycle", "source", "staging", "target"))
    objects = document_objects(spark, sf)
    write_objects(objects.where("doc_id % 10 = 3"), staging).write.parquet(f"{root}/staged-before")
    # a header rule: the first byte and the length are known without the whole object
    rule = (F.col("length") >= _LEAST_BYTES) & ~F.col("head").cast("string").startswith("D")

    def go_on(stop_after: str | None) -> DataFrame | None:
        return run_cycle(spark, source, staging, target, out, target_container="target", dest=dest, rule=rule, stop_after=stop_after)

    for stage in STAGES[:-1]:
        go_on(stage)
        if stage == "announced":
            lost = objects.where("doc_id % 7 = 4 AND doc_id % 10 <> 3").select("object_key")
            run_move(lost, list_all(spark, staging), staging, f"{root}/lost", f"{root}/losing")
    report = go_on(None)
    events = spark.read.parquet(f"{out}/8-published").select(F.from_json(F.col("value").cast("string"), "path string")["path"].alias("dest_key"))
    told = report.join(events.groupBy("dest_key").agg(F.count(F.lit(1)).alias("events")), "dest_key", "left")
    return told.select(
        "object_key", "dest_key", "outcome",
        F.when(F.col("outcome") == "skipped", F.substring_index("reason", " (", 1)).otherwise(F.col("reason")).alias("reason"),
        "target_hash", F.concat_ws(": ", "error.provider", "error.type", "error.message").alias("error"),
        F.coalesce("events", F.lit(0).cast("bigint")).alias("events"),
    ).withColumn("error", F.when(F.col("error") != "", F.col("error")))


@query(_cycle_sql("'naturalgas-mole-' || lower(replace(replace(object_key, ' ', '_'), '-', '_'))"))
def producer_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Producer cycle over real objects: one row each, with the target's hash and the events sent."""
    return _cycle(spark, sf, "producer", mapped_name(F.lit("NaturalGas"), F.lit("Mole"), F.col("object_key")))


@query(_cycle_sql("object_key"))
def consumer_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """The consumer's cycle keeps names."""
    return _cycle(spark, sf, "consumer", None)
