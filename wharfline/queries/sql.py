"""SQL forms of the derived records, written for DuckDB, as named common table expressions."""

from __future__ import annotations

BLANK = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SAFE = r"^[\p{L}\p{N}_.\-/]+\n?\z"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+\\z', '', 'g')"


def sanitize(x: str, default: str = "unknown") -> str:
    kept = f"lower(regexp_replace(coalesce(nullif({x}, ''), '{default}'), '[^A-Za-z0-9]', '', 'g'))"
    return f"coalesce(nullif({kept}, ''), '{default}')"


def at(seconds: str) -> str:
    return f"(TIMESTAMP '2026-01-01 00:00:00' + to_seconds({seconds}))"


def us(ts: str) -> str:
    return f"epoch_us({ts})"


def iso(ts: str) -> str:
    """ISO text of a timestamp; the fraction is left out when it is zero."""
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
        f"ELSE '.' || lpad((epoch_us({ts}) % 1000000)::VARCHAR, 6, '0') END || '+00:00')"
    )


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, body: str, *needs: str) -> None:
    _CTES[name] = (needs, body)


def with_(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause holding the named expressions and all they build on."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for need in _CTES[n][0]:
            visit(need)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered) + "\n"


# --- topic messages ----------------------------------------------------------

_cte(
    "named",
    """
SELECT e.event_id, e.ts, e.user_id, e.props, n.n_name AS org,
  CASE WHEN e.event_type = 'error' AND e.event_id % 2 = 0 THEN NULL
       WHEN e.event_type = 'error' THEN 'Un-Known' ELSE 'EQ ' || e.event_type END AS s,
  CASE WHEN e.value < 5 THEN 'Gas Low' WHEN e.value < 25 THEN 'gas-MID' ELSE 'Gas_High #1' END AS p
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25""",
)
_cte(
    "messages",
    """
SELECT CASE WHEN event_id % 13 <> 0 THEN user_id::VARCHAR END AS key,
  CASE WHEN event_id % 97 <> 0 THEN props END AS value,
  'src-topic' AS topic, (user_id % 4)::INTEGER AS partition, event_id AS "offset", ts AS "timestamp",
  event_id % 101 = 0 AS broken,
  list_filter([
    CASE WHEN event_id % 5 = 3 AND s IS NOT NULL THEN {'k': 'Schema_Type', 'v': 'stale'}
         WHEN event_id % 5 = 4 AND s IS NOT NULL THEN {'k': 'schema_type', 'v': ''} END,
    CASE WHEN s IS NOT NULL THEN {'k': ['schema_type','schemaType','SCHEMATYPE','schema_type','schematype'][event_id % 5 + 1], 'v': s} END,
    CASE WHEN event_id % 5 = 3 AND s IS NOT NULL THEN {'k': 'Schema_Type', 'v': s || ' v2'} END,
    {'k': ['org_name','orgName','ORGNAME','org_name','org_name'][event_id % 5 + 1], 'v': org},
    {'k': ['product_type','productType','PRODUCTTYPE','product_type','product_type'][event_id % 5 + 1], 'v': p},
    CASE WHEN event_id % 3 = 0 THEN {'k': 'traceparent', 'v': '00-' || md5(event_id::VARCHAR) || '-' || substr(md5('s' || event_id), 1, 16) || '-01'} END,
    CASE WHEN event_id % 101 = 0 THEN {'k': 'note', 'v': '?'} END
  ], lambda h: h IS NOT NULL) AS headers
FROM named""",
    "named",
)
_cte(
    "control_topic",
    """
SELECT event_id AS "offset", (user_id % 4)::INTEGER AS partition, ts AS "timestamp", event_id % 11 = 3 AS broken,
  CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN body[1:20] WHEN 2 THEN '[' || body || ']' WHEN 4 THEN event_id::VARCHAR
    WHEN 5 THEN body || '} x' ELSE body END AS value
FROM (SELECT *, '{"stage":"' || event_type || '","product":"p' || user_id % 7 || '"' || CASE WHEN event_id % 7 = 0 THEN ''
    WHEN event_id % 5 = 0 THEN ',"run_id":' || event_id ELSE ',"run_id":"r' || event_id || '"' END || ',"extra":' || props || '}' AS body FROM events)""",
)
_cte(
    "control_checked",
    """
SELECT *, CASE WHEN value IS NULL THEN 'null value' WHEN broken THEN 'not utf-8' WHEN NOT json_valid(value) THEN 'malformed json'
  WHEN json_type(value) <> 'OBJECT' THEN 'not an object' END AS reason FROM control_topic""",
    "control_topic",
)
_cte(
    "header_rows",
    """SELECT "offset", unnest(headers) AS h, generate_subscripts(headers, 1) AS pos FROM messages""",
    "messages",
)
_cte(
    "header_spellings",
    """SELECT "offset", h.k AS k, min(pos) AS first_pos, arg_max(h.v, pos) AS v FROM header_rows GROUP BY 1, 2""",
    "header_rows",
)
_cte(
    "header_values",
    """SELECT "offset", lower(k) AS k, arg_max(v, first_pos) AS v FROM header_spellings GROUP BY 1, 2""",
    "header_spellings",
)
_cte(
    "header_table",
    """SELECT "offset",
  coalesce(nullif(max(v) FILTER (k = 'schema_type'), ''), nullif(max(v) FILTER (k = 'schematype'), '')) AS s,
  coalesce(nullif(max(v) FILTER (k = 'org_name'), ''), nullif(max(v) FILTER (k = 'orgname'), '')) AS o,
  coalesce(nullif(max(v) FILTER (k = 'product_type'), ''), nullif(max(v) FILTER (k = 'producttype'), '')) AS p,
  max(v) FILTER (k = 'traceparent') AS trace
FROM header_values GROUP BY 1""",
    "header_values",
)
_cte(
    "fields",
    f"""SELECT m.*, h.trace, {sanitize("h.s")} AS schema_type, {sanitize("h.o")} AS org_name,
  {sanitize("h.p")} AS product_type FROM messages m JOIN header_table h USING ("offset")""",
    "messages",
    "header_table",
)
_cte(
    "checked",
    """SELECT *, CASE WHEN broken THEN 'header not utf-8'
  WHEN 'unknown' IN (schema_type, org_name, product_type) THEN 'unknown metadata: ' || concat_ws(',',
    CASE WHEN schema_type = 'unknown' THEN 'schema_type' END,
    CASE WHEN org_name = 'unknown' THEN 'org_name' END,
    CASE WHEN product_type = 'unknown' THEN 'product_type' END) END AS reject_reason,
  CASE WHEN NOT broken AND 'unknown' NOT IN (schema_type, org_name, product_type)
    THEN 'dpn-consumer-' || org_name || '-' || schema_type || '-' || product_type || '-target' END AS target,
  sha256('src-topic-' || partition || '-' || "offset") AS digest
FROM fields""",
    "fields",
)
_cte(
    "known_topics",
    """SELECT 'dpn-consumer-' || lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) || '-' || x || '-target' AS topic
FROM nation JOIN region ON n_regionkey = r_regionkey,
  (VALUES ('eqclick-gaslow'), ('eqview-gasmid'), ('eqview-gashigh1')) v(x)
WHERE n_nationkey % 2 = 0 AND r_name <> 'ASIA'""",
)

# --- objects -----------------------------------------------------------------

_cte(
    "keyed",
    """SELECT page_id AS p, url, html, CASE WHEN page_id % 5 = 0 THEN url
  ELSE regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') || '/' || page_id END AS object_key
FROM pages""",
)
_cte(
    "src",
    f"""SELECT p, object_key, {at("p * 3600")} AS modified, strlen(html) AS length,
  'container-' || (p % 7) AS container, html FROM keyed WHERE p % 29 <> 7""",
    "keyed",
)
_cte(
    "tgt",
    f"""SELECT p, object_key, {at("p * 3600 + ((p // 3) % 3 - 1) * 3600")} AS modified
FROM keyed WHERE p % 3 <> 0""",
    "keyed",
)
_cte(
    "asked",
    """SELECT p, object_key, CASE WHEN p % 10 = 1 THEN 3 ELSE 1 END AS requests FROM keyed""",
    "keyed",
)
_cte(
    "plan",
    f"""SELECT a.object_key, a.requests, s.modified AS sm, t.modified AS tm,
  regexp_matches(a.object_key, '{SAFE}') AS safe,
  CASE WHEN NOT regexp_matches(a.object_key, '{SAFE}') THEN 'unsafe object key'
       WHEN s.modified IS NULL THEN 'source object not found'
       WHEN t.modified IS NULL THEN 'created'
       WHEN s.modified > t.modified THEN 'overwritten'
       ELSE 'target up-to-date (src=' || {iso("s.modified")} || ', tgt=' || {iso("t.modified")} || ')' END AS reason
FROM asked a LEFT JOIN src s USING (object_key) LEFT JOIN tgt t ON t.object_key = a.object_key""",
    "asked",
    "src",
    "tgt",
)
_cte(
    "file_messages",
    """SELECT p, object_key, p % 31 = 30 AS broken,
  CASE WHEN p % 11 = 5 THEN 'bad' WHEN p % 11 = 6 THEN '[]' WHEN p % 11 = 7 THEN '[{"path":"z"}]'
       WHEN p % 11 = 8 THEN '{"sourceType":"S3"}' WHEN p % 11 = 9 THEN '{"path":""}'
       WHEN p % 11 <> 10 THEN '{"sourceType":"S3","storageContainer":"staging","path":"' || object_key || '"}' END AS value
FROM keyed""",
    "keyed",
)
_cte(
    "decoded",
    """SELECT *, CASE WHEN broken THEN 'not utf-8' WHEN value IS NULL THEN 'null value'
  WHEN NOT json_valid(value) OR json_type(CASE WHEN json_valid(value) THEN value ELSE '0' END) <> 'OBJECT' THEN 'malformed json'
  WHEN coalesce(json_extract_string(value, '$.path'), '') = '' THEN 'missing path' END AS reason
FROM file_messages""",
    "file_messages",
)

# --- triggers and statuses ---------------------------------------------------

_cte(
    "runs",
    """SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, 'run:' || (o_orderkey // 4) AS run_id,
  'p' || ((o_orderkey // 4) % 5) AS product,
  CASE WHEN CASE WHEN (o_orderkey // 4) % 3 = 0 THEN o_orderkey % 2 = 0 ELSE o_orderkey % 4 < 2 END
       THEN 'adaptor' ELSE 'schema_mapper' END AS stage,
  CASE WHEN (o_orderkey // 4) % 3 < 2 THEN 'file' ELSE 'topic' END AS pipeline_type,
  CASE WHEN (o_orderkey // 4) % 4 < 3 THEN 'producer' ELSE 'consumer' END AS pipeline_role
FROM orders""",
)
_cte(
    "triggers",
    f"""SELECT k AS "offset", stage, pipeline_type, pipeline_role, product,
  CASE WHEN k % 41 <> 40 THEN run_id END AS run_id, 'dag-' || run_id AS dag_run_id,
  CASE WHEN k % 7 <> 0 THEN 'exchange' END AS dag_id,
  CASE WHEN s = 'O' AND k % 2 = 0 THEN 'manual' WHEN s = 'O' THEN ' MANUAL' || chr(9)
       WHEN s = 'P' THEN 'automatic' WHEN k % 3 = 0 THEN NULL ELSE 'x' END AS execution_mode,
  CASE WHEN s = 'O' THEN 'manual' ELSE 'automatic' END AS mode,
  {at("k * 60")} AS "timestamp", k * 60 * 100000 AS start_offset,
  (k * 60 + 1767225600) * 1000000 AS start_us, c % 40 * 20000000 AS duration_us, c % 11 = 0 AS run_failed
FROM runs""",
    "runs",
)
_cte(
    "statuses",
    f"""SELECT CASE WHEN k % 5 = 4 THEN 1 ELSE 0 END AS partition,
  CASE WHEN k % 5 = 4 THEN k ELSE (k * 60 + c % 40 * 20) * 100000 + k % 100000 END AS "offset", stage, pipeline_type, pipeline_role, product, run_id,
  CASE WHEN c % 11 = 0 THEN 'failed' WHEN c % 7 = 0 THEN 'skipped' ELSE 'completed' END AS status,
  CASE WHEN c % 11 = 0 THEN 'ValueError: bad input' END AS error,
  (c % 40 * 20000000 + k % 1000) / 1000.0::DOUBLE AS duration_ms,
  {at("k * 60 + c % 40 * 20")} AS "timestamp"
FROM runs WHERE c % 9 <> 0""",
    "runs",
)
_cte(
    "decided",
    """SELECT *, CASE WHEN run_id = last_run THEN 'completed' WHEN mode = 'manual' THEN 'skipped' ELSE 'execute' END AS decision
FROM (SELECT *, last_value(CASE WHEN mode <> 'manual' THEN run_id END IGNORE NULLS) OVER (
    PARTITION BY product, stage ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_run
  FROM triggers WHERE run_id IS NOT NULL)""",
    "triggers",
)
_cte(
    "awaited",
    """SELECT t.run_id, t.stage, t.product, t."offset", t.start_offset, t."timestamp",
  CASE WHEN s."timestamp" <= t."timestamp" + INTERVAL 600 SECONDS THEN s."offset" END AS status_offset,
  CASE WHEN s."timestamp" <= t."timestamp" + INTERVAL 600 SECONDS THEN s.status END AS status,
  CASE WHEN s."timestamp" <= t."timestamp" + INTERVAL 600 SECONDS THEN s."timestamp" END AS status_at,
  CASE WHEN s."timestamp" IS NULL OR s."timestamp" > t."timestamp" + INTERVAL 600 SECONDS THEN 'timeout'
       WHEN s.status = 'failed' THEN 'error' ELSE 'success' END AS outcome
FROM triggers t LEFT JOIN LATERAL (
  SELECT arg_min(x."timestamp", x."offset") AS "timestamp", min(x."offset") AS "offset", arg_min(x.status, x."offset") AS status
  FROM statuses x WHERE x.run_id = t.run_id AND x.stage = t.stage AND x.product = t.product AND x."offset" >= t.start_offset
    AND x.partition = 0
) s ON true""",
    "triggers",
    "statuses",
)

# --- steps, metrics, heartbeats ----------------------------------------------

_cte(
    "steps",
    """SELECT event_id, ts, 'run-' || user_id AS run_id,
  CASE user_id % 3 WHEN 0 THEN 'adaptor' WHEN 1 THEN 'extractor' ELSE 'schema_mapper' END AS stage,
  CASE WHEN user_id % 2 = 0 THEN 'file' ELSE 'topic' END AS type,
  CASE WHEN user_id % 5 < 3 THEN 'producer' ELSE 'consumer' END AS role,
  CASE WHEN user_id % 7 = 0 THEN 'manual' ELSE 'automatic' END AS mode,
  'op' || (event_id % 2) AS operation,
  CASE event_type WHEN 'signup' THEN 'started' WHEN 'click' THEN 'started' WHEN 'purchase' THEN 'completed'
    WHEN 'error' THEN 'failed' ELSE 'skipped' END AS event,
  CASE WHEN event_type = 'error' THEN ['ClientError','AzureError','GoogleAPIError','ValueError','BotoCoreError','HttpResponseError'][event_id % 6 + 1] END AS error_type,
  CASE WHEN event_type = 'error' THEN 'code ' || (event_id % 5) END AS error_message,
  floor(value * 100 + 0.5)::BIGINT AS duration_us
FROM events""",
)
_cte(
    "timed",
    """SELECT *, CASE WHEN pe = 'started' THEN round((epoch_us(ts) - epoch_us(pt)) / 1000.0::DOUBLE, 3) ELSE 0.0 END AS duration_ms
FROM (SELECT *, lag(event) OVER w AS pe, lag(ts) OVER w AS pt FROM steps WHERE event <> 'skipped'
  WINDOW w AS (PARTITION BY run_id, operation ORDER BY ts, event_id)) WHERE event IN ('completed', 'failed')""",
    "steps",
)
_cte(
    "points",
    """SELECT name, kind, CASE WHEN kind = 'updown' AND event_id % 2 = 0 THEN -value ELSE value END AS value,
  '{"cloud_provider":"' || provider || '","status":"' || status || '"}' AS attributes, ts
FROM (SELECT event_id, value, ts, event_type || '_total' AS name,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'counter' WHEN event_type = 'purchase' THEN 'histogram' ELSE 'updown' END AS kind,
  CASE WHEN user_id % 3 = 0 THEN 'azure' ELSE 'aws' END AS provider,
  CASE WHEN event_type = 'error' THEN 'error' WHEN user_id % 5 = 0 THEN 'skipped' ELSE 'success' END AS status FROM events)""",
)
_cte(
    "beats",
    """SELECT 'component-' || user_id AS component, date_trunc('day', ts) AS started_at, ts, event_id
FROM events""",
)

# --- settings ----------------------------------------------------------------

_cte(
    "configs",
    r"""SELECT 'component-' || c_custkey AS component,
  ['cloud','kafka','adaptor','mapper','consumer-extractor','consumer-mapper'][c_custkey % 6 + 1] AS kind,
  ['azure',' AWS ','aws','gcp',NULL][q % 5 + 1] AS provider,
  CASE q % 7 WHEN 0 THEN '!!!!' WHEN 1 THEN 'abc' WHEN 2 THEN ' ' WHEN 3 THEN 'ab=c=' || chr(10) || 'd=' ELSE good END AS conn,
  good AS mconn, CASE WHEN q % 3 <> 0 THEN good ELSE '' END AS tconn,
  CASE WHEN q % 4 <> 0 THEN 'key' ELSE '' END AS akey,
  CASE WHEN q % 6 = 0 THEN '  ' ELSE 'secret' END AS asecret, 'eu-west-2' AS aregion,
  CASE WHEN q % 9 <> 0 THEN 'http://store:9000' ELSE '' END AS aurl,
  coalesce(['host:9092','a:1,b:2','host','',' a:1 ','a:1, b','a:1,,c',NULL][q % 8 + 1], '') AS boot,
  coalesce(['eq-topic','',' eq','e q','eq ',NULL,'ok.topic'][q % 7 + 1], '') AS src_topic,
  coalesce(CASE WHEN c_custkey % 6 IN (3, 5) THEN ['eq-topic','',' eq','e q','eq ',NULL,'ok.topic'][q % 7 + 1]
    ELSE ['map-topic','','ma p ',NULL,'m'][q % 5 + 1] END, '') AS map_topic,
  coalesce(['map-topic','','ma p ',NULL,'m'][q % 5 + 1], '') AS tgt_topic,
  CASE q % 10 WHEN 0 THEN ' quay' WHEN 1 THEN '' ELSE 'quay' END AS org,
  CASE WHEN q % 11 = 0 THEN 'eq ' ELSE 'eq' END AS schema_t,
  CASE WHEN q % 13 <> 0 THEN 'gas' ELSE '' END AS product,
  CASE WHEN q % 12 = 0 THEN '' ELSE 'svc' END AS svc,
  ['0.0.1','v1.2.3','invalid','1.2','','1.2.3' || chr(10)][q % 6 + 1] AS version
FROM (SELECT c_custkey, c_custkey // 6 AS q, base64(encode(c_name)) AS good FROM customer)""",
)
