"""Triggers, decisions, statuses, waiting, timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.context import Identity, context_attributes, context_valid, run_context
from ..functions.text import iso_utc, json_of_map
from ..operators import triggers as op
from ..operators.ordered import chunk_by_offset
from ..operators.screening import REASON, decode_documents, with_fields
from ..plans.controlled import published_statuses
from . import tables as t
from .registry import query
from .sql import iso, us, with_

ME = Identity("adaptor", "file", "producer", "p1", "producer-file-adaptor")
_MINE = "stage = 'adaptor' AND pipeline_type = 'file' AND pipeline_role = 'producer' AND product = 'p1'"
CHUNK = 4096  # offsets per window group for the one-partition control topic
STATUS_CHUNK = 86_400 * t.TICKS  # a day of log time on the sparse status offsets


_CONTROL_FIELDS = {
    "stage": ("$.stage", "string"),
    "product": ("$.product", "string"),
    "run_id": ("$.run_id", "string"),
    "k": ("$.extra.k", "bigint"),
}


@query(
    with_("control_checked")
    + """SELECT partition, "offset", reason, d->>'$.stage' AS stage, d->>'$.product' AS product, d->>'$.run_id' AS run_id, (d->>'$.extra.k')::BIGINT AS k
FROM (SELECT *, CASE WHEN reason IS NULL THEN value::JSON END AS d FROM control_checked)"""
)
def control_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every control message with its fields or the reason why it is passed over."""
    decoded = with_fields(decode_documents(t.control_topic(spark, sf)), _CONTROL_FIELDS)
    return decoded.select("partition", "offset", F.col(REASON).alias("reason"), *_CONTROL_FIELDS)


@query(
    with_("control_checked")
    + """SELECT coalesce(reason, 'decoded') AS outcome, count(*) AS messages, count(*) FILTER (value::VARCHAR LIKE '%"run_id":"%') AS named
FROM control_checked WHERE reason IS NULL GROUP BY 1
UNION ALL SELECT reason, count(*), 0 FROM control_checked WHERE reason IS NOT NULL GROUP BY 1"""
)
def control_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the control messages; the counts add up to the input."""
    decoded = decode_documents(t.control_topic(spark, sf))
    named = F.schema_of_variant(F.try_variant_get("body", "$.run_id", "variant")) == "STRING"
    outcome = F.coalesce(F.col(REASON), F.lit("decoded")).alias("outcome")
    return decoded.groupBy(outcome).agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.coalesce(named, F.lit(False))).alias("named"))


@query(with_("triggers") + f'SELECT "offset", run_id, mode FROM triggers WHERE {_MINE}')
def trigger_match(spark: SparkSession, sf: str) -> DataFrame:
    return op.match_triggers(t.triggers(spark, sf), ME).select(
        "offset", "run_id", F.when(op.skip_manual(), "manual").otherwise("automatic").alias("mode")
    )


@query(
    with_("triggers")
    + """SELECT decision, count(*) AS triggers FROM (
  SELECT CASE WHEN run_id IS NULL THEN 'dead letter: trigger without run id' ELSE 'decided' END AS decision FROM triggers) GROUP BY 1"""
)
def trigger_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Every trigger is either decided or a dead letter."""
    rows = t.triggers(spark, sf)
    decided = op.decide_triggers(rows, chunk=chunk_by_offset("offset", CHUNK)).select(F.lit("decided").alias("decision"))
    dead = op.trigger_dead_letters(rows).select(F.concat(F.lit("dead letter: "), "reject_reason").alias("decision"))
    return decided.unionByName(dead).groupBy("decision").agg(F.count(F.lit(1)).alias("triggers"))


DECISION_SQL = with_("decided") + 'SELECT product, stage, "offset", run_id, mode, decision FROM decided'


@query(DECISION_SQL)
def trigger_decisions(spark: SparkSession, sf: str) -> DataFrame:
    decided = op.decide_triggers(t.triggers(spark, sf), chunk=chunk_by_offset("offset", CHUNK))
    return decided.select("product", "stage", "offset", "run_id", "mode", "decision")


@query(
    with_("triggers")
    + """SELECT product, stage, "offset", run_id,
  CASE WHEN run_id = last_run THEN 'completed' WHEN mode = 'manual' THEN 'skipped' ELSE 'execute' END AS decision
FROM (SELECT *, last_value(CASE WHEN mode <> 'manual' AND NOT run_failed THEN run_id END IGNORE NULLS) OVER (
    PARTITION BY product, stage ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_run
  FROM triggers WHERE run_id IS NOT NULL)"""
)
def trigger_retries(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions when failed runs may be triggered again."""
    decided = op.decide_triggers(
        t.triggers(spark, sf), chunk=chunk_by_offset("offset", CHUNK), remember_failures=False
    )
    return decided.select("product", "stage", "offset", "run_id", "decision")


@query(
    with_("triggers")
    + """SELECT product, stage, min("offset") AS "offset", arg_min(dag_run_id, "offset") AS dag_run_id, arg_min(mode, "offset") AS mode
FROM triggers GROUP BY 1, 2"""
)
def first_trigger(spark: SparkSession, sf: str) -> DataFrame:
    return op.first_trigger(t.triggers(spark, sf)).select(
        "product",
        "stage",
        "offset",
        "dag_run_id",
        F.when(op.skip_manual(), "manual").otherwise("automatic").alias("mode"),
    )


@query(
    with_("triggers")
    + f"""SELECT "offset", run_id AS key, '{{"stage":"' || stage || '","pipeline_type":"' || pipeline_type || '","pipeline_role":"' || pipeline_role
  || '","product":"' || product || '","run_id":"' || run_id || '","dag_run_id":"' || dag_run_id || '","dag_id":'
  || coalesce('"' || dag_id || '"', 'null') || ',"execution_mode":"' || replace(coalesce(execution_mode, 'automatic'), chr(9), '\\t')
  || '","triggered_by":"airflow","timestamp":"' || {iso('"timestamp"')} || '"}}' AS value
FROM triggers WHERE run_id IS NOT NULL"""
)
def trigger_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.triggers(spark, sf).where(F.col("run_id").isNotNull())
    built = op.build_triggers(rows)
    minute = F.from_json(F.col("value").cast("string"), "timestamp string")["timestamp"]
    offset = F.floor((F.unix_micros(F.to_timestamp(minute)) / 1_000_000 - t.BASE_SECS) / 60).cast("bigint")
    return built.select(
        offset.alias("offset"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


@query(
    with_("statuses")
    + f"""SELECT run_id AS key, stage, product, status, error, round(duration_ms, 3) AS duration_ms, {iso('"timestamp"')} AS at, count(*) AS n
FROM statuses GROUP BY ALL"""
)
def status_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses written as messages and read back."""
    fields = "run_id string, stage string, product string, status string, error string, duration_ms double, timestamp string"
    sent = op.build_statuses(t.statuses(spark, sf))
    body = F.from_json(F.col("value").cast("string"), fields)
    return (
        sent.select(F.col("key").cast("string").alias("key"), body.alias("b"))
        .groupBy("key", "b.stage", "b.product", "b.status", "b.error", "b.duration_ms", F.col("b.timestamp").alias("at"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(with_("statuses") + 'SELECT coalesce(max("offset") + 1, 0)::BIGINT AS end_offset FROM statuses WHERE partition = 0')
def status_end_offset(spark: SparkSession, sf: str) -> DataFrame:
    return op.end_offset(t.statuses(spark, sf))


def _awaited(spark: SparkSession, sf: str) -> DataFrame:
    asks = t.triggers(spark, sf).where(F.col("run_id").isNotNull()).select(
        "run_id", "stage", "product", "offset", "start_offset", "timestamp"
    )
    return op.await_status(asks, t.statuses(spark, sf), 600, STATUS_CHUNK)


AWAIT_SQL = (
    with_("awaited")
    + """SELECT "offset", run_id, stage, product, coalesce(status_offset, -1) AS status_offset, status, outcome
FROM awaited WHERE run_id IS NOT NULL"""
)


@query(AWAIT_SQL)
def await_status(spark: SparkSession, sf: str) -> DataFrame:
    return _awaited(spark, sf).select(
        "offset",
        "run_id",
        "stage",
        "product",
        F.coalesce("status_offset", F.lit(-1)).alias("status_offset"),
        "status",
        "outcome",
    )


@query(
    with_("awaited")
    + f""", f AS (SELECT run_id, product, stage, arg_min(outcome, "offset") AS outcome, arg_min("timestamp", "offset") AS at,
    arg_min({us("status_at")}, "offset") FILTER (status_at IS NOT NULL) AS any_done, min("offset") AS o FROM awaited WHERE run_id IS NOT NULL GROUP BY 1, 2, 3),
  g AS (SELECT f.*, {us("a.status_at")} AS done FROM f JOIN awaited a ON a."offset" = f.o)
SELECT coalesce(x.run_id, y.run_id) AS run_id, coalesce(x.product, y.product) AS product,
  coalesce(x.outcome, 'not triggered') AS first_outcome, coalesce(y.outcome, 'not triggered') AS second_outcome,
  coalesce(x.done - {us("x.at")}, -1) AS first_micros, coalesce(y.done - {us("y.at")}, -1) AS second_micros,
  coalesce(x.outcome = 'success' AND y.outcome = 'success' AND {us("y.at")} >= x.done, false) AS chain_complete
FROM (SELECT * FROM g WHERE stage = 'adaptor') x FULL JOIN (SELECT * FROM g WHERE stage = 'schema_mapper') y
  ON x.run_id = y.run_id AND x.product = y.product"""
)
def run_timeline(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(-1)
    return op.run_timeline(_awaited(spark, sf)).withColumns(
        {c: F.coalesce(c, none) for c in ("first_micros", "second_micros")}
    )


@query(
    with_("triggers", recursive=True)
    + """, d AS (SELECT product, stage, "offset", start_us, start_us + duration_us AS end_us,
    row_number() OVER (PARTITION BY product, stage ORDER BY start_us, "offset") AS n FROM triggers),
  ends AS (SELECT product, stage, start_us, min(n) AS n FROM d GROUP BY 1, 2, 3),
  nx AS (SELECT d.product, d.stage, d.n, d."offset", e.n AS next_n FROM d ASOF LEFT JOIN ends e
    ON d.product = e.product AND d.stage = e.stage AND d.end_us <= e.start_us),
  fixed AS (SELECT *, CASE WHEN next_n <= n THEN n + 1 ELSE next_n END AS follow FROM nx),
  walk AS (SELECT product, stage, n, "offset", follow FROM fixed WHERE n = 1
    UNION ALL SELECT f.product, f.stage, f.n, f."offset", f.follow FROM walk w JOIN fixed f
      ON f.product = w.product AND f.stage = w.stage AND f.n = w.follow)
SELECT d.product, d.stage, d."offset", w."offset" IS NOT NULL AS accepted FROM d LEFT JOIN walk w USING ("offset")"""
)
def overlap_flags(spark: SparkSession, sf: str) -> DataFrame:
    runs = t.triggers(spark, sf).select(
        "product", "stage", "offset", "start_us", (F.col("start_us") + F.col("duration_us")).alias("end_us")
    )
    return op.overlap_flags(runs, chunk_secs=30 * 86_400).select("product", "stage", "offset", "accepted")


_CONTEXT_SQL = f"""SELECT "offset", '{{' || '"component.name":"producer-file-adaptor","pipeline.dag_id":"' || coalesce(dag_id, '')
  || '","pipeline.dag_run_id":"' || dag_run_id || '","pipeline.mode":"' || mode || '","pipeline.role":"producer","pipeline.run_id":"' || run_id
  || '","pipeline.stage":"adaptor","pipeline.started_at":"' || {iso('"timestamp"')}
  || '","pipeline.triggered_by":"kafka-trigger","pipeline.type":"file"}}' AS attributes, true AS valid
FROM triggers WHERE {_MINE} AND run_id IS NOT NULL"""


@query(with_("triggers") + _CONTEXT_SQL)
def run_contexts(spark: SparkSession, sf: str) -> DataFrame:
    mine = op.match_triggers(t.triggers(spark, sf), ME).where(F.col("run_id").isNotNull())
    ctx = F.col("context")
    return run_context(mine, ME, F.col("timestamp")).select(
        "offset",
        json_of_map(context_attributes(ctx, iso_utc(ctx["started_at"]))).alias("attributes"),
        context_valid(ctx).alias("valid"),
    )


def run_results(spark: SparkSession, sf: str) -> DataFrame:
    """How executed runs ended; some never do."""
    c = F.col("o_custkey")
    return t.table(spark, sf, "orders").where(c % 9 != 0).select(
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.when(c % 11 == 0, "failed").otherwise("completed").alias("run_status"),
        F.when(c % 11 == 0, "ValueError: bad input").alias("run_error"),
        (c % 40 * 20_000_000).alias("duration_us"),
    )


@query(
    with_("decided", "statuses")
    + """SELECT d.product, d.stage, d.decision, CASE WHEN d.decision = 'execute' THEN r.run_status ELSE d.decision END AS status,
  CASE WHEN d.decision = 'execute' THEN r.run_error END AS error, count(*) AS runs,
  sum(CASE WHEN d.decision = 'execute' THEN r.took ELSE 0 END)::BIGINT AS total_us
FROM decided d LEFT JOIN (SELECT k AS "offset", CASE WHEN c % 11 = 0 THEN 'failed' ELSE 'completed' END AS run_status,
    CASE WHEN c % 11 = 0 THEN 'ValueError: bad input' END AS run_error, c % 40 * 20000000 AS took FROM runs WHERE c % 9 <> 0) r USING ("offset")
WHERE d.decision <> 'execute' OR r.run_status IS NOT NULL
GROUP BY 1, 2, 3, 4, 5"""
)
def controlled_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Trigger, decide, run, answer: totals per runner."""
    results = run_results(spark, sf)
    triggers = t.triggers(spark, sf).drop("duration_us")
    answered = published_statuses(triggers, results, chunk_by_offset("offset", CHUNK))
    return answered.groupBy("product", "stage", "decision", "status", "error").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.round(F.col("duration_ms") * 1000).cast("bigint")).alias("total_us"),
    )
