"""Run context, durations, severities and log attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, map_of, strip

# The closed sets of a run's identity.
STAGES = ("adaptor", "extractor", "schema_mapper", "unknown")
TYPES = ("file", "topic")
ROLES = ("producer", "consumer")
MODES = ("manual", "automatic")
ORIGINS = ("airflow", "interval", "standalone", "kafka-trigger")


@dataclass(frozen=True)
class Identity:
    """What a runner is. It is set by the runner, never taken from a message."""

    stage: str
    type: str
    role: str
    product: str = "unknown"
    component: str = ""

    def __post_init__(self) -> None:
        if self.stage not in STAGES or self.type not in TYPES or self.role not in ROLES:
            raise ValueError(f"unknown stage, type or role: {self}")


def execution_mode(mode: Column | str) -> Column:
    """``manual`` or ``automatic``; everything that is not manual is automatic."""
    clean = F.lower(strip(F.coalesce(col(mode), F.lit("automatic"))))
    return F.when(clean == "manual", "manual").otherwise("automatic")


def run_context(
    triggers: DataFrame, identity: Identity, started_at: Column | None = None, origin: str = "kafka-trigger"
) -> DataFrame:
    """Context columns for each trigger; a missing run id gets one from the message's place.

    A task that runs again gives the same id. Rows without a place fall back to their dag run and time.
    """
    place = [F.col(c).cast("string") for c in ("topic", "partition", "offset", "dag_run_id", "timestamp") if c in triggers.columns]
    named = F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in place]))
    parts = [F.substring(named, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return triggers.select(
        "*",
        F.struct(
            F.coalesce(F.col("run_id"), F.concat_ws("-", *parts)).alias("run_id"),
            execution_mode("execution_mode").alias("mode"),
            F.lit(origin).alias("triggered_by"),
            F.lit(identity.stage).alias("pipeline_stage"),
            F.lit(identity.type).alias("pipeline_type"),
            F.lit(identity.role).alias("pipeline_role"),
            F.coalesce(F.col("dag_run_id"), F.lit("")).alias("dag_run_id"),
            F.coalesce(F.col("dag_id"), F.lit("")).alias("dag_id"),
            (F.current_timestamp() if started_at is None else started_at).alias("started_at"),
            F.lit(identity.component).alias("component_name"),
        ).alias("context"),
    )


def context_valid(ctx: Column) -> Column:
    """True when all parts of a context are from their closed sets."""
    return (
        ctx["pipeline_stage"].isin(*STAGES)
        & ctx["pipeline_type"].isin(*TYPES)
        & ctx["pipeline_role"].isin(*ROLES)
        & ctx["mode"].isin(*MODES)
        & ctx["triggered_by"].isin(*ORIGINS)
    )


def context_attributes(ctx: Column, started_at_text: Column | None = None) -> Column:
    """Context as ``pipeline.*`` log attributes; ``component.name`` only where it is set."""
    return map_of(
        {
            "component.name": F.nullif(ctx["component_name"], F.lit("")),
            "pipeline.run_id": ctx["run_id"],
            "pipeline.mode": ctx["mode"],
            "pipeline.triggered_by": ctx["triggered_by"],
            "pipeline.stage": ctx["pipeline_stage"],
            "pipeline.type": ctx["pipeline_type"],
            "pipeline.role": ctx["pipeline_role"],
            "pipeline.dag_run_id": ctx["dag_run_id"],
            "pipeline.dag_id": ctx["dag_id"],
            "pipeline.started_at": ctx["started_at"] if started_at_text is None else started_at_text,
        }
    )


def whole_ms(start: Column | str, end: Column | str) -> Column:
    """Milliseconds between two timestamps, cut to whole ones (message durations)."""
    micros = F.unix_micros(col(end)) - F.unix_micros(col(start))
    return (micros / 1000).cast("bigint")


def exact_ms(start: Column | str, end: Column | str) -> Column:
    """Milliseconds between two timestamps with three decimals (step durations)."""
    micros = F.unix_micros(col(end)) - F.unix_micros(col(start))
    return F.round(micros / 1000.0, 3)


# Severity number and text by log level.
SEVERITY = {
    "DEBUG": (5, "DEBUG"),
    "INFO": (9, "INFO"),
    "WARNING": (13, "WARN"),
    "ERROR": (17, "ERROR"),
    "CRITICAL": (21, "FATAL"),
}

# Record fields of the logging library that are not attributes.
STANDARD_LOG_KEYS = (
    "name", "msg", "args", "levelname", "levelno", "pathname", "filename", "module",
    "exc_info", "exc_text", "stack_info", "lineno", "funcName", "created", "msecs",
    "relativeCreated", "thread", "threadName", "processName", "process", "message",
)


def severity(level: Column | str) -> Column:
    """Severity number and text of a level; unknown levels count as INFO."""
    table = F.create_map(
        *[
            x
            for name, (number, text) in SEVERITY.items()
            for x in (F.lit(name), F.struct(F.lit(number).alias("number"), F.lit(text).alias("text")))
        ]
    )
    info = F.struct(F.lit(9).alias("number"), F.lit("INFO").alias("text"))
    return F.coalesce(F.try_element_at(table, col(level)), info)


def log_record(
    ts: Column,
    level: Column,
    body: Column,
    service: Column,
    version: Column,
    code: dict[str, Column],
    extras: Column,
    error: dict[str, Column] | None = None,
    trace: Column | None = None,
) -> list[Column]:
    """The columns of one structured log record.

    Attributes are the code position, then the caller's extras without standard
    fields, then the exception; later entries override earlier ones.
    """
    own = F.map_filter(extras, lambda k, _: ~k.isin(*STANDARD_LOG_KEYS))
    empty = F.create_map().cast("map<string,string>")
    parts = [map_of(code), F.coalesce(own, empty)]
    if error is not None:
        parts.append(map_of({f"exception.{k}": v for k, v in error.items()}))
    sev = severity(level)
    text = F.lit(None).cast("string")
    return [
        ts.alias("timestamp"),
        ts.alias("observed_timestamp"),
        sev["number"].alias("severity_number"),
        sev["text"].alias("severity_text"),
        body.alias("body"),
        F.create_map(F.lit("service.name"), service, F.lit("service.version"), version).alias("resource"),
        F.map_concat(*parts).alias("attributes"),
        (trace["trace_id"] if trace is not None else text).alias("trace_id"),
        (trace["span_id"] if trace is not None else text).alias("span_id"),
        (trace["flags"] if trace is not None else text).alias("trace_flags"),
    ]
