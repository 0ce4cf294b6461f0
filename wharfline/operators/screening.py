"""Filters with quarantine: bad rows leave the flow with a reason, none ends it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import EVENT_SCHEMA, decode_document, decode_json, decode_problem, document_problem
from ..functions.headers import ROUTING, with_routing_fields
from ..functions.once import once
from ..functions.topics import UNKNOWN

REASON = "reject_reason"


def decode_events(messages: DataFrame, schema: str = EVENT_SCHEMA) -> DataFrame:
    """Add ``event`` and ``reject_reason`` (null for a usable event with a path)."""
    decoded = once(messages, event=decode_json("value", schema))
    return decoded.withColumn(REASON, decode_problem("value", F.col("event")))


def decode_documents(messages: DataFrame) -> DataFrame:
    """Add ``body``, a variant of any JSON object, and ``reject_reason``; no fields are asked for.

    Null, empty, blank and undecodable values, lists and bare values have a reason and a null body.
    """
    parsed = once(messages, __parsed=decode_document("value"))
    checked = once(parsed, **{REASON: document_problem("value", F.col("__parsed"))})
    body = F.when(F.col(REASON).isNull(), F.try_variant_get("__parsed", "$[0]", "variant"))
    return checked.withColumn("body", body).drop("__parsed")


def with_fields(decoded: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add columns read from the body: name to (path, type). What is absent or of no such type is null."""
    return decoded.select("*", *[F.try_variant_get("body", path, kind).alias(n) for n, (path, kind) in fields.items()])


def has_path(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNull())


def dead_letters(checked: DataFrame) -> DataFrame:
    """The rejected rows of any checked flow."""
    return checked.where(F.col(REASON).isNotNull())


def metadata_problem(fields: dict[str, Column]) -> Column:
    """Why a message cannot be routed: its headers lack a usable part."""
    missing = [F.when(c == UNKNOWN, F.lit(n)) for n, c in fields.items()]
    any_missing = reduce(Column.__or__, [c == UNKNOWN for c in fields.values()])
    return F.when(any_missing, F.concat(F.lit("unknown metadata: "), F.concat_ws(",", *missing)))


def check_metadata(messages: DataFrame) -> DataFrame:
    """Add the routing columns and ``reject_reason``."""
    reason = F.when(~F.col("headers_ok"), "header not utf-8").otherwise(
        metadata_problem({n: F.col(n) for n in ROUTING})
    )
    return with_routing_fields(messages).withColumn(REASON, reason).drop("headers_ok")


def valid_metadata(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull())


# --- schema gate -------------------------------------------------------------


def non_empty(content: Column | str) -> Column:
    c = F.col(content) if isinstance(content, str) else content
    return F.coalesce(F.octet_length(c) > 0, F.lit(False))


def parses_as_json(content: Column | str, schema: str) -> Column:
    """True when the whole content is one JSON document of the schema."""
    c = F.col(content) if isinstance(content, str) else content
    parsed = decode_json(c.cast("binary"), schema)
    return parsed.isNotNull() & parsed["_corrupt_record"].isNull()


def has_csv_columns(content: Column | str, required: list[str]) -> Column:
    """True when the first line names all the required columns."""
    c = F.col(content) if isinstance(content, str) else content
    head = F.split(F.regexp_replace(F.split(c.cast("string"), r"\r?\n", 2)[0], '"', ""), ",")
    names = F.transform(head, lambda x: F.trim(x))
    return F.size(F.array_except(F.array(*[F.lit(r) for r in required]), names)) == 0


def schema_gate(df: DataFrame, rule: Column | None = None) -> DataFrame:
    """Keep the rows whose content passes the rule; by default all pass."""
    return df.where(F.lit(True) if rule is None else F.coalesce(rule, F.lit(False)))


def publishable(results: DataFrame) -> DataFrame:
    """Only objects that were really copied are announced."""
    return results.where(F.col("copied"))
