"""JSON form of events and control messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

EVENT_SCHEMA = "sourceType string, storageContainer string, path string"
CORRUPT = "_corrupt_record"


def decode_json(value: Column | str, schema: str = EVENT_SCHEMA) -> Column:
    """Struct of a binary JSON value plus the raw text where it could not be read."""
    text = F.try_validate_utf8(col(value).cast("string"))
    return F.from_json(
        text,
        f"{schema}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def decode_problem(value: Column | str, event: Column) -> Column:
    """Why a message has no event: null when it decoded well."""
    raw = col(value)
    return (
        F.when(raw.isNull(), "null value")
        .when(~F.is_valid_utf8(raw.cast("string")), "not utf-8")
        .when(event.isNull() | event[CORRUPT].isNotNull(), "malformed json")
        .when(event["path"].isNull() | (event["path"] == ""), "missing path")
    )


def decode_document(value: Column | str) -> Column:
    """Variant of any JSON document, whatever its fields, as a list of the document and the digest of its text.

    The parser stops behind the first value it reads, so ``{} x`` would pass. A text that doesn't end where its value
    ends loses the digest, or holds another. Objects that name a field twice don't parse.
    """
    text = F.try_validate_utf8(col(value).cast("string"))
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text), F.lit('"]')))


def document_problem(value: Column | str, parsed: Column) -> Column:
    """Why a message holds no JSON object: null when it does."""
    raw = col(value)
    whole = F.try_variant_get(parsed, "$[1]", "string") == F.md5(raw)
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant"))
    return (
        F.when(raw.isNull(), "null value")
        .when(~F.is_valid_utf8(raw.cast("string")), "not utf-8")
        .when(~F.coalesce(whole, F.lit(False)), "malformed json")
        .when(~F.coalesce(kind.startswith("OBJECT<"), F.lit(False)), "not an object")
    )


def encode_event(event: Column) -> Column:
    """JSON bytes of an event struct."""
    return F.to_json(event).cast("binary")
