"""Message headers: ``array<struct<key:string, value:binary>>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .once import once
from .text import col
from .topics import sanitize

HEADERS_TYPE = "array<struct<key:string,value:binary>>"

# Accepted spellings, in order of preference, and the stamped name.
SCHEMA_KEYS = ("schema_type", "schematype")
ORG_KEYS = ("org_name", "orgname")
PRODUCT_KEYS = ("product_type", "producttype")


def _list(headers: Column | str) -> Column:
    return F.coalesce(col(headers), F.array().cast(HEADERS_TYPE))


def headers_decodable(headers: Column | str) -> Column:
    """False when any header value is not valid UTF-8."""
    return F.forall(
        _list(headers),
        lambda h: h["value"].isNull() | F.is_valid_utf8(h["value"].cast("string")),
    )


def _last(entries: Column) -> Column:
    return F.try_element_at(entries, F.lit(-1))


def raw_header(headers: Column | str, key: str) -> Column:
    """Last value stored under exactly this key."""
    hits = F.filter(_list(headers), lambda h: h["key"] == key)
    return F.try_validate_utf8(_last(hits)["value"].cast("string"))


def folded_headers(headers: Column | str) -> Column:
    """Headers as (lower-cased name, text), one entry per spelling of the key.

    A spelling keeps the place of its first appearance and its last value, so
    the last entry of a name is the one that decides.
    """
    found = _list(headers)
    spellings = F.array_distinct(F.transform(found, lambda h: h["key"]))
    return F.transform(
        spellings,
        lambda k: F.struct(
            F.lower(k).alias("name"),
            F.try_validate_utf8(
                _last(F.filter(found, lambda h: h["key"] == k))["value"].cast("string")
            ).alias("text"),
        ),
    )


def folded_value(folded: Column | str, *names: str) -> Column:
    """The first non-empty text among several names."""
    entries = col(folded)
    texts = F.transform(
        F.array(*[F.lit(n) for n in names]),
        lambda n: _last(F.filter(entries, lambda e: e["name"] == n))["text"],
    )
    return F.try_element_at(F.filter(texts, lambda v: v.isNotNull() & (v != "")), F.lit(1))


def header(headers: Column | str, *names: str) -> Column:
    """Header text by lower-cased name; the first non-empty of several names.

    Among spellings that differ only by case the one whose first appearance is
    latest decides, and of that spelling the last value. Where several names are
    looked up, keep :func:`folded_headers` in a column instead.
    """
    return folded_value(folded_headers(headers), *names)


def header_exact(headers: Column | str, *names: str) -> Column:
    """As :func:`header` but case matters, as the strict stamping rule asks for."""
    return F.coalesce(*[F.nullif(raw_header(headers, n), F.lit("")) for n in names])


ROUTING = {"schema_type": SCHEMA_KEYS, "org_name": ORG_KEYS, "product_type": PRODUCT_KEYS}


def with_routing_fields(messages: DataFrame) -> DataFrame:
    """Add the sanitised schema, organisation and product of each message.

    ``headers_ok`` tells whether all header values are text.
    """
    looked_up = messages.withColumn("__folded", folded_headers("headers")).withColumns(
        {n: folded_value("__folded", *keys) for n, keys in ROUTING.items()}
    )
    fields = {n: sanitize(n) for n in ROUTING}
    return once(looked_up.drop("__folded"), headers_ok=headers_decodable("headers"), **fields)


def strict_fields(headers: Column | str) -> dict[str, Column]:
    """Stamped values by exact spelling: snake, lower or camel case only."""
    camel = {"schema_type": "schemaType", "org_name": "orgName", "product_type": "productType"}
    return {n: sanitize(header_exact(headers, *keys, camel[n])) for n, keys in ROUTING.items()}


def header_entry(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").cast("binary").alias("value"))


def enriched_headers(
    schema: Column, org: Column, product: Column, processed_at: Column, offset: Column | str
) -> Column:
    """The header list of a routed message; it replaces all inbound headers."""
    return F.array(
        header_entry("schemaType", schema),
        header_entry("orgName", org),
        header_entry("productType", product),
        header_entry("processedAt", processed_at),
        header_entry("offset", col(offset)),
    )


def append_headers(headers: Column | str, *entries: Column) -> Column:
    """Inbound headers followed by new ones."""
    return F.concat(_list(headers), F.array(*entries))


# Fixed value: layout of the W3C trace header (version, trace, parent span, flags).
TRACEPARENT = r"^(?!ff)[0-9a-f]{2}-(?!0{32})[0-9a-f]{32}-(?!0{16})[0-9a-f]{16}-[0-9a-f]{2}$"


def with_trace(messages: DataFrame, *, new_root: bool, run: str | None = None) -> DataFrame:
    """Add the ``trace`` of the step that handles each message.

    Ids are hashes of the message position, so a replay repeats them. A new
    root starts one trace per message; with ``run`` all messages of that run
    share a trace; otherwise a well-formed inbound trace goes on.
    """
    position = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    inbound = F.lit(None).cast("string") if new_root else raw_header("headers", "traceparent")
    staged = messages.withColumn("__digest", F.sha2(position, 256)).withColumn("__inbound", inbound)
    parts = F.when(F.col("__inbound").rlike(TRACEPARENT), F.split("__inbound", "-"))
    digest, parent = F.col("__digest"), F.col("__parent")
    fresh = F.substring(digest, 1, 32) if run is None else F.substring(F.sha2(F.lit(run), 256), 1, 32)
    return (
        staged.withColumn("__parent", parts)
        .withColumn(
            "trace",
            F.struct(
                F.coalesce(parent[1], fresh).alias("trace_id"),
                parent[2].alias("parent_id"),
                F.substring(digest, 33, 16).alias("span_id"),
                F.coalesce(parent[3], F.lit("01")).alias("flags"),
            ),
        )
        .drop("__digest", "__inbound", "__parent")
    )


def traceparent_entry(trace: Column) -> Column:
    """Header entry that carries a trace to the next stage."""
    return header_entry(
        "traceparent",
        F.concat_ws("-", F.lit("00"), trace["trace_id"], trace["span_id"], trace["flags"]),
    )
