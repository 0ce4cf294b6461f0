"""Checks of component settings: one row per component, ``config map<string,string>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.text import col, strip

# Settings each check asks for, in reporting order.
AZURE_FIELDS = ("srcConnectionString", "mapperConnectionString", "targetConnectionString")
AWS_FIELDS = {
    "AWS_ACCESS_KEY_ID": "AWS / MinIO access key ID",
    "AWS_SECRET_ACCESS_KEY": "AWS / MinIO secret access key",
    "AWS_REGION": "AWS region",
    "AWS_ENDPOINT_URL": "S3-compatible endpoint URL",
}
METADATA_FIELDS = ("orgName", "schemaType", "productType", "SERVICE_NAME", "SERVICE_VERSION")

# Fixed value: version layout; any decimal digits, one closing line feed at most.
VERSION = r"^v?\p{Nd}+\.\p{Nd}+\.\p{Nd}+\n?\z"

# Fixed value: what the lenient base64 reader accepts once foreign characters are
# gone: whole quads, or a padded last quad after which everything is ignored.
BASE64_LENIENT = r"^(?:=*[^=]=*[^=]=?[^=][^=])*(?:=*\z|=*[^=]=*[^=](?:==|=?[^=]=))"


def setting(name: str, config: Column | str = "config") -> Column:
    """A setting, empty when absent."""
    return F.coalesce(F.try_element_at(col(config), F.lit(name)), F.lit(""))


def is_base64(text: Column | str) -> Column:
    """True when the lenient base64 reader takes the text."""
    ascii_only = col(text).rlike(r"^[\x00-\x7f]*\z")
    kept = F.regexp_replace(col(text), "[^A-Za-z0-9+/=]", "")
    return ascii_only & kept.rlike(BASE64_LENIENT)


# Fixed value: the part of an accepted text that carries data.
BASE64_DATA = r"^((?:=*[^=]=*[^=]=?[^=][^=])*(?:=*[^=]=*[^=](?:=?[^=])?(?==))?)"


def decode_base64(text: Column | str) -> Column:
    """Decoded setting, null where the lenient reader would refuse it."""
    kept = F.regexp_replace(col(text), "[^A-Za-z0-9+/=]", "")
    data = F.replace(F.regexp_extract(kept, BASE64_DATA, 1), F.lit("="), F.lit(""))
    padded = F.concat(data, F.repeat(F.lit("="), F.pmod(-F.length(data), F.lit(4))))
    return F.when(is_base64(text), F.try_to_binary(padded, F.lit("base64")))


def _when(condition: Column, message: Column | str) -> Column:
    return F.when(condition, F.lit(message) if isinstance(message, str) else message)


def _collect(*checks: Column) -> Column:
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def _bad_entries(tag: str, servers: Column) -> Column:
    """One message per bootstrap entry without a port."""
    bad = F.filter(F.split(servers, ","), lambda s: F.instr(s, ":") == 0)
    return F.transform(
        bad,
        lambda s: F.concat(
            F.lit(f"[{tag}] invalid bootstrap entry '"), s, F.lit("' (expected host:port)")
        ),
    )


def _none() -> Column:
    return F.array().cast("array<string>")


def cloud_errors(provider_name: Column, fields: Sequence[str] = AZURE_FIELDS) -> Column:
    """Errors of the storage settings of one component."""
    kind = strip(F.lower(F.coalesce(provider_name, F.lit(""))))
    azure = []
    for f in fields:
        v = strip(setting(f))
        azure.append(
            F.when(v == "", F.lit(f"[azure] '{f}' is required but empty")).when(
                ~is_base64(v), F.lit(f"[azure] '{f}' is not valid base64")
            )
        )
    aws = [
        _when(strip(setting(f)) == "", f"[aws] '{f}' is required but empty ({text})")
        for f, text in AWS_FIELDS.items()
    ]
    other = F.concat(
        F.lit("Unknown cloudProviderType '"),
        F.coalesce(provider_name, F.lit("None")),
        F.lit("'. Expected 'azure' or 'aws'"),
    )
    return (
        F.when(kind == "azure", _collect(*azure))
        .when(kind == "aws", _collect(*aws))
        .otherwise(F.array(other))
    )


def kafka_errors() -> Column:
    """Errors of the broker settings; values are read without edge blanks."""
    servers = strip(setting("bootstrapServer"))
    first = F.when(
        servers == "", F.array(F.lit("[kafka] 'bootstrapServer' is required but empty"))
    ).otherwise(
        F.concat(
            _collect(
                _when(F.instr(servers, " ") > 0, "[kafka] 'bootstrapServer' must not contain spaces")
            ),
            _bad_entries("kafka", servers),
        )
    )
    topics = _collect(
        *[
            _when(strip(setting(t)) == "", f"[kafka] '{t}' is required but empty")
            for t in ("mapperTopicName", "targetTopicName")
        ]
    )
    return F.concat(first, topics)


def _bootstrap(tag: str, required: str) -> Column:
    """Bootstrap check of the topic components; an empty one is reported twice."""
    servers = setting("bootstrapServer")
    empty = F.lit(f"[{tag}] 'bootstrapServer' {required}")
    return F.when(servers == "", F.array(empty, empty)).otherwise(
        F.concat(
            _collect(
                _when(F.instr(servers, " ") > 0, f"[{tag}] 'bootstrapServer' must not contain spaces")
            ),
            _bad_entries(tag, servers),
        )
    )


def _edges(tag: str, name: str, text: str) -> Column:
    v = setting(name)
    return _when((v != "") & (strip(v) != v), f"[{tag}] '{name}' {text}")


def _inside(tag: str, name: str) -> Column:
    return _when(F.instr(setting(name), " ") > 0, f"[{tag}] '{name}' must not contain spaces")


def _missing(tag: str, name: str, text: str) -> Column:
    return _when(setting(name) == "", f"[{tag}] '{name}' {text}")


def producer_topic_errors(tag: str, required: str, optional: str) -> Column:
    """Errors of a producer topic component: metadata, broker and topics."""
    need, edge = "is required but empty", "must not have leading/trailing spaces"
    metadata = _collect(
        *[_missing(tag, f, need) for f in METADATA_FIELDS],
        *[_edges(tag, f, edge) for f in METADATA_FIELDS[:-1]],
        _when(
            (setting("SERVICE_VERSION") != "") & ~setting("SERVICE_VERSION").rlike(VERSION),
            f"[{tag}] 'SERVICE_VERSION' must follow format X.Y.Z",
        ),
    )
    topics = _collect(
        _missing(tag, required, need),
        _edges(tag, required, edge),
        _inside(tag, required),
        _edges(tag, optional, edge),
        _inside(tag, optional),
    )
    return F.concat(metadata, _bootstrap(tag, need), topics)


def adaptor_errors() -> Column:
    return producer_topic_errors("adaptor", "srcTopicName", "mapperTopicName")


def mapper_errors() -> Column:
    return producer_topic_errors("schema-mapper", "mapperTopicName", "targetTopicName")


def consumer_errors(kind: str) -> Column:
    """Errors of a consumer topic component, ``extractor`` or ``schema-mapper``.

    Order: empty required settings, then the broker's form, then the topics' form.
    """
    tag, need, edge = kind, "is required", "has leading/trailing spaces"
    source = "srcTopicName" if kind == "extractor" else "mapperTopicName"
    servers = setting("bootstrapServer")
    absent = f"[{tag}] 'bootstrapServer' {need}"
    form = F.when(servers == "", F.array(F.lit(absent))).otherwise(
        F.concat(
            _collect(
                _when(F.instr(servers, " ") > 0, f"[{tag}] 'bootstrapServer' must not contain spaces")
            ),
            _bad_entries(tag, servers),
        )
    )
    topics = [_edges(tag, source, edge), _inside(tag, source)]
    if kind == "extractor":
        topics += [_edges(tag, "mapperTopicName", edge), _inside(tag, "mapperTopicName")]
    return F.concat(
        _collect(_when(servers == "", absent), _missing(tag, source, need)), form, _collect(*topics)
    )


def validate_cloud(df: DataFrame, fields: Sequence[str] = AZURE_FIELDS) -> DataFrame:
    return once(df, errors=cloud_errors(F.try_element_at("config", F.lit("cloudProviderType")), fields))


def validate_kafka(df: DataFrame) -> DataFrame:
    return once(df, errors=kafka_errors())


def validate_adaptor(df: DataFrame) -> DataFrame:
    return once(df, errors=adaptor_errors())


def validate_mapper(df: DataFrame) -> DataFrame:
    return once(df, errors=mapper_errors())


def validate_consumer(df: DataFrame, kind: str) -> DataFrame:
    return once(df, errors=consumer_errors(kind))


def validate_by_kind(df: DataFrame) -> DataFrame:
    """Apply to each row the check its ``kind`` names."""
    provider_name = F.try_element_at("config", F.lit("cloudProviderType"))
    kind = F.col("kind")
    return once(
        df,
        errors=F.when(kind == "cloud", cloud_errors(provider_name))
        .when(kind == "kafka", kafka_errors())
        .when(kind == "adaptor", adaptor_errors())
        .when(kind == "mapper", mapper_errors())
        .when(kind == "consumer-extractor", consumer_errors("extractor"))
        .when(kind == "consumer-mapper", consumer_errors("schema-mapper"))
        .otherwise(_none()),
    )


def error_rows(validated: DataFrame, *keys: str) -> DataFrame:
    """One row per error with its place in the component's list."""
    return validated.select(
        *keys, F.posexplode("errors").alias("position", "error")
    )


def validation_report(validated: DataFrame, *keys: str) -> DataFrame:
    """Summary line, error count and error list of each component that failed."""
    kind = F.col("kind")
    shown = (
        F.when(kind == "mapper", "schema-mapper")
        .when(kind == "consumer-extractor", "extractor")
        .when(kind == "consumer-mapper", "schema-mapper")
        .otherwise(kind)
    )
    ending = F.when(
        kind.startswith("consumer"), " validation failed:"
    ).otherwise(" configuration validation failed")
    return validated.where(F.size("errors") > 0).select(
        *keys,
        F.concat(F.upper(shown), ending).alias("summary"),
        F.size("errors").alias("error_count"),
        F.array_join("errors", "\n").alias("error_list"),
    )
