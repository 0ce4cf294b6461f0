"""Names of stored objects and of the providers that hold them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

# Fixed value: letters, digits, '_', '.', '-' and '/', and one closing line feed at most.
SAFE_KEY = r"^[\p{L}\p{N}_.\-/]+\n?\z"


def is_safe_key(key: Column | str) -> Column:
    """True for a key that may be copied; false for null, empty or unsafe ones."""
    return F.coalesce(col(key).rlike(SAFE_KEY), F.lit(False))


def mapped_name(schema: Column | str, org: Column | str, name: Column | str) -> Column:
    """Destination name on the producer side: ``schema-org-file`` in lower case."""
    return F.concat_ws(
        "-",
        F.lower(col(schema)),
        F.lower(col(org)),
        F.lower(F.translate(col(name), " -", "__")),
    )


def provider(name: Column | str) -> Column:
    """``azure``, ``aws`` or ``unsupported``."""
    clean = strip(F.lower(F.coalesce(col(name), F.lit(""))))
    return F.when(clean.isin("azure", "aws"), clean).otherwise("unsupported")


def source_type(name: Column | str) -> Column:
    """Storage label used in events: ``S3`` for AWS, else the provider in upper case."""
    upper = F.upper(col(name))
    return F.when(upper == "AWS", "S3").otherwise(upper)


def file_ready(container: Column | str, path: Column | str, provider_name: Column | str) -> Column:
    """The event that announces one copied object."""
    return F.struct(
        source_type(provider_name).alias("sourceType"),
        col(container).alias("storageContainer"),
        col(path).alias("path"),
    )


# Error classes of the storage clients and the label they report under.
PROVIDER_OF_ERROR = {
    "HttpResponseError": "Azure",
    "AzureError": "Azure",
    "ClientError": "AWS S3",
    "BotoCoreError": "AWS S3",
    "GoogleAPIError": "GCP",
}


def provider_label(error_type: Column | str) -> Column:
    """Provider label of an error class, empty for all others."""
    table = F.create_map(*[F.lit(x) for pair in PROVIDER_OF_ERROR.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col(error_type)), F.lit(""))


def error_record(provider_name: Column | str, error_type: Column | str, message: Column | str) -> Column:
    """Error entry; an empty or missing provider becomes ``Unknown``."""
    label = col(provider_name)
    return F.struct(
        F.when(label.isNull() | (label == ""), "Unknown").otherwise(strip(label)).alias("provider"),
        col(error_type).alias("type"),
        col(message).alias("message"),
    )
