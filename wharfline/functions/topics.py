"""Topic names and consumer-group ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, or_default, strip

UNKNOWN = "unknown"
TOPIC_PREFIX = "dpn"  # fixed value: first part of every target topic


def sanitize(value: Column | str, default: str = UNKNOWN) -> Column:
    """Keep letters and digits only, in lower case; the default where nothing is left."""
    kept = F.lower(F.regexp_replace(or_default(value, default), "[^A-Za-z0-9]", ""))
    return or_default(kept, default)


def resolve_topic(given: Column | str, source: Column | str, suffix: str) -> Column:
    """The given name without edge blanks, or ``<source>-<suffix>`` when there is none."""
    return or_default(strip(F.coalesce(col(given), F.lit(""))), F.concat(col(source), F.lit(f"-{suffix}")))


def target_topic(role: str, org: Column | str, schema: Column | str, product: Column | str) -> Column:
    """Target topic of a producer (constant per run) or consumer (per row)."""
    return F.concat_ws(
        "-", F.lit(f"{TOPIC_PREFIX}-{role}"), col(org), col(schema), col(product), F.lit("target")
    )


def control_group(product: Column | str, stage: Column | str) -> Column:
    return F.concat_ws("-", col(product), col(stage), F.lit("control"))


def sensor_group(run_id: Column | str, stage: Column | str) -> Column:
    """Group id of the reader that waits for one run's status."""
    safe = F.substring(F.replace(col(run_id), F.lit(":"), F.lit("-")), 1, 50)
    return F.concat_ws("-", F.lit("airflow-sensor"), safe, col(stage))
