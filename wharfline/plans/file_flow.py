"""File products: which objects move and which events announce them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.objects import file_ready, mapped_name
from ..operators.copies import copy_plan, copy_plan_of_listing
from ..operators.screening import decode_events, has_path, publishable
from ..sources.topics import event_messages


def announce(plan: DataFrame, container: str, provider: str) -> DataFrame:
    """Events of the objects that were really copied."""
    return publishable(plan).select(
        "object_key",
        "dest_key",
        file_ready(F.lit(container), F.col("dest_key"), F.lit(provider)).alias("event"),
    )


def first_stage(source: DataFrame, staging: DataFrame, container: str, provider: str) -> DataFrame:
    """Adaptor or extractor: messages for all new or changed objects of the source."""
    plan = copy_plan_of_listing(source, staging, provider)
    return event_messages(announce(plan, container, provider), "mapper-topic")


def second_stage(
    messages: DataFrame,
    stored: DataFrame,
    target: DataFrame,
    provider: str,
    dest: Column | None = None,
    rule: Column | None = None,
) -> DataFrame:
    """Schema mapper: the copy plan for the objects that messages name."""
    paths = has_path(decode_events(messages)).select(F.col("event.path").alias("object_key"))
    return copy_plan(paths, stored, target, dest, provider, rule)


def producer_name(schema: str, org: str) -> Column:
    """Destination of an object on the producer side."""
    return mapped_name(F.lit(schema), F.lit(org), F.col("object_key"))


def producer_flow(
    source: DataFrame,
    staging: DataFrame,
    target: DataFrame,
    *,
    schema: str,
    org: str,
    staging_container: str,
    target_container: str,
    provider: str,
    copied_at: Column,
    rule: Column | None = None,
) -> DataFrame:
    """Both producer stages: events of what reaches the target under its mapped name.

    ``copied_at`` is the time the first stage's copies carry in the staging area.
    """
    return _flow(
        source, staging, target, producer_name(schema, org), staging_container, target_container,
        provider, copied_at, rule,
    )


def consumer_flow(
    source: DataFrame,
    staging: DataFrame,
    target: DataFrame,
    *,
    staging_container: str,
    target_container: str,
    provider: str,
    copied_at: Column,
    rule: Column | None = None,
) -> DataFrame:
    """Both consumer stages; names are kept."""
    return _flow(
        source, staging, target, None, staging_container, target_container, provider, copied_at, rule
    )


def _flow(
    source: DataFrame,
    staging: DataFrame,
    target: DataFrame,
    dest: Column | None,
    staging_container: str,
    target_container: str,
    provider: str,
    copied_at: Column,
    rule: Column | None,
) -> DataFrame:
    messages = first_stage(source, staging, staging_container, provider)
    stored = source.withColumn("modified", copied_at)
    plan = second_stage(messages, stored, target, provider, dest, rule)
    return announce(plan, target_container, provider)
