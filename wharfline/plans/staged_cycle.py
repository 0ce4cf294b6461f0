"""A file cycle over real objects, in stages that commit what they did.

list -> copy to staging -> announce -> inspect and gate -> plan under the mapped name -> copy to the target -> verify -> announce -> report

Every stage writes its rows to a folder of its own below ``out`` and is done once Spark has committed that folder. A run
that was broken off is started again with the same ``out`` and goes on at the first stage that isn't done; what is done
is read, not repeated, so the cycle never sees its own copies as something new. A stage that was broken off in
the middle repeats: copies go by a plan that was fixed before any byte moved, and replace what is there whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.objects import error_record
from ..operators.copies import NOT_FOUND, REJECTED, UNSAFE, copy_plan, copy_plan_of_listing
from ..operators.screening import decode_events, has_path
from ..sources.objects import execute_copy, exists, inspect_objects, list_objects
from ..sources.topics import event_messages
from .file_flow import announce

STAGES = ("listed", "staged", "announced", "inspected", "planned", "landed", "verified", "published", "report")
#: The labels storage errors are reported under.
LABELS = {"aws": "AWS S3", "azure": "Azure"}


def _committed(spark: SparkSession, folder: str, make: Callable[[], DataFrame]) -> DataFrame:
    if not exists(spark, f"{folder}/_SUCCESS"):
        make().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def _copied(spark: SparkSession, folder: str, plan: DataFrame, src: str, dst: str, tasks: int | None) -> DataFrame:
    if exists(spark, f"{folder}/results/_SUCCESS"):
        return spark.read.parquet(f"{folder}/results")
    return execute_copy(plan, src, dst, folder, tasks)


def run_cycle(
    spark: SparkSession,
    source_root: str,
    staging_root: str,
    target_root: str,
    out: str,
    *,
    target_container: str,
    provider: str = "aws",
    dest: Column | None = None,
    rule: Column | None = None,
    tasks: int | None = None,
    stop_after: str | None = None,
) -> DataFrame | None:
    """One row for each object of the source: what became of it, its target hash, and the error if it failed.

    ``dest`` maps ``object_key`` to the target's name. ``rule`` decides over the columns of :func:`inspect_objects`
    (head, tail, length, content_hash) whether a staged object may pass. ``stop_after`` names a stage to end after,
    as a run that is cut off would; nothing is returned then.

    outcome is ``copied``, ``skipped`` (up to date in the staging area or the target), ``refused`` (unsafe name, rule not
    met) or ``failed`` (missing, unreadable, changed under way, or not copied), with an error record.
    """
    if stop_after is not None and stop_after not in STAGES:
        raise ValueError(f"no such stage: {stop_after}")
    at = {name: f"{out.rstrip('/')}/{k}-{name}" for k, name in enumerate(STAGES, 1)}
    vendor = provider.strip().lower()

    def last(name: str) -> bool:
        return stop_after == name

    listed = _committed(
        spark,
        at["listed"],
        lambda: copy_plan_of_listing(
            list_objects(spark, source_root, provider=provider),
            list_objects(spark, staging_root, provider=provider, may_be_absent=True),
            provider,
        ),
    )
    if last("listed"):
        return None
    staged = _copied(spark, at["staged"], listed, source_root, staging_root, tasks)
    if last("staged"):
        return None
    messages = _committed(spark, at["announced"], lambda: event_messages(announce(staged, staging_root, provider), "mapper-topic"))
    if last("announced"):
        return None

    named = has_path(decode_events(messages)).select(F.col("event.path").alias("object_key"))
    passes = F.lit(True) if rule is None else F.coalesce(rule, F.lit(False))

    def inspect() -> DataFrame:
        seen = inspect_objects(named, staging_root, tasks)
        return seen.select("object_key", "found", "modified", "length", "content_hash", passes.alias("valid"), "error_type", "error_message")

    inspected = _committed(spark, at["inspected"], inspect)
    if last("inspected"):
        return None

    def second_plan() -> DataFrame:
        stored = inspected.where("found")
        target = list_objects(spark, target_root, provider=provider, may_be_absent=True)
        return copy_plan(named, stored, target, dest, provider, F.col("valid"))

    planned = _committed(spark, at["planned"], second_plan)
    if last("planned"):
        return None
    landed = _copied(spark, at["landed"], planned, staging_root, target_root, tasks)
    if last("landed"):
        return None

    def verify() -> DataFrame:
        arrived = inspect_objects(landed.where("copied").select(F.col("dest_key").alias("object_key")), target_root, tasks)
        arrived = arrived.select(F.col("object_key").alias("dest_key"), F.col("content_hash").alias("target_hash"), F.col("error_message").alias("read_error"))
        read = inspected.select("object_key", "content_hash", F.col("error_type").alias("seen_type"), F.col("error_message").alias("seen_message"))
        met = landed.join(arrived, "dest_key", "left").join(read, "object_key", "left")
        same = F.col("copied") & F.col("target_hash").eqNullSafe(F.col("content_hash"))
        changed = F.col("copied") & ~same
        # the first cause that is known: reading, copying, or what arrived
        return met.select(
            "object_key", "dest_key", "requests", F.coalesce(same, F.lit(False)).alias("copied"), "skipped",
            F.when(changed, "failed").otherwise(F.col("reason")).alias("reason"),
            F.coalesce("error_type", "seen_type", F.when(changed, "OSError")).alias("error_type"),
            F.coalesce("error_message", "seen_message", F.when(changed, F.coalesce("read_error", F.lit("target differs from what was inspected")))).alias("error_message"),
            F.when(same, F.col("target_hash")).alias("target_hash"),
        )

    verified = _committed(spark, at["verified"], verify)
    if last("verified"):
        return None
    _committed(spark, at["published"], lambda: event_messages(announce(verified, target_container, provider), "target-topic"))
    if last("published"):
        return None
    return _committed(spark, at["report"], lambda: _report(staged, verified, vendor))


def _report(staged: DataFrame, verified: DataFrame, vendor: str) -> DataFrame:
    second = verified.select("object_key", *[F.col(c).alias(f"{c}_2") for c in ("dest_key", "copied", "skipped", "reason", "error_type", "error_message", "target_hash")])
    met = staged.join(second, "object_key", "left")
    on = F.col("copied_2").isNotNull()  # the second stage heard of it

    def latest(name: str) -> Column:
        return F.when(on, F.col(f"{name}_2")).otherwise(F.col(name))

    reason, kind, text = latest("reason"), latest("error_type"), latest("error_message")
    outcome = (
        F.when(on & F.col("copied_2"), "copied")
        .when(latest("skipped"), "skipped")
        .when(reason.isin(REJECTED, UNSAFE), "refused")
        .otherwise("failed")
    )
    told = met.select(
        "object_key",
        F.col("dest_key_2").alias("dest_key"),
        outcome.alias("outcome"),
        reason.alias("reason"),
        F.col("target_hash_2").alias("target_hash"),
        F.coalesce(kind, F.when(reason == NOT_FOUND.get(vendor, ""), "FileNotFoundError"), F.lit("Exception")).alias("kind"),
        F.coalesce(text, reason).alias("text"),
    )
    error = error_record(F.lit(LABELS.get(vendor, "")), F.col("kind"), F.col("text"))
    return told.select("object_key", "dest_key", "outcome", "reason", "target_hash", F.when(F.col("outcome") == "failed", error).alias("error"))
