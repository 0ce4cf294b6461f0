"""Incremental copy: what to move, decided before any byte moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.objects import is_safe_key
from ..functions.text import iso_utc

# Reasons a copy reports.
NOT_FOUND = {"azure": "source blob not found", "aws": "source object not found"}
UNSAFE = "unsafe object key"
UNSUPPORTED = "unsupported vendor"
REJECTED = "schema rule not met"


def copy_plan(
    requested: DataFrame,
    source: DataFrame,
    target: DataFrame,
    dest: Column | None = None,
    vendor: str = "aws",
    rule: Column | None = None,
) -> DataFrame:
    """Decide for each requested object whether it is copied, skipped or missing.

    Requests for the same object are counted first (``requests``), so a key that
    is asked for very often is one row when it meets the listings, which hold
    each key once. Of several requests that lead to one destination only the
    first object to need a copy is copied: after it the destination is newer.
    ``requested`` may bring an ``order_no`` column; else the key decides. A
    ``rule`` over the columns of ``source`` (its content, say) is evaluated where
    the source is read; what fails it is neither copied nor announced.
    """
    order = F.col("order_no") if "order_no" in requested.columns else F.lit(0).cast("bigint")
    renames = dest is not None
    asked = (
        requested.select("object_key", order.alias("order_no"))
        .groupBy("object_key")
        .agg(F.count(F.lit(1)).alias("requests"), F.min("order_no").alias("order_no"))
        .withColumn("dest_key", dest if renames else F.col("object_key"))
        .withColumn("safe", is_safe_key("object_key") & is_safe_key("dest_key"))
    )
    src = source.select(
        F.col("object_key"),
        F.col("modified").alias("src_modified"),
        F.col("length").alias("src_length"),
        (F.lit(True) if rule is None else F.coalesce(rule, F.lit(False))).alias("valid"),
    )
    tgt = target.select(F.col("object_key").alias("dest_key"), F.col("modified").alias("tgt_modified"))
    met = asked.join(src, "object_key", "left").join(tgt, "dest_key", "left")
    return _decide(met, renames, vendor)


def copy_plan_of_listing(source: DataFrame, target: DataFrame, vendor: str = "aws") -> DataFrame:
    """The plan that requests each listed object once under its own name.

    A listing holds every key once and brings its own times, so one join with
    the target listing is the only shuffle.
    """
    asked = source.select(
        "object_key",
        F.lit(1).cast("bigint").alias("requests"),
        F.lit(0).cast("bigint").alias("order_no"),
        F.col("object_key").alias("dest_key"),
        is_safe_key("object_key").alias("safe"),
        F.lit(True).alias("valid"),
        F.col("modified").alias("src_modified"),
        F.col("length").alias("src_length"),
    )
    tgt = target.select(F.col("object_key").alias("dest_key"), F.col("modified").alias("tgt_modified"))
    return _decide(asked.join(tgt, "dest_key", "left"), False, vendor)


def _decide(met: DataFrame, renames: bool, vendor: str) -> DataFrame:
    vendor = (vendor or "").strip().lower()
    supported = vendor in NOT_FOUND
    found = F.col("src_modified").isNotNull()
    needs = (
        F.lit(supported)
        & F.col("safe")
        & found
        & F.col("valid")
        & (F.col("tgt_modified").isNull() | (F.col("src_modified") > F.col("tgt_modified")))
    )
    planned = met.withColumn("needs", needs)
    if renames:
        first = (
            planned.where("needs")
            .groupBy("dest_key")
            .agg(F.min(F.struct("order_no", "object_key")).alias("winner"))
        )
        planned = planned.join(first, "dest_key", "left").withColumn(
            "copied",
            F.col("needs") & (F.col("winner") == F.struct("order_no", "object_key")),
        )
    else:
        planned = planned.withColumn("copied", F.col("needs"))
    skipped = F.lit(supported) & F.col("safe") & found & F.col("valid") & ~F.col("copied")
    times = F.concat(
        F.lit("target up-to-date (src="), iso_utc("src_modified"),
        F.lit(", tgt="), iso_utc("tgt_modified"), F.lit(")"),
    )
    reason = (
        F.when(~F.col("safe"), UNSAFE)
        .when(F.lit(not supported), UNSUPPORTED)
        .when(~found, NOT_FOUND.get(vendor, ""))
        .when(~F.col("valid"), REJECTED)
        .when(F.col("copied") & F.col("tgt_modified").isNull(), "created")
        .when(F.col("copied"), "overwritten")
        .when(F.col("needs"), "target up-to-date (written earlier in this run)")
        .otherwise(times)
    )
    return planned.select(
        "object_key",
        "dest_key",
        "requests",
        "order_no",
        "src_modified",
        "tgt_modified",
        "src_length",
        "copied",
        skipped.alias("skipped"),
        reason.alias("reason"),
    )


def needs_copy(plan: DataFrame) -> DataFrame:
    """Delta listing: only what has to be moved."""
    return plan.where(F.col("copied"))


def succeeded(plan: DataFrame) -> Column:
    """A result counts as good when it was copied or skipped."""
    return F.col("copied") | F.col("skipped")


def cycle_summary(plan: DataFrame, *keys: str) -> DataFrame:
    """Totals of one cycle over all requests.

    A repeated request of a copied object is a skip. What is neither failed.
    ``reference_skipped`` keeps the looser count in which a missing object is a
    skip too, because only refused keys raise an error.
    """
    copied = F.col("copied").cast("bigint")
    repeats = F.when(F.col("copied"), F.col("requests") - 1).when(F.col("skipped"), F.col("requests"))
    missing = F.when(
        ~F.col("copied") & ~F.col("skipped") & (F.col("reason") != UNSAFE), F.col("requests")
    )
    zero = F.lit(0).cast("bigint")
    totals = plan.groupBy(*keys).agg(
        F.coalesce(F.sum("requests"), zero).alias("total"),
        F.coalesce(F.sum(copied), zero).alias("copied"),
        F.coalesce(F.sum(repeats), zero).alias("skipped"),
        F.coalesce(F.sum(missing), zero).alias("missing"),
    )
    return totals.select(
        *keys,
        "total",
        "copied",
        "skipped",
        (F.col("total") - F.col("copied") - F.col("skipped")).alias("failed"),
        (F.col("skipped") + F.col("missing")).alias("reference_skipped"),
    )


def attach_content(events: DataFrame, objects: DataFrame, rule: Column | None = None) -> DataFrame:
    """Meet events with the objects they name; objects must hold each key once.

    The rule is evaluated beside the content, so only its verdict and the length
    travel through the join. Rows without an object keep ``found = false``.
    ``events`` needs ``path``, ``objects`` needs ``object_key`` and ``content``.
    """
    verdicts = objects.select(
        F.col("object_key").alias("path"),
        F.octet_length("content").cast("bigint").alias("length"),
        (F.lit(True) if rule is None else F.coalesce(rule, F.lit(False))).alias("valid"),
    )
    return events.join(verdicts, "path", "left").withColumn("found", F.col("valid").isNotNull())
