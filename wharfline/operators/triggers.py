"""Run triggers and run statuses: matching, de-duplication, waiting, chaining."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.context import Identity, execution_mode
from ..functions.text import iso_utc
from .ordered import chunk_by_offset, following_value, previous_value

TRIGGER_FIELDS = (
    "stage", "pipeline_type", "pipeline_role", "product", "run_id", "dag_run_id",
    "dag_id", "execution_mode", "triggered_by", "timestamp",
)
STATUS_FIELDS = (
    "stage", "pipeline_type", "pipeline_role", "product", "run_id", "dag_run_id",
    "dag_id", "status", "error", "duration_ms", "timestamp",
)
BUSY = "Pipeline already running on this pod"  # fixed value: error text of the guard


def _message(df: DataFrame, fields: Sequence[str], overrides: dict[str, Column]) -> DataFrame:
    body = F.struct(*[overrides.get(f, F.col(f)).alias(f) for f in fields])
    return df.select(
        F.col("run_id").cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


def build_triggers(df: DataFrame, origin: str = "airflow") -> DataFrame:
    """Control messages keyed by run id."""
    mode = F.coalesce(F.col("execution_mode"), F.lit("automatic"))
    return _message(
        df,
        TRIGGER_FIELDS,
        {
            "execution_mode": mode,
            "triggered_by": F.lit(origin),
            "timestamp": iso_utc("timestamp"),
        },
    )


def build_statuses(df: DataFrame) -> DataFrame:
    """Status messages keyed by run id; durations with three decimals."""
    return _message(
        df,
        STATUS_FIELDS,
        {"duration_ms": F.round("duration_ms", 3), "timestamp": iso_utc("timestamp")},
    )


def end_offset(messages: DataFrame) -> DataFrame:
    """Offset the next message of partition 0 will get; 0 for an empty topic."""
    return messages.where(F.col("partition") == 0).agg(
        F.coalesce(F.max("offset") + 1, F.lit(0).cast("bigint")).alias("end_offset")
    )


def match_triggers(triggers: DataFrame, identity: Identity) -> DataFrame:
    """Triggers addressed to this runner; all others are passed over."""
    return triggers.where(
        F.col("stage").eqNullSafe(F.lit(identity.stage))
        & F.col("pipeline_type").eqNullSafe(F.lit(identity.type))
        & F.col("pipeline_role").eqNullSafe(F.lit(identity.role))
        & F.col("product").eqNullSafe(F.lit(identity.product))
    )


def first_trigger(triggers: DataFrame, keys: Sequence[str] = ("product", "stage")) -> DataFrame:
    """The first trigger of each runner in partition and offset order."""
    rest = [c for c in triggers.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("partition", "offset"))
    return triggers.groupBy(*keys).agg(first.alias("first")).select(*keys, "first.*")


def skip_manual(mode: Column | str = "execution_mode") -> Column:
    """True for runs that are left to a person."""
    return execution_mode(mode) == "manual"


NO_RUN_ID = "trigger without run id"


def trigger_dead_letters(triggers: DataFrame) -> DataFrame:
    """The triggers that no run can be decided for, with the reason; the rest is decided."""
    return triggers.where(F.col("run_id").isNull()).withColumn("reject_reason", F.lit(NO_RUN_ID))


def chunk_by_place(size: int = 1_000_000) -> Column:
    """Chunk number of a message that grows with partition, then offset (offsets below 2 ** 40 chunks)."""
    return F.col("partition").cast("bigint") * F.lit(1 << 40) + chunk_by_offset("offset", size)


def decide_triggers(
    triggers: DataFrame,
    keys: Sequence[str] = ("product", "stage"),
    order: Sequence[str] = ("partition", "offset"),
    chunk: Column | None = None,
    remember_failures: bool = True,
) -> DataFrame:
    """Add the normalised mode and the decision for each trigger, taken by partition, then offset.

    ``completed`` for the run that was executed last (a repeat, checked first),
    ``skipped`` for manual runs, else ``execute``. With ``remember_failures``
    off, runs flagged in the column ``run_failed`` are not remembered. Triggers
    without a run id are no runs: :func:`trigger_dead_letters` has them.
    """
    mode = execution_mode("execution_mode")
    runs = triggers.where(F.col("run_id").isNotNull()).withColumn("mode", mode)
    remembered = F.col("mode") != "manual"
    if not remember_failures:
        remembered = remembered & ~F.coalesce(F.col("run_failed"), F.lit(False))
    seen = previous_value(
        runs,
        keys,
        order,
        F.when(remembered, F.col("run_id")),
        "last_run_id",
        chunk_by_place() if chunk is None else chunk,
    )
    return seen.withColumn(
        "decision",
        F.when(F.col("run_id") == F.col("last_run_id"), "completed")
        .when(F.col("mode") == "manual", "skipped")
        .otherwise("execute"),
    )


def await_status(
    triggers: DataFrame,
    statuses: DataFrame,
    timeout_secs: int = 600,
    chunk_size: int = 1_000_000,
    keys: Sequence[str] = ("run_id", "stage", "product"),
    partition: int = 0,
) -> DataFrame:
    """The first status at or after each trigger's start offset.

    The start offset is one of the watched ``partition`` of the status topic, so only its statuses can answer;
    offsets of other partitions count something else.

    Both sides are laid on the offset axis of the status topic, then each trigger
    takes the next status of its key. No pair of rows is formed, so a run with
    very many triggers and statuses stays linear. ``triggers`` needs
    ``start_offset`` and ``timestamp``, ``statuses`` needs ``offset``, ``status``
    and ``timestamp``. A status later than the deadline is a timeout.
    """
    kept = [c for c in triggers.columns if c not in keys]
    asks = triggers.select(
        *keys,
        F.col("start_offset").alias("__pos"),
        F.lit(0).alias("__side"),
        F.struct(*kept).alias("__ask"),
    )
    reply = F.struct(
        F.col("offset").alias("status_offset"),
        F.col("status"),
        F.col("timestamp").alias("status_at"),
    )
    replies = statuses.where(F.col("partition") == partition).select(
        *keys, F.col("offset").alias("__pos"), F.lit(1).alias("__side"), reply.alias("__reply")
    )
    both = asks.unionByName(replies, allowMissingColumns=True)
    met = following_value(
        both,
        keys,
        ("__pos", "__side"),
        F.when(F.col("__side") == 1, F.col("__reply")),
        "__next",
        chunk_by_offset("__pos", chunk_size),
    ).where(F.col("__side") == 0)
    deadline = F.col("__ask.timestamp") + F.make_dt_interval(secs=F.lit(timeout_secs))
    in_time = F.col("__next").isNotNull() & (F.col("__next.status_at") <= deadline)
    return met.select(
        *keys,
        "__ask.*",
        F.when(in_time, F.col("__next")).alias("reply"),
    ).select(
        *keys,
        *kept,
        "reply.status_offset",
        "reply.status",
        "reply.status_at",
        F.when(F.col("reply").isNull(), "timeout")
        .when(F.col("reply.status") == "failed", "error")
        .otherwise("success")
        .alias("outcome"),
    )


def run_timeline(
    awaited: DataFrame, first_stage: str = "adaptor", second_stage: str = "schema_mapper"
) -> DataFrame:
    """One row per run: both stages' outcome and whether the chain was kept.

    Takes the result of :func:`await_status` for both stages; the first trigger
    of each stage counts. The chain holds when the second stage was triggered at
    or after the first one's success and succeeded itself.
    """

    def of(stage: str) -> Column:
        row = F.struct(
            F.col("timestamp").alias("at"), F.col("status_at").alias("done"), F.col("outcome").alias("outcome")
        )
        place = F.when(F.col("stage") == stage, F.struct("start_offset", "offset"))
        return F.min_by(row, place)

    both = awaited.groupBy("run_id", "product").agg(
        of(first_stage).alias("first"), of(second_stage).alias("second")
    )
    ok = (
        (F.col("first.outcome") == "success")
        & (F.col("second.outcome") == "success")
        & (F.col("second.at") >= F.col("first.done"))
    )
    return both.select(
        "run_id",
        "product",
        F.coalesce("first.outcome", F.lit("not triggered")).alias("first_outcome"),
        F.coalesce("second.outcome", F.lit("not triggered")).alias("second_outcome"),
        (F.unix_micros("first.done") - F.unix_micros("first.at")).alias("first_micros"),
        (F.unix_micros("second.done") - F.unix_micros("second.at")).alias("second_micros"),
        F.coalesce(ok, F.lit(False)).alias("chain_complete"),
    )


# --- in-flight guard ---------------------------------------------------------
#
# Whether a trigger meets a running one depends on which earlier ones were
# accepted. Each chunk of the order is reduced to the few ways it can hand on
# "busy until"; those are chained per runner, then every chunk is walked once.


def _exits(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Ways through one chunk: (latest start that takes this way, busy-until after it).

    Who enters with ``busy`` takes the first way whose start is not before it.
    """
    n = len(starts)
    leave = [0] * n
    ways: list[tuple[int, int]] = []
    for i in range(n - 1, -1, -1):
        following = bisect_left(starts, ends[i], i + 1)
        leave[i] = ends[i] if following == n else leave[following]
        if not ways or ways[-1][1] != leave[i]:
            ways.append((starts[i], leave[i]))
    return ways[::-1]


def overlap_flags(
    triggers: DataFrame,
    keys: Sequence[str] = ("product", "stage"),
    chunk_secs: int = 3600,
) -> DataFrame:
    """Add ``accepted``: false for a trigger that arrives while a run is going on.

    Needs ``start_us`` and ``end_us`` (when the run would begin and end) and
    ``offset``. Triggers are taken in order of start and offset.
    """
    keys = list(keys)
    rows = triggers.withColumn("__chunk", F.floor(F.col("start_us") / (chunk_secs * 1_000_000)))
    key_types = ", ".join(f"{k} {dict(triggers.dtypes)[k]}" for k in keys)

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start_us", "offset"])
        ways = _exits(pdf["start_us"].tolist(), pdf["end_us"].tolist())
        frame = pd.DataFrame(ways, columns=["last_start", "leaves"])
        for k in [*keys, "__chunk"]:
            frame.insert(len(frame.columns) - 2, k, pdf[k].iloc[0])
        return frame

    steps = rows.select(*keys, "__chunk", "start_us", "end_us", "offset").groupBy(*keys, "__chunk").applyInPandas(
        summarise, f"{key_types}, __chunk bigint, last_start bigint, leaves bigint"
    )

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        busy, out = None, []
        for chunk, part in pdf.sort_values(["__chunk", "last_start"]).groupby("__chunk", sort=True):
            out.append({**{k: pdf[k].iloc[0] for k in keys}, "__chunk": chunk, "busy": busy})
            for last_start, leaves in zip(part["last_start"], part["leaves"]):
                if busy is None or busy <= last_start:
                    busy = leaves
                    break
        frame = pd.DataFrame(out)
        frame["busy"] = frame["busy"].astype("Int64")
        return frame

    entries = steps.groupBy(*keys).applyInPandas(chain, f"{key_types}, __chunk bigint, busy bigint")
    right = entries.select(*[F.col(c).alias(f"__r{i}") for i, c in enumerate([*keys, "__chunk"])], "busy")
    on = [rows[c].eqNullSafe(right[f"__r{i}"]) for i, c in enumerate([*keys, "__chunk"])]
    joined = rows.join(right, on, "left").drop(*[f"__r{i}" for i in range(len(keys) + 1)])
    out_schema = joined.drop("busy").withColumn("accepted", F.lit(True)).schema

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start_us", "offset"])
        first = pdf["busy"].iloc[0]
        busy = None if pd.isna(first) else int(first)
        flags = []
        for start, end in zip(pdf["start_us"], pdf["end_us"]):
            ok = busy is None or start >= busy
            flags.append(ok)
            if ok:
                busy = end
        return pdf.drop(columns=["busy"]).assign(accepted=flags)

    walked = joined.groupBy(*keys, "__chunk").applyInPandas(walk, out_schema)
    return walked.drop("__chunk").withColumn("error", F.when(~F.col("accepted"), BUSY))
