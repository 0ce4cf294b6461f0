"""Keyed stream operators with state: trigger runner, heartbeat watch. Controlled runs and status waits are in ``controlled``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.context import execution_mode
from ..operators.triggers import BUSY
from ..session import ROCKSDB


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed processors need; state may be larger than memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


DECISIONS = (
    "product string, stage string, partition int, offset bigint, run_id string, mode string, "
    "decision string, error string"
)


#: Rows of a key that are in pandas at a time; all others of the micro-batch wait as Arrow columns.
SLICE = 20_000
FEW = pa.dictionary(pa.int32(), pa.large_string())  # few values, often repeated
TRIGGERS = pa.schema(
    [
        ("partition", pa.int32()), ("offset", pa.int64()), ("run_id", pa.large_string()), ("mode", FEW), ("start_us", pa.int64()), ("duration_us", pa.int64()),
    ]
)


def arrow_of(frame: pd.DataFrame, schema: pa.Schema) -> pa.Table:
    plain = pa.schema([(f.name, pa.large_string() if f.type == FEW else f.type) for f in schema])
    table = pa.Table.from_pandas(frame[schema.names], plain, preserve_index=False)
    return pa.Table.from_arrays([c.dictionary_encode() if f.type == FEW else c for c, f in zip(table.columns, schema)], schema=schema)


class Packed:
    """Rows of a key as Arrow columns, and their order by partition and offset; rows without come last, equal ones stay as they came."""

    def __init__(self, tables: Iterator[pa.Table], schema: pa.Schema) -> None:
        chunks: list[list[pa.Array]] = [[] for _ in schema]
        for table in tables:
            for held, column in zip(chunks, table.columns):
                held.extend(column.chunks)
        columns = []
        for k, field in enumerate(schema):  # one column after the other, so none but it is there twice
            if chunks[k]:
                columns.append(pa.chunked_array(chunks[k], field.type).unify_dictionaries().combine_chunks())
            else:
                none = pa.array([], pa.large_string() if field.type == FEW else field.type)
                columns.append(none.dictionary_encode() if field.type == FEW else none)
            chunks[k] = []
        self.rows = pa.Table.from_arrays(columns, schema=schema)
        order = [("partition", "ascending"), ("offset", "ascending")]
        self.order = pc.sort_indices(self.rows, order).cast(pa.int32() if self.rows.num_rows < 2**31 else pa.int64())

    def taken(self, which: pa.Array) -> pd.DataFrame:
        some = self.rows.take(which).to_pandas(integer_object_nulls=True)
        few = {c: some[c].astype(object) for c in some.columns if isinstance(some[c].dtype, pd.CategoricalDtype)}
        return some.assign(**{c: x.where(x.notna(), None) for c, x in few.items()})

    def slices(self) -> Iterator[pd.DataFrame]:
        for start in range(0, len(self.order), SLICE):
            yield self.taken(self.order.slice(start, SLICE))


class TriggerRunner(StatefulProcessor):
    """State per (product, stage): the run executed last and until when the runner is busy."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("runner", "last_run_id string, busy_until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, busy = self._state.get() if self._state.exists() else (None, None)
        for batch in Packed((arrow_of(r, TRIGGERS) for r in rows), TRIGGERS).slices():
            decisions, errors = [], []
            for run, mode, start, took in zip(
                batch["run_id"], batch["mode"], batch["start_us"], batch["duration_us"]
            ):
                error = None
                if busy is not None and start < busy:
                    decision, error = "failed", BUSY
                elif run == last:
                    decision = "completed"
                elif mode == "manual":
                    decision = "skipped"
                else:
                    decision, last, busy = "execute", run, int(start + took)
                decisions.append(decision)
                errors.append(error)
            yield pd.DataFrame(
                {
                    "product": key[0],
                    "stage": key[1],
                    "partition": batch["partition"].astype("int32"),
                    "offset": batch["offset"],
                    "run_id": batch["run_id"],
                    "mode": batch["mode"],
                    "decision": decisions,
                    "error": errors,
                }
            )
        if busy is not None:
            self._state.update((last, busy))

    def close(self) -> None:
        pass


def trigger_processor(triggers: DataFrame) -> DataFrame:
    """Decide triggers as they come: guard, repeat, manual, execute.

    Filter to the runner's own triggers first. Rows of one key are sorted within
    a micro-batch; the size of that is set by the source's rate limit. Needs
    ``start_us`` and ``duration_us`` beside the trigger fields.
    """
    return (
        triggers.where(F.col("run_id").isNotNull())
        .select(
            "product",
            "stage",
            "partition",
            "offset",
            "run_id",
            execution_mode("execution_mode").alias("mode"),
            "start_us",
            "duration_us",
        )
        .groupBy("product", "stage")
        .transformWithStateInPandas(TriggerRunner(), DECISIONS, "Append", "None")
    )


ALARMS = "component string, last_seen_us bigint, alarm_us bigint"


class HeartbeatWatch(StatefulProcessor):
    """Raises an alarm per component once no beat came for the allowed time."""

    def __init__(self, allowed_us: int) -> None:
        self._allowed = allowed_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "seen_us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self._last.get()[0] if self._last.exists() else None
        beats = pd.concat(rows)["ts_us"].sort_values()
        gaps = []
        for seen in beats:
            seen = int(seen)
            if last is not None and seen - last > self._allowed:
                gaps.append(last)
            last = seen if last is None else max(last, seen)
        self._last.update((last,))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        self._handle.registerTimer((last + self._allowed) // 1000 + 1)
        if gaps:
            yield self._alarms(key, gaps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self._last.get()[0]
        self._last.clear()
        yield self._alarms(key, [last])

    def _alarms(self, key, gaps: list[int]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "component": [key[0]] * len(gaps),
                "last_seen_us": gaps,
                "alarm_us": [g + self._allowed for g in gaps],
            }
        )

    def close(self) -> None:
        pass


def missed_heartbeats_stream(
    beats: DataFrame, interval: int = 300, tolerance: int = 0, lateness: str = "10 seconds"
) -> DataFrame:
    """Alarms for silent components, by event time."""
    return (
        beats.select("component", "ts")
        .withWatermark("ts", lateness)
        .withColumn("ts_us", F.unix_micros("ts"))
        .groupBy("component")
        .transformWithStateInPandas(
            HeartbeatWatch((interval + tolerance) * 1_000_000), ALARMS, "Append", "EventTime"
        )
    )
