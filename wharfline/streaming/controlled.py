"""Controlled runs and status waits as streams: one state operator each, one answer for each trigger.

Two streams are laid on one: triggers beside results, or asks beside statuses. Both sides carry a watermark of their own and the slower one
counts, so a side that lags behind is waited for. State holds what is still open and no more; within a micro-batch all rows of a
key are handled by sorting and searching, not one by one. Runs are settled some at a time, the rows behind them wait as Arrow columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.context import execution_mode
from .stateful import FEW, Packed, arrow_of

#: The error of a run that gave no result in time.
NO_RESULT = "no result in time"

ANSWERS = (
    "product string, stage string, kind string, partition int, offset bigint, run_id string, mode string, decision string, "
    "status string, error string, duration_ms double, at timestamp"
)
_OPEN = "partition int, offset bigint, run_id string, mode string, at_us bigint, decision string, limit_us bigint"
_RESULT = "partition int, offset bigint, run_status string, run_error string, duration_us bigint, at_us bigint"

_KEY = ["partition", "offset"]


def _arrow(schema: str, few: tuple[str, ...] = ()) -> pa.Schema:
    kinds = {"string": pa.large_string(), "int": pa.int32(), "bigint": pa.int64()}
    named = [c.strip().split(" ") for c in schema.split(",")]
    return pa.schema([(n, FEW if n in few else kinds[kind]) for n, kind in named])


_TRIGGER = _arrow(", ".join(_OPEN.split(", ")[:5]), ("mode",))
_ENDED = _arrow(_RESULT, ("run_status", "run_error"))


class _Results:
    """A key's results, found by partition and offset; of several for one trigger the first counts."""

    def __init__(self, tables: Iterator[pa.Table]) -> None:
        self._held = Packed(tables, _ENDED)
        keys = self._held.rows.select(_KEY)
        last = (2**31 - 1, 2**63 - 1)  # rows without come last, as they are sorted
        self._p, self._o = (keys.column(c).fill_null(x).take(self._held.order).to_numpy() for c, x in zip(_KEY, last))
        self.free = np.ones(len(self._p), bool)
        self.free[1:] = (self._p[1:] != self._p[:-1]) | (self._o[1:] != self._o[:-1])

    def of(self, triggers: pd.DataFrame) -> pd.DataFrame:
        """Unused results of these triggers, with their places."""
        places = [np.zeros(0, np.int64)]
        asked = triggers[_KEY].isna().any(axis=1)
        known = triggers.loc[~asked, _KEY].astype("int64")
        for partition, offsets in known.groupby("partition")["offset"]:
            a, b = np.searchsorted(self._p, partition, "left"), np.searchsorted(self._p, partition, "right")
            at = a + np.searchsorted(self._o[a:b], np.unique(offsets.to_numpy()), "left")
            places.append(at[at < b])
        place = np.unique(np.concatenate(places))
        place = place[self.free[place]]
        return self._held.taken(self._held.order.take(pa.array(place))).assign(place=place)

    def left(self) -> pd.DataFrame:
        return self._held.taken(self._held.order.filter(pa.array(self.free)))


def _columns(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(",")]


def _held(state, schema: str) -> pd.DataFrame:
    rows = list(state.get()) if state.exists() else []
    return pd.DataFrame(rows, columns=_columns(schema)).astype(object)


def _hold(state, rows: pd.DataFrame, schema: str) -> None:
    if rows.empty:
        state.clear()
        return
    kinds = [c.strip().split(" ") for c in schema.split(",")]
    # numbers beside nulls are floats in pandas; state wants what its schema says
    held = [[None if pd.isna(x) else str(x) if kind == "string" else int(x) for x in rows[name]] for name, kind in kinds]
    state.put(list(zip(*held)))


def _times(handle: StatefulProcessorHandle, due: list[int]) -> None:
    """One timer, for what is due first; due in microseconds."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    if due:
        handle.registerTimer(min(due) // 1000 + 1)


class ControlledRunner(StatefulProcessor):
    """State per (product, stage): the run remembered last, triggers without an answer, results without a trigger."""

    def __init__(self, timeout_us: int, remember_failures: bool) -> None:
        self._timeout, self._remember = timeout_us, remember_failures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "run_id string")
        self._open = handle.getListState("open", _OPEN)
        self._early = handle.getListState("early", _RESULT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked: list[pa.Table] = []

        def ended() -> Iterator[pa.Table]:
            yield arrow_of(_held(self._early, _RESULT), _ENDED)
            for r in rows:
                new = r["kind"] == "trigger"
                asked.append(arrow_of(r[new], _TRIGGER))
                yield arrow_of(r[~new], _ENDED)

        results = _Results(ended())
        triggers = Packed((asked.pop(0) for _ in range(len(asked))), _TRIGGER)
        held = _held(self._open, _OPEN)
        new = (part.assign(decision=None, limit_us=None) for part in triggers.slices())
        waiting, opened = held.iloc[:0], []
        for part in itertools.chain([held] if len(held) else [], new):
            if len(waiting):  # the run at hand waits for its result, so nothing behind it can be decided
                opened.append(part)
                continue
            known = results.of(part)
            out, left, unused = self._settle(key, part, known, None)
            yield from out
            results.free[known["place"]] = False
            results.free[unused["place"].astype("int64")] = True
            if self._remember:
                opened.append(left)
            else:
                waiting = left
        opened = [f[_columns(_OPEN)].astype(object) for f in (waiting, *opened) if len(f)]
        self._keep(pd.concat(opened) if opened else held.iloc[:0], results.left())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        out, waiting, known = self._settle(key, _held(self._open, _OPEN), _held(self._early, _RESULT), now)
        yield from out
        self._keep(waiting, known)

    def _keep(self, waiting: pd.DataFrame, known: pd.DataFrame) -> None:
        _hold(self._open, waiting, _OPEN)
        _hold(self._early, known, _RESULT)
        _times(self._handle, [int(x) for x in waiting["limit_us"].dropna()])

    def _settle(self, key, waiting: pd.DataFrame, known: pd.DataFrame, now: int | None) -> tuple[list[pd.DataFrame], pd.DataFrame, pd.DataFrame]:
        """Decide what can be decided, answer what has its answer; the answers, and what is left of triggers and results.

        A result whose trigger was answered without a run goes too.
        """
        out: list[pd.DataFrame] = []
        while len(waiting):
            met = waiting.merge(known.rename(columns={"at_us": "done_us"}), on=["partition", "offset"], how="left")
            undecided = met["decision"].isna()
            if undecided.any():
                met = self._decide(met, undecided)
                told = met[undecided & met["decision"].notna()]
                out.append(self._rows(key, told, "decision"))
            ran = (met["decision"] == "execute").astype(bool)
            late = ran & met["run_status"].isna() & (met["limit_us"].astype("float64") < (now if now is not None else -1))
            met.loc[late, ["run_status", "run_error"]] = ["timeout", NO_RESULT]
            met.loc[late, "duration_us"] = self._timeout
            done = met["decision"].notna() & (~ran | met["run_status"].notna())
            out.append(self._rows(key, met[done], "status"))
            self._remembered(met, done)
            progress = bool(done.any())
            answered = met.loc[done, _KEY].drop_duplicates()
            if len(answered):
                left = known.merge(answered, on=["partition", "offset"], how="left", indicator=True)
                known = left[left["_merge"] == "left_only"].drop(columns="_merge")
            waiting = met.loc[~done, _columns(_OPEN)].reset_index(drop=True)
            if not progress or not waiting["decision"].isna().any():
                break
        return [rows for rows in out if len(rows)], waiting, known

    def _carried(self) -> str | None:
        return self._last.get()[0] if self._last.exists() else None

    def _decide(self, met: pd.DataFrame, undecided: pd.Series) -> pd.DataFrame:
        """The run before decides. Where failures are forgotten, what follows a run without a result waits for it."""
        met = met.copy()
        if not self._remember and (~undecided).any():
            return met  # the run at hand has no result yet
        own = met[undecided]
        if not self._remember:
            failed = own["run_status"] == "failed"
        else:
            failed = pd.Series(False, index=own.index)
        runs = own["run_id"].where((own["mode"] != "manual") & ~failed)
        before = pd.concat([pd.Series([self._carried()], dtype=object), runs.astype(object)]).ffill().iloc[:-1].to_numpy()
        decision = np.where(own["run_id"].to_numpy() == before, "completed", np.where(own["mode"] == "manual", "skipped", "execute"))
        upto = len(own)
        if not self._remember:
            stuck = np.flatnonzero((decision == "execute") & own["run_status"].isna().to_numpy())
            upto = int(stuck[0]) + 1 if len(stuck) else upto
        some = own.index[:upto]
        met.loc[some, "decision"] = decision[:upto]
        met.loc[some, "limit_us"] = own["at_us"].to_numpy()[:upto] + self._timeout
        if self._remember:
            kept = runs.dropna()
            if len(kept):
                self._last.update((kept.iloc[-1],))
        return met

    def _remembered(self, met: pd.DataFrame, done: pd.Series) -> None:
        if self._remember:
            return
        kept = met[done & (met["mode"] != "manual") & (met["run_status"] != "failed")]
        if len(kept):
            self._last.update((kept["run_id"].iloc[-1],))

    def _rows(self, key, told: pd.DataFrame, kind: str) -> pd.DataFrame:
        ran = told["decision"] == "execute"
        took = pd.to_numeric(told["duration_us"]).fillna(0).where(ran, 0).astype("int64")
        status = told["run_status"].where(ran, told["decision"]) if kind == "status" else None
        return pd.DataFrame(
            {
                "product": key[0], "stage": key[1], "kind": kind,
                "partition": told["partition"].astype("int32"), "offset": told["offset"].astype("int64"),
                "run_id": told["run_id"], "mode": told["mode"], "decision": told["decision"], "status": status,
                "error": told["run_error"].where(ran) if kind == "status" else None,
                "duration_ms": took / 1000.0 if kind == "status" else None,
                "at": pd.to_datetime(told["at_us"].astype("int64") + (took if kind == "status" else 0), unit="us"),
            }
        )

    def close(self) -> None:
        pass


def controlled_stream(
    triggers: DataFrame, results: DataFrame, timeout_secs: int = 3600, lateness: str = "10 seconds", remember_failures: bool = True
) -> DataFrame:
    """A decision and a status message for every trigger with a run id.

    Repeats and manual runs are answered with their decision, executed ones by their result, whichever comes first, or by a
    timeout once event time is that far past the trigger. Without ``remember_failures`` a failed run may be executed again; the triggers
    behind a run wait for its result then. ``triggers`` needs product, stage, partition, offset, run_id, execution_mode and
    timestamp; ``results`` product, stage, partition, offset, run_status, run_error, duration_us and timestamp. Rows of a
    key come in the order of their partition's offsets.
    """
    none = F.lit(None)
    asked = triggers.where("run_id IS NOT NULL").withWatermark("timestamp", lateness).select(
        "product", "stage", F.lit("trigger").alias("kind"), F.col("partition").cast("int").alias("partition"), "offset", "run_id",
        execution_mode("execution_mode").alias("mode"), none.cast("string").alias("run_status"), none.cast("string").alias("run_error"),
        none.cast("bigint").alias("duration_us"), "timestamp", F.unix_micros("timestamp").alias("at_us"),
    )
    ended = results.withWatermark("timestamp", lateness).select(
        "product", "stage", F.lit("result").alias("kind"), F.col("partition").cast("int").alias("partition"), "offset", none.cast("string").alias("run_id"),
        none.cast("string").alias("mode"), "run_status", "run_error", F.col("duration_us").cast("bigint").alias("duration_us"), "timestamp", F.unix_micros("timestamp").alias("at_us"),
    )
    runner = ControlledRunner(timeout_secs * 1_000_000, remember_failures)
    return asked.unionByName(ended).groupBy("product", "stage").transformWithStateInPandas(runner, ANSWERS, "Append", "EventTime")


_NAMES = ["run_id", "stage", "product"]
_ASK = "run_id string, stage string, product string, offset bigint, start_offset bigint, at_us bigint"
_REPLY = "run_id string, stage string, product string, offset bigint, status string, at_us bigint"
WAITS = (
    "run_id string, stage string, product string, trigger_offset bigint, status_offset bigint, status string, "
    "status_at timestamp, outcome string"
)


class StatusWait(StatefulProcessor):
    """State per bucket of runs: asks without an answer, and replies that an ask under way may still take."""

    def __init__(self, timeout_us: int) -> None:
        self._timeout = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._asks = handle.getListState("asks", _ASK)
        self._replies = handle.getListState("replies", _REPLY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows))
        asks = [_held(self._asks, _ASK), events[events["start_offset"].notna()][_columns(_ASK)]]
        replies = [_held(self._replies, _REPLY), events[events["start_offset"].isna()][_columns(_REPLY)]]
        asks, replies = (pd.concat([f for f in x if len(f)] or x[:1]) for x in (asks, replies))
        yield from self._settle(asks, replies, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(_held(self._asks, _ASK), _held(self._replies, _REPLY), timerValues.getCurrentWatermarkInMs() * 1000)

    def _settle(self, asks: pd.DataFrame, replies: pd.DataFrame, now: int) -> Iterator[pd.DataFrame]:
        asks = asks.astype({"start_offset": "int64", "offset": "int64", "at_us": "int64", **dict.fromkeys(_NAMES, "str")}).sort_values("start_offset")
        replies = replies.astype({"offset": "int64", "at_us": "int64", **dict.fromkeys(_NAMES, "str")}).sort_values("offset")
        next_ = replies.rename(columns={"offset": "status_offset", "at_us": "done_us"})
        met = pd.merge_asof(asks, next_, by=_NAMES, left_on="start_offset", right_on="status_offset", direction="forward")
        limit = met["at_us"] + self._timeout
        found = met["status_offset"].notna()
        good = found & (met["done_us"] <= limit)
        # the first reply came too late, or none came and the time is over
        shut = good | found | (limit < now)
        if shut.any():
            told = met[shut]
            good = good[shut]
            yield pd.DataFrame(
                {
                    **{c: told[c] for c in _NAMES}, "trigger_offset": told["offset"],
                    "status_offset": told["status_offset"].where(good).astype("Int64"), "status": told["status"].where(good, None),
                    "status_at": pd.to_datetime(told["done_us"].where(good), unit="us"),
                    "outcome": np.where(~good, "timeout", np.where(told["status"] == "failed", "error", "success")),
                }
            )
        asks = met.loc[~shut, _columns(_ASK)]
        # an ask is not younger than its reply: once the clock is past a reply, none can come for it
        replies = replies[replies["at_us"] >= now]
        _hold(self._asks, asks, _ASK)
        _hold(self._replies, replies, _REPLY)
        _times(self._handle, [int(x.min()) + more for x, more in ((asks["at_us"], self._timeout), (replies["at_us"], 0)) if len(x)])

    def close(self) -> None:
        pass


def status_wait_stream(triggers: DataFrame, statuses: DataFrame, timeout_secs: int = 600, lateness: str = "10 seconds", partition: int = 0, buckets: int = 64) -> DataFrame:
    """One row for each trigger: its first status at or after the start offset, or a timeout.

    However many statuses a run has, none but the answer comes out. The status topic's watched ``partition`` is read in order.
    Runs share ``buckets`` states, so a micro-batch costs a call for each bucket and not for each run; more buckets spread it wider.
    """
    keys = _NAMES
    asks = triggers.where("run_id IS NOT NULL").withWatermark("timestamp", lateness).select(
        *keys, "offset", "start_offset", F.lit(None).cast("string").alias("status"), "timestamp", F.unix_micros("timestamp").alias("at_us")
    )
    replies = statuses.where(F.col("partition") == partition).withWatermark("timestamp", lateness).select(
        *keys, "offset", F.lit(None).cast("bigint").alias("start_offset"), "status", "timestamp", F.unix_micros("timestamp").alias("at_us")
    )
    both = asks.unionByName(replies).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    return both.groupBy("bucket").transformWithStateInPandas(StatusWait(timeout_secs * 1_000_000), WAITS, "Append", "EventTime")
