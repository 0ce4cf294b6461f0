"""Controlled runs, status waits and upserted windows as streams, in any cut into micro-batches and over restarts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wharfline.operators import metrics as m
from wharfline.streaming import stateful as st
from wharfline.streaming.controlled import NO_RESULT, controlled_stream, status_wait_stream
from wharfline.streaming.runs import run_drain
from wharfline.streaming.upserts import latest, upsert_stream

ZERO = dt.datetime(2026, 1, 1)
TRIGGER = "product string, stage string, partition int, offset bigint, run_id string, execution_mode string, timestamp timestamp"
RESULT = "product string, stage string, partition int, offset bigint, run_status string, run_error string, duration_us bigint, timestamp timestamp"
ASK = "run_id string, stage string, product string, offset bigint, start_offset bigint, timestamp timestamp"
REPLY = "run_id string, stage string, product string, partition int, offset bigint, status string, timestamp timestamp"


def at(secs):
    return ZERO + dt.timedelta(seconds=secs)


def driven(spark, tmp_path, make, schemas, steps):
    """Each step adds rows to one side or both, then the stream is started again from its checkpoint and drained."""
    st.use_rocksdb(spark)
    sides = [str(tmp_path / f"side{k}") for k in range(2)]
    for side, schema in zip(sides, schemas):
        spark.createDataFrame([], schema).write.parquet(side)
    for step in steps:
        for which, rows in step if isinstance(step, list) else [step]:
            spark.createDataFrame(rows, schemas[which]).coalesce(1).write.mode("append").parquet(sides[which])
        stream = make(*(spark.readStream.schema(s).parquet(side) for s, side in zip(schemas, sides)))
        writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
        run_drain(writer)
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()


def plain_runs(triggers, results, remember, timeout):
    """One trigger after the other, each run waited for."""
    ended = {(r[2], r[3]): r for r in results}
    last, out = {}, Counter()
    for product, stage, partition, offset, run, mode, _ in sorted(triggers, key=lambda r: (r[2], r[3])):
        if run is None:
            continue
        key, manual = (product, stage), (mode or "").strip().lower() == "manual"
        end = ended.get((partition, offset))
        status, error, took = (end[4], end[5], end[6]) if end else ("timeout", NO_RESULT, timeout * 10**6)
        decision = "completed" if last.get(key) == run else "skipped" if manual else "execute"
        if decision != "execute":
            status, error, took = decision, None, 0
        if not manual and (remember or status != "failed"):
            last[key] = run
        out[product, stage, partition, offset, run, decision, status, error, took / 1000] += 1
    return out


def made_runs():
    rng = random.Random(21)
    triggers, results = [], []
    for k in range(120):
        product, run = f"p{k % 3}", rng.choice([f"r{k // 9}", f"r{k // 9}", f"r{k // 9 + 1}", None])
        triggers.append((product, "s", 0, k, run, rng.choice(["x", None, "automatic", " MANUAL "]), at(k * 10)))
        if k % 7:
            failed = rng.random() < 0.5
            results.append((product, "s", 0, k, "failed" if failed else "completed", "ValueError: x" if failed else None, 5_000_000, at(k * 10 + 5)))
    return triggers, results


@pytest.mark.parametrize("remember", [True, False])
@pytest.mark.parametrize("cut", ["together", "results first", "results last"])
def test_controlled_stream(spark, tmp_path, remember, cut):
    triggers, results = made_runs()
    closing = [(0, [("closing", "s", 0, 10**6, "c", "manual", at(10**6 * k))]) for k in (1, 2)]
    closed = [(1, [("closing", "s", 9, 10**6 + k, "completed", None, 1, at(10**6 * k))]) for k in (1, 2)]
    # a started stream knows of no clock but that of the rows it has read since, so both sides close together
    ends = [[closing[0], closed[0]], [closing[1], closed[1]]]
    half = len(triggers) // 2
    steps = {
        "together": [(0, triggers), (1, results)],
        "results first": [(1, results[:50]), (0, triggers[:half]), (1, results[50:]), (0, triggers[half:])],
        "results last": [(0, triggers[:half]), (0, triggers[half:]), (1, results[:50]), (1, results[50:])],
    }[cut]
    rows = driven(spark, tmp_path, lambda a, b: controlled_stream(a, b, 900, "1 hour", remember), (TRIGGER, RESULT), [*steps, *ends])
    rows = [r for r in rows if r["product"] != "closing"]
    statuses = Counter((r["product"], r.stage, r.partition, r.offset, r.run_id, r.decision, r.status, r.error, r.duration_ms) for r in rows if r.kind == "status")
    assert statuses == plain_runs(triggers, results, remember, 900)
    decisions = Counter((r.offset, r.decision) for r in rows if r.kind == "decision")
    assert decisions == Counter((r[3], r[5]) for r in statuses.elements())


def test_one_answer_for_each_trigger(spark, tmp_path):
    asks = [("r", "s", "p", k, start, at(0)) for k, start in enumerate((5, 100, 9_999, 10_000, 20_000))]
    asks += [("late", "s", "p", 50, 0, at(0)), (None, "s", "p", 51, 0, at(0))]
    replies = [("r", "s", "p", 0, k, "failed" if k == 100 else "completed", at(1 + k * 0.01)) for k in range(10_001)]
    replies += [("late", "s", "p", 0, 1, "completed", at(700)), ("late", "s", "p", 0, 2, "completed", at(701)), ("r", "s", "p", 1, 20_001, "completed", at(9))]
    end = lambda k: [(0, [("closing", "s", "p", 0, 0, at(10**5 * k))]), (1, [("closing", "s", "p", 0, 0, "x", at(10**5 * k))])]
    steps = [(1, replies[:6000]), (0, asks), (1, replies[6000:]), end(1), end(2)]
    rows = driven(spark, tmp_path, lambda a, b: status_wait_stream(a, b, 600, "1 hour", buckets=3), (ASK, REPLY), steps)
    got = {r.trigger_offset: (r.status_offset, r.status, r.outcome) for r in rows if r.run_id != "closing"}
    assert len([r for r in rows if r.run_id != "closing"]) == 6
    assert got == {
        0: (5, "completed", "success"), 1: (100, "failed", "error"), 2: (9_999, "completed", "success"), 3: (10_000, "completed", "success"),
        4: (None, None, "timeout"), 50: (None, None, "timeout"),
    }


def test_upserted_windows_are_complete(spark, tmp_path):
    points = [(at(k * 7), f"n{k % 2}", float(k)) for k in range(100)]
    schema, where = "ts timestamp, name string, value double", str(tmp_path / "in")
    for part in (points[:40], points[40:41] + points[:1], points[41:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(where)
        windows = m.metric_windows(spark.readStream.schema(schema).parquet(where), 60, "1 hour")
        run_drain(upsert_stream(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = latest(spark, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["window_start", "name"])
    want = m.metric_windows(spark.createDataFrame([*points, points[0]], schema), 60)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.filter(F.col("points") > 5).count()
