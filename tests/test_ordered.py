"""Ordered operators against plain loops, with hot keys and null keys."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wharfline.operators.batches import drain_batches
from wharfline.operators.heartbeats import heartbeats, missed_heartbeats
from wharfline.operators.ordered import (
    chunk_by_offset,
    chunk_by_time,
    following_value,
    in_order,
    previous_value,
    row_chunks,
    running_sum,
)
from wharfline.operators.steps import step_durations

T0 = datetime(2026, 1, 1)


def hot_rows(seed, n=1500):
    """A third of the rows share one key; some keys are null."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]), i, rng.choice([None, None, 1, 2, 3]))
        for i in rng.sample(range(10 * n), n)
    ]


@pytest.mark.parametrize("size", [1, 7, 1000, 10**9])
def test_neighbours_and_sums(spark, size):
    rows = hot_rows(size)
    df = spark.createDataFrame(rows, "k string, offset bigint, v bigint").repartition(8)
    chunk = chunk_by_offset("offset", size)
    keys, order = ["k"], ["offset"]
    out = previous_value(df, keys, order, F.col("v"), "before", chunk)
    out = following_value(out, keys, order, F.col("v"), "after", chunk)
    out = running_sum(out, keys, order, F.coalesce("v", F.lit(0)), "total", chunk)
    got = {(r.k, r.offset): (r.before, r.after, r.total) for r in out.collect()}

    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((o, v) for k, o, v in rows if k == key)
        last, total = None, 0
        for o, v in mine:
            total += v or 0
            want[key, o] = [last, None, total]
            last = v if v is not None else last
        last = None
        for o, v in reversed(mine):
            want[key, o][1] = last
            last = v if v is not None else last
    assert got == {k: tuple(v) for k, v in want.items()}


def test_a_hot_key_is_spread_over_tasks(spark):
    """Rows of one key meet in as many groups as there are chunks, never in one."""
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("offset"), F.col("id").alias("v"))
    out = previous_value(df, ["k"], ["offset"], F.col("v"), "before", chunk_by_offset("offset", 500))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    over_rows = [w for w in windows if "__value" in w]
    over_edges = [w for w in windows if "__edge" in w]
    assert len(windows) == 2 and all("__group" in w.split("], [")[1] for w in over_rows)
    assert len(over_edges) == 1
    assert out.where("before = v - 1").count() == 9_999


def test_full_rows_are_shuffled_once(spark):
    """The join on the window group finds the rows dealt as the window left them."""
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("offset"), F.lit("wide").alias("payload"))
    was = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = previous_value(df, ["k"], ["offset"], F.col("offset"), "before", chunk_by_offset("offset", 50))
        tree = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    assert tree.count("Exchange hashpartitioning") == 4 and tree.count("SortMergeJoin") == 1


def test_step_durations_match_a_timer_table(spark):
    rng = random.Random(5)
    rows = [
        (i, T0 + timedelta(seconds=i * 997, microseconds=rng.randint(0, 999_999)), f"r{rng.choice('aaab')}", f"o{rng.randint(0, 2)}",
         rng.choice(["started", "completed", "failed", "skipped", "startup"]))
        for i in range(1200)
    ]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp, run_id string, operation string, event string")
    timers, want = {}, {}
    for i, ts, run, op, event in rows:
        if event == "started":
            timers[run, op] = ts
        elif event in ("completed", "failed"):
            start = timers.pop((run, op), None)
            want[i] = 0.0 if start is None else round((ts - start) / timedelta(microseconds=1) / 1000, 3)
    for chunk in (None, chunk_by_time("ts", 5000)):
        got = {r.event_id: r.duration_ms for r in step_durations(df, chunk).collect()}
        assert got == want


def test_heartbeats(spark):
    rows = [(f"c{i % 2}", T0, T0 + timedelta(seconds=i * 450, milliseconds=i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "component string, started_at timestamp, ts timestamp, event_id bigint")
    got = {r.event_id: (r.sequence, r.uptime_seconds, r.status) for r in heartbeats(df).collect()}
    assert got == {i: (i // 2 + 1, i * 450, "healthy") for i in range(40)}
    assert missed_heartbeats(df, 900, 60).count() == 0
    late = missed_heartbeats(df, 300, 0).collect()
    assert len(late) == 38 and {r.missed for r in late} == {3}


@pytest.mark.parametrize("gap, batches", [(15, 3), (16, 2), (1000, 1)])
def test_drain_batches(spark, gap, batches):
    seconds = [0, 5, 20, 25, 41, 45]  # silences: 5, 15, 5, 16, 4
    rows = [("t", 0, i, T0 + timedelta(seconds=s)) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp")
    for chunk in (chunk_by_time("timestamp", 7), None):
        got = drain_batches(df, gap, chunk=chunk).orderBy("batch_no").collect()
        assert len(got) == batches and sum(r.messages for r in got) == 6
        assert [r.batch_no for r in got] == list(range(1, batches + 1))


def test_chunks_of_a_burst_are_bounded_by_rows(spark):
    """A key with nine tenths of its rows within one hour, beside quiet ones, a null key and null times."""
    rng = random.Random(17)
    seconds = [rng.randrange(3600) for _ in range(9000)] + [rng.randrange(86_400 * 30) for _ in range(1000)]
    rows = [("hot", k, T0 + timedelta(seconds=s, microseconds=rng.randrange(10**6))) for k, s in enumerate(seconds)]
    rows += [(key, 10_000 + k, T0 + timedelta(hours=k)) for k in range(50) for key in ("quiet", None)] + [("hot", 20_000, None)] * 2
    df = spark.createDataFrame(rows, "key string, id bigint, ts timestamp").repartition(5)
    cut = row_chunks(df, ["key"], "ts", 500).cache()
    assert cut.count() == len(rows) and cut.columns == ["key", "id", "ts", "chunk"]
    sizes = {(r.key, r.chunk): r["count"] for r in cut.groupBy("key", "chunk").count().collect()}
    largest = max(Counter(int((w - T0).total_seconds()) for k, _, w in rows if k == "hot" and w).values())
    assert max(sizes.values()) < 500 + largest and sum(k == "hot" for k, _ in sizes) >= 10_000 // (500 + largest)
    assert {k for k in sizes if k[0] != "hot"} == {("quiet", 0), (None, 0)}
    bounds = cut.where("ts IS NOT NULL").groupBy("key", "chunk").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("key", "chunk").collect()
    assert all(x.b <= y.a for x, y in zip(bounds, bounds[1:]) if x.key == y.key)
    unique = cut.where("ts IS NOT NULL")
    ours = previous_value(unique, ["key"], ["ts", "id"], F.when(F.col("id") % 7 == 0, F.col("id")), "before", F.col("chunk"))
    window = Window.partitionBy("key").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = unique.withColumn("before", F.last(F.when(F.col("id") % 7 == 0, F.col("id")), ignorenulls=True).over(window))
    assert sorted(map(str, ours.select("key", "id", "before").collect())) == sorted(map(str, plain.select("key", "id", "before").collect()))
    assert row_chunks(df.limit(0), ["key"], "ts").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_only_handled_messages_reset_the_clock(spark, share):
    """Against a clock that is carried from message to message."""
    rng = random.Random(13)
    at, rows = 0, []
    for i in range(500):
        at += rng.choice([0, 2, 4, 10, 14, 15, 16, 40])
        rows.append(("t", rng.randint(0, 2) if i else None, i, T0 + timedelta(seconds=at), rng.choice([None, False]) if rng.random() < share else True))
    want, clocks = {}, {}
    for _, partition, offset, when, ok in rows:
        last, no = clocks.get(partition, (None, 0))
        ended = last is None or (when - last).total_seconds() >= 15
        batch = no + 1 if ended else no
        if ok:
            clocks[partition] = (when, batch)
        seen = want.setdefault((partition, batch), [0, 0, offset, offset])
        seen[:] = [seen[0] + 1, seen[1] + bool(ok), seen[2], offset]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, ok boolean").repartition(5)
    for chunk in (chunk_by_time("timestamp", 60), chunk_by_time("timestamp", 7), None):
        got = drain_batches(df, 15, chunk=chunk, handled=F.col("ok")).collect()
        assert {(r.partition, r.batch_no): [r.messages, r.handled, r.first_offset, r.last_offset] for r in got} == want
    assert drain_batches(df.limit(0), 15, handled=F.col("ok")).count() == 0


def test_batches_equal_session_windows(spark):
    """Except for a silence of exactly the gap, which a session window bridges."""
    rng = random.Random(11)
    at, rows = 0, []
    for i in range(600):
        at += rng.choice([2, 4, 10, 14, 16, 40])
        rows.append(("t", rng.randint(0, 1), i, T0 + timedelta(seconds=at)))
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp")
    ours = drain_batches(df, 15, chunk=chunk_by_time("timestamp", 60)).select("partition", "first_at", "messages")
    theirs = df.groupBy("topic", "partition", F.session_window("timestamp", "15 seconds").alias("w")).agg(
        F.count("*").alias("messages")
    ).select("partition", F.col("w.start").alias("first_at"), "messages")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_in_order(spark):
    df = spark.createDataFrame([(1, 2), (0, 5), (0, 1)], "partition int, offset bigint").coalesce(1)
    assert [tuple(r) for r in in_order(df).collect()] == [(0, 1), (0, 5), (1, 2)]
