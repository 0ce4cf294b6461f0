"""Trigger decisions, waiting for statuses, the in-flight guard."""

import json
import random
from datetime import datetime, timedelta


from pyspark.sql import functions as F

from wharfline.functions.context import Identity
from wharfline.operators import triggers as op
from wharfline.operators.ordered import chunk_by_offset
from wharfline.plans.controlled import published_statuses

T0 = datetime(2026, 1, 1)
SCHEMA = (
    "offset bigint, product string, stage string, run_id string, execution_mode string, run_failed boolean"
)


def decide(rows):
    """The runner's loop, one trigger at a time."""
    last, out = {}, {}
    for offset, product, stage, run, mode, _ in sorted(rows):
        key = (product, stage)
        if run == last.get(key):
            out[offset] = "completed"
        elif (mode or "").strip().lower() == "manual":
            out[offset] = "skipped"
        else:
            out[offset], last[key] = "execute", run
    return out


def test_known_sequence(spark):
    rows = [(i, "p", "adaptor", r, m, False) for i, (r, m) in enumerate(
        [("a", "automatic"), ("a", "automatic"), ("b", " MANUAL "), ("b", None), ("b", "manual")])]
    got = op.decide_triggers(spark.createDataFrame(rows, SCHEMA).withColumn("partition", F.lit(0))).orderBy("offset").collect()
    assert [r.decision for r in got] == ["execute", "completed", "skipped", "execute", "completed"]


def test_random_triggers_match_the_loop(spark):
    rng = random.Random(1)
    rows = [
        (i, "hot" if rng.random() < 0.5 else rng.choice("pq"), rng.choice(["adaptor", "schema_mapper"]),
         f"r{rng.randint(0, 2)}", rng.choice(["manual", "automatic", "x", None]), rng.random() < 0.2)
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("partition", F.lit(0)).repartition(8)
    for size in (1, 50, 10**6):
        got = op.decide_triggers(df, chunk=chunk_by_offset("offset", size)).collect()
        assert {r.offset: r.decision for r in got} == decide(rows)


def test_failed_runs_may_be_forgotten(spark):
    rows = [(0, "p", "s", "a", None, True), (1, "p", "s", "a", None, False), (2, "p", "s", "a", None, False)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("partition", F.lit(0))
    kept = [r.decision for r in op.decide_triggers(df).orderBy("offset").collect()]
    free = [r.decision for r in op.decide_triggers(df, remember_failures=False).orderBy("offset").collect()]
    assert kept == ["execute", "completed", "completed"] and free == ["execute", "execute", "completed"]


def test_matching(spark):
    me = Identity("adaptor", "file", "producer", "dl")
    rows = [("adaptor", "file", "producer", "dl"), ("adaptor", "topic", "producer", "dl"),
            ("adaptor", "file", "producer", None), ("schema_mapper", "file", "producer", "dl")]
    df = spark.createDataFrame(rows, "stage string, pipeline_type string, pipeline_role string, product string")
    assert op.match_triggers(df, me).count() == 1


def test_messages_round_trip(spark):
    df = spark.createDataFrame(
        [("adaptor", "file", "producer", "dl", "r:1", "d", None, None, T0, "failed", "E: x", 1.23456)],
        "stage string, pipeline_type string, pipeline_role string, product string, run_id string, dag_run_id string, "
        "dag_id string, execution_mode string, timestamp timestamp, status string, error string, duration_ms double",
    )
    t = op.build_triggers(df).first()
    assert bytes(t.key) == b"r:1" and json.loads(bytes(t.value)) == {
        "stage": "adaptor", "pipeline_type": "file", "pipeline_role": "producer", "product": "dl", "run_id": "r:1",
        "dag_run_id": "d", "dag_id": None, "execution_mode": "automatic", "triggered_by": "airflow",
        "timestamp": "2026-01-01T00:00:00+00:00",
    }
    s = json.loads(bytes(op.build_statuses(df).first().value))
    assert s["duration_ms"] == 1.235 and s["error"] == "E: x" and "triggered_by" not in s


def test_end_offset(spark):
    df = spark.createDataFrame([(0, 4), (1, 9), (0, 2)], "partition int, offset bigint")
    assert op.end_offset(df).first()[0] == 5 and op.end_offset(df.limit(0)).first()[0] == 0


def test_first_trigger(spark):
    df = spark.createDataFrame(
        [("p", "s", 1, 0, "b"), ("p", "s", 0, 7, "a"), ("p", "s", 0, 9, "c")],
        "product string, stage string, partition int, offset bigint, run_id string",
    )
    assert op.first_trigger(df).first().run_id == "a"


def test_await_status_matches_a_scan(spark):
    rng = random.Random(2)
    at = lambda o: T0 + timedelta(seconds=o)
    runs = ["hot"] * 5 + ["a", "b"]
    asks = [(rng.choice(runs), rng.choice("st"), "p", i, rng.randint(0, 4000)) for i in range(800)]
    asks = [(*a, at(a[4])) for a in asks]
    replies = [
        (rng.choice(runs), rng.choice("st"), "p", o, rng.choice(["completed", "failed", "skipped"]), at(o))
        for o in rng.sample(range(4000), 400)
    ]
    triggers = spark.createDataFrame(
        asks, "run_id string, stage string, product string, offset bigint, start_offset bigint, timestamp timestamp"
    )
    statuses = spark.createDataFrame(
        replies, "run_id string, stage string, product string, offset bigint, status string, timestamp timestamp"
    )
    want = {}
    for run, stage, product, n, start, ts in asks:
        hits = sorted(r[3:] for r in replies if r[:3] == (run, stage, product) and r[3] >= start)
        if not hits or hits[0][2] > ts + timedelta(seconds=30):
            want[n] = (None, "timeout")
        else:
            want[n] = (hits[0][0], "error" if hits[0][1] == "failed" else "success")
    # the other partition's offsets count something else
    other = statuses.select(F.lit(1).alias("partition"), "*").withColumn("status", F.lit("failed"))
    statuses = statuses.select(F.lit(0).alias("partition"), "*").unionByName(other)
    for size in (10, 10**6):
        got = op.await_status(triggers, statuses, 30, size).collect()
        assert {r.offset: (r.status_offset, r.outcome) for r in got} == want


def test_run_timeline(spark):
    sec = lambda s: T0 + timedelta(seconds=s)
    rows = [
        ("r1", "p", "adaptor", 0, 0, sec(0), sec(5), "success"), ("r1", "p", "schema_mapper", 1, 9, sec(6), sec(8), "success"),
        ("r2", "p", "adaptor", 2, 0, sec(0), sec(5), "success"), ("r2", "p", "schema_mapper", 3, 9, sec(4), sec(8), "success"),
        ("r3", "p", "adaptor", 4, 0, sec(0), None, "timeout"),
    ]
    df = spark.createDataFrame(
        rows,
        "run_id string, product string, stage string, offset bigint, start_offset bigint, timestamp timestamp, "
        "status_at timestamp, outcome string",
    )
    got = {r.run_id: r for r in op.run_timeline(df).collect()}
    assert got["r1"].chain_complete and got["r1"].second_micros == 2_000_000
    assert not got["r2"].chain_complete and got["r3"].second_outcome == "not triggered"


def test_overlap_flags_match_a_walk(spark):
    rng = random.Random(4)
    for longest in (5, 60, 3000):
        rows = [
            ("hot" if rng.random() < 0.5 else "q", "s", i, s, s + rng.randint(0, longest))
            for i, s in enumerate(sorted(rng.randint(0, 5000) for _ in range(700)))
        ]
        busy, want = {}, {}
        for product, _, offset, start, end in sorted(rows, key=lambda r: (r[3], r[2])):
            want[offset] = product not in busy or start >= busy[product]
            if want[offset]:
                busy[product] = end
        scaled = [(p, s, o, a * 1_000_000, b * 1_000_000) for p, s, o, a, b in rows]
        df = spark.createDataFrame(scaled, "product string, stage string, offset bigint, start_us bigint, end_us bigint")
        got = op.overlap_flags(df, chunk_secs=400).collect()
        assert {r.offset: r.accepted for r in got} == want
        assert all((r.error == op.BUSY) != r.accepted for r in got)


def test_published_statuses(spark):
    triggers = spark.createDataFrame(
        [(0, "p", "s", "file", "producer", "a", "automatic", T0), (1, "p", "s", "file", "producer", "a", "automatic", T0),
         (2, "p", "s", "file", "producer", "b", "manual", T0), (3, "p", "s", "file", "producer", "c", "x", T0)],
        "offset bigint, product string, stage string, pipeline_type string, pipeline_role string, run_id string, "
        "execution_mode string, timestamp timestamp",
    ).withColumn("partition", F.lit(0))
    results = spark.createDataFrame(
        [(0, 0, "failed", "E: x", 1500), (1, 0, "completed", None, 9)],
        "partition int, offset bigint, run_status string, run_error string, duration_us bigint",
    )
    got = {r.offset: (r.status, r.error, r.duration_ms) for r in published_statuses(triggers, results).collect()}
    assert got == {0: ("failed", "E: x", 1.5), 1: ("completed", None, 0.0), 2: ("skipped", None, 0.0)}


def test_partitions_are_told_apart(spark):
    rows = [(p, o, "p", "s", r, "x", T0) for p, o, r in ((0, 0, "a"), (1, 0, "b"), (0, 1, "a"), (1, 1, "b"))]
    df = spark.createDataFrame(
        rows, "partition int, offset bigint, product string, stage string, run_id string, execution_mode string, timestamp timestamp"
    )
    want = {(0, 0): "execute", (0, 1): "completed", (1, 0): "execute", (1, 1): "completed"}
    for chunk in (None, op.chunk_by_place(1)):
        assert {(r.partition, r.offset): r.decision for r in op.decide_triggers(df, chunk=chunk).collect()} == want


def test_triggers_without_run_are_dead_letters(spark):
    df = spark.createDataFrame([("a",), (None,)], "run_id string")
    assert [(r.run_id, r.reject_reason) for r in op.trigger_dead_letters(df).collect()] == [(None, op.NO_RUN_ID)]
