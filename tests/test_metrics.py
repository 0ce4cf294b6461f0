"""Counters, histograms, step statistics, export lines, logs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wharfline.functions.context import log_record
from wharfline.operators import metrics as m
from wharfline.operators.steps import timed_steps
from wharfline.session import run_folder
from wharfline.sources.records import read_log, write_log, write_metric_lines

T0 = datetime(2026, 1, 1)
POINT = "name string, kind string, value double, attributes map<string,string>, ts timestamp"


def test_counters_ignore_entry_order(spark):
    rows = [
        ("files_moved_total", "counter", 1.0, {"cloud_provider": "azure", "status": "success"}, T0),
        ("files_moved_total", "counter", 2.0, {"status": "success", "cloud_provider": "azure"}, T0),
        ("files_moved_total", "counter", 1.0, {"status": "error", "cloud_provider": "azure"}, T0),
        ("active", "updown", 1.0, {}, T0), ("active", "updown", -1.0, {}, T0), ("active", "updown", 1.0, {}, T0),
    ]
    df = spark.createDataFrame(rows, POINT)
    assert sorted((r.total, r.points) for r in m.counters(df).collect()) == [(1.0, 1), (3.0, 2)]
    assert [r.level for r in m.updown(df).collect()] == [1.0]


def test_histogram_bounds_are_inclusive_above(spark):
    rows = [("d", "histogram", v, {"s": "t"}, T0) for v in (0.0, 0.1, 5.0, 5.1, 10000.0, 10001.0, 1e9)]
    row = m.histogram(spark.createDataFrame(rows, POINT)).first()
    assert (row["count"], row["min"], row["max"]) == (7, 0.0, 1e9)
    assert row.buckets[:3] == [1, 2, 1] and row.buckets[-2:] == [1, 2] and sum(row.buckets) == 7
    assert len(row.buckets) == len(m.DEFAULT_BOUNDS) + 1


def test_step_statistics(spark):
    rows = [
        (1, T0, "r", "started", "op"), (2, T0 + timedelta(milliseconds=1500), "r", "completed", "op"),
        (3, T0 + timedelta(seconds=9), "r", "failed", "op"), (4, T0 + timedelta(seconds=10), "r", "skipped", "skip"),
    ]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp, run_id string, event string, operation string")
    df = df.withColumns({k: F.lit(v) for k, v in dict(stage="s", type="t", role="r", mode="m").items()})
    got = {r.operation: r for r in m.step_stats(timed_steps(df)).collect()}
    assert (got["op"].started, got["op"].completed, got["op"].failed, got["op"].last_duration_ms) == (1, 1, 1, 0.0)
    assert (got["skip"].skipped, got["skip"].last_duration_ms) == (1, None)


def test_metric_lines(spark):
    tags = [("stage", "adaptor"), ("mode", "automatic")]
    df = spark.createDataFrame(
        [("pipeline.step.started", "counter", 1.0, tags), ("pipeline.step.duration_ms", "gauge", 12.34567, tags), ("x", "counter", 2.0, [])],
        "name string, kind string, value double, tags array<struct<key:string,value:string>>",
    )
    lines = m.metric_lines(df)
    want = ["pipeline.step.started|#stage:adaptor,mode:automatic:1|c", "pipeline.step.duration_ms|#stage:adaptor,mode:automatic:12.346|g", "x:2|c"]
    assert [r.value for r in lines.collect()] == want
    folder = run_folder(spark, "lines")
    write_metric_lines(lines, folder)
    assert sorted(r.value for r in spark.read.text(folder).collect()) == sorted(want)


def test_calls_and_errors(spark):
    df = spark.createDataFrame(
        [("f", None, None, 5), ("f", None, None, 7), ("f", "ValueError", "bad", 1), ("g", "ValueError", "bad", 2)],
        "function string, error_type string, error_message string, duration_us bigint",
    )
    got = {(r.function, r.status): (r.calls, r.total_us, r.max_us) for r in m.call_stats(df).collect()}
    assert got == {("f", "success"): (2, 12, 7), ("f", "error"): (1, 1, 1), ("g", "error"): (1, 2, 2)}
    assert m.errors_total(df.where("error_type is not null")).first().errors == 2


def test_windows(spark):
    rows = [("n", "counter", 1.0, {}, T0 + timedelta(seconds=s)) for s in (0, 59, 60, 61)]
    got = m.metric_windows(spark.createDataFrame(rows, POINT)).orderBy("window_start").collect()
    assert [(r.window_start, r.points) for r in got] == [(T0, 2), (T0 + timedelta(seconds=60), 2)]


def test_log_round_trip(spark):
    cols = log_record(
        F.lit(T0), F.lit("ERROR"), F.lit("body"), F.lit("svc"), F.lit("1"),
        {"code.lineno": F.lit(5), "logger.name": F.lit("a")},
        F.create_map(F.lit("logger.name"), F.lit("b"), F.lit("msg"), F.lit("dropped"), F.lit("k"), F.lit("v")),
        {"type": F.lit("E"), "message": F.lit("m")},
    )
    records = spark.range(1).select(*cols)
    folder = run_folder(spark, "log")
    write_log(records, folder)
    assert len(spark.read.text(folder).collect()) == 1
    row = read_log(spark, folder).first()
    assert row.timestamp == T0 and row.severity_number == 17 and row.resource == {"service.name": "svc", "service.version": "1"}
    assert row.attributes == {"code.lineno": "5", "logger.name": "b", "k": "v", "exception.type": "E", "exception.message": "m"}
    assert row.trace_id is None
