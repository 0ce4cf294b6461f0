"""Column functions against known answers."""

import base64
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wharfline.functions import context as c
from wharfline.functions import events as ev
from wharfline.functions import objects as o
from wharfline.functions import topics as tp
from wharfline.functions.text import iso_utc, strip
from wharfline.operators.validation import decode_base64, is_base64


def values(spark, texts, fn):
    rows = [(i, x) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_safe_keys(spark):
    good = ["safe/path-file_1.csv", "é/ü.csv", "a\n", "日本/１"]
    bad = ["", "bad key", "bad;key", "bad$key", None, "a\r", "a\n\n", "\n"]
    assert values(spark, good, o.is_safe_key) == [True] * len(good)
    assert values(spark, bad, o.is_safe_key) == [False] * len(bad)


def test_mapped_name(spark):
    got = values(spark, ["My-File Name.csv"], lambda x: o.mapped_name(F.lit("NaturalGas"), F.lit("Mole"), x))
    assert got == ["naturalgas-mole-my_file_name.csv"]


def test_source_type_and_provider(spark):
    assert values(spark, ["AWS", "aws", "azure", "gcp"], o.source_type) == ["S3", "S3", "AZURE", "GCP"]
    assert values(spark, [" AWS ", "Azure\n", "gcp", None], o.provider) == ["aws", "azure", "unsupported", "unsupported"]


def test_file_ready_json(spark):
    got = values(
        spark, ["naturalgas-mole-file.csv"],
        lambda x: F.to_json(o.file_ready(F.lit("target-container"), x, F.lit("azure"))),
    )
    assert got == ['{"sourceType":"AZURE","storageContainer":"target-container","path":"naturalgas-mole-file.csv"}']


def test_provider_label_and_error_record(spark):
    kinds = ["AzureError", "ClientError", "GoogleAPIError", "ValueError"]
    assert values(spark, kinds, o.provider_label) == ["Azure", "AWS S3", "GCP", ""]
    got = values(spark, ["", None, " GCP "], lambda x: o.error_record(x, F.lit("E"), F.lit("m"))["provider"])
    assert got == ["Unknown", "Unknown", "GCP"]


def test_sanitize(spark):
    texts = ["EQBD PG Gas", None, "", "!!!", "A-B_C 123", "Straße"]
    assert values(spark, texts, tp.sanitize) == ["eqbdpggas", "unknown", "unknown", "unknown", "abc123", "strae"]
    assert values(spark, ["!!!"], lambda x: tp.sanitize(x, "fallback")) == ["fallback"]


def test_resolve_topic(spark):
    got = values(spark, ["", None, " \t", " my-topic\n"], lambda x: tp.resolve_topic(x, F.lit("src-topic"), "trfm"))
    assert got == ["src-topic-trfm"] * 3 + ["my-topic"]


def test_target_topic_and_groups(spark):
    one = spark.range(1)
    lit = F.lit
    assert one.select(tp.target_topic("consumer", lit("quay"), lit("eqbd"), lit("eqbdpggas"))).first()[0] == (
        "dpn-consumer-quay-eqbd-eqbdpggas-target"
    )
    assert one.select(tp.control_group(lit("dl"), lit("adaptor"))).first()[0] == "dl-adaptor-control"
    run = "scheduled__2026-05-26T08:00:00+00:00" * 2
    expected = f"airflow-sensor-{run.replace(':', '-')[:50]}-adaptor"
    assert one.select(tp.sensor_group(lit(run), lit("adaptor"))).first()[0] == expected


def test_strip_matches_python(spark):
    edges = [chr(i) for i in (9, 10, 11, 12, 13, 28, 31, 32, 133, 160, 5760, 8192, 8202, 8232, 8239, 8287, 12288)]
    texts = [f"{e}a b{e}{e}" for e in edges] + ["​x​", "", "  "]
    assert values(spark, texts, strip) == [t.strip() for t in texts]


def test_execution_mode(spark):
    got = values(spark, ["manual", " MANUAL ", "automatic", "x", None], c.execution_mode)
    assert got == ["manual", "manual", "automatic", "automatic", "automatic"]


def test_identity_is_closed():
    c.Identity("adaptor", "file", "producer")
    with pytest.raises(ValueError):
        c.Identity("loader", "file", "producer")


def test_run_context_ignores_payload_identity(spark):
    df = spark.createDataFrame(
        [("r1", "manual", "d", None, "payload-stage"), (None, None, None, None, None)],
        "run_id string, execution_mode string, dag_run_id string, dag_id string, stage string",
    )
    me = c.Identity("schema_mapper", "topic", "consumer", "p", "")
    a, b = [r.context for r in c.run_context(df, me).collect()]
    assert (a.run_id, a.mode, a.triggered_by, a.pipeline_stage) == ("r1", "manual", "kafka-trigger", "schema_mapper")
    assert (a.dag_run_id, a.dag_id) == ("d", "") and len(b.run_id) == 36 and b.mode == "automatic"
    attrs = c.run_context(df, me).select(c.context_attributes(F.col("context")).alias("m")).first().m
    assert "component.name" not in attrs and attrs["pipeline.role"] == "consumer"


def test_durations(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0, 0, 0, 500), datetime(2026, 1, 1, 0, 0, 1, 1499))], "a timestamp, b timestamp"
    )
    assert df.select(c.whole_ms("a", "b"), c.exact_ms("a", "b")).first()[:] == (1000, 1000.999)


def test_iso(spark):
    df = spark.sql("select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-01 00:00:00.000120' b")
    assert df.select(iso_utc("a"), iso_utc("b")).first()[:] == (
        "2026-01-01T00:00:00+00:00", "2026-01-01T00:00:00.000120+00:00",
    )


def test_severity(spark):
    levels = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL", "TRACE", None]
    assert [tuple(x) for x in values(spark, levels, c.severity)] == [
        (5, "DEBUG"), (9, "INFO"), (13, "WARN"), (17, "ERROR"), (21, "FATAL"), (9, "INFO"), (9, "INFO"),
    ]


def test_decode_events(spark):
    texts = ['{"path": "file1.csv"}', "{}", '{"path":""}', "bad", "[]", '[{"path":"z"}]', "null", "5", '"x"', None]
    df = spark.createDataFrame([(i, None if t is None else t.encode()) for i, t in enumerate(texts)], "i int, v binary")
    got = df.withColumn("e", ev.decode_json("v")).orderBy("i").select(ev.decode_problem("v", F.col("e"))).collect()
    malformed = "malformed json"
    assert [r[0] for r in got] == [
        None, "missing path", "missing path", malformed, malformed, malformed, malformed, malformed, malformed, "null value",
    ]


def test_base64_is_as_lenient_as_python(spark):
    rng = random.Random(7)
    texts = ["!!!!", "abc", "abcd", "ab==", "ab=", "a===", "ab=c", "abc=xyz", "é", "=", "ab=c=\nd="]
    texts += ["".join(rng.choice("aB1+/==!\n ") for _ in range(rng.randint(0, 9))) for _ in range(3000)]

    def decoded(t):
        try:
            return base64.b64decode(t)
        except Exception:
            return None

    want = [decoded(t) for t in texts]
    assert values(spark, texts, is_base64) == [w is not None for w in want]
    assert [None if v is None else bytes(v) for v in values(spark, texts, decode_base64)] == want


def test_version_pattern_matches_python(spark):
    from wharfline.operators.validation import VERSION

    texts = ["1.0.0", "v1.2.3", "1.2", "1.2.3\n", "1.2.3\n\n", "٣.1.2", "v1.2.3.4", " 1.2.3", "1.2.3\r"]
    want = [bool(re.match(r"^v?\d+\.\d+\.\d+$", t)) for t in texts]
    assert values(spark, texts, lambda x: x.rlike(VERSION)) == want
