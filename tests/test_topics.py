"""Headers, routing, forwarding, dead letters, handlers, catalogue."""

import json
import random

from pyspark.sql import functions as F

from wharfline.functions.headers import header, header_exact, with_trace
from wharfline.operators.catalogue import missing_topics, present_topics
from wharfline.operators.handlers import apply_handler
from wharfline.operators.screening import has_csv_columns, non_empty, parses_as_json, schema_gate
from wharfline.plans.topic_flow import check_route, enrich_static, forward, route
from wharfline.sources.topics import MESSAGE, event_messages, reader_options, writer_options

TRACE = "00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01"


def messages(spark, *header_lists, value=b"value", key=b"key"):
    rows = [
        (key, value, "mapper-topic", 3, 42 + i, None, None if h is None else [(k, v) for k, v in h])
        for i, h in enumerate(header_lists)
    ]
    return spark.createDataFrame(rows, MESSAGE)


SNAKE = [("schema_type", b"EQBD"), ("org_name", b"QUAY"), ("product_type", b"EQBD PG Gas")]
CAMEL = [("schemaType", b"EQBD"), ("orgName", b"QUAY"), ("productType", b"EQBD PG Gas")]
UPPER = [(k.upper(), v) for k, v in CAMEL]


def test_routing_by_snake_camel_and_upper(spark):
    df = messages(spark, [*SNAKE, ("traceparent", TRACE.encode())], CAMEL, UPPER, None, [("schema_type", b""), *SNAKE[1:]])
    got = check_route(df).orderBy("offset").collect()
    topic = "dpn-consumer-quay-eqbd-eqbdpggas-target"
    assert [r.target for r in got] == [topic, topic, topic, None, None]
    assert got[3].reject_reason == "unknown metadata: schema_type,org_name,product_type"
    assert got[4].reject_reason == "unknown metadata: schema_type"


def test_stamped_headers(spark):
    df = messages(spark, [*SNAKE, ("traceparent", TRACE.encode())])
    row = route(df, F.lit("now")).first()
    assert [(h.key, bytes(h.value)) for h in row.headers] == [
        ("schemaType", b"eqbd"), ("orgName", b"quay"), ("productType", b"eqbdpggas"), ("processedAt", b"now"), ("offset", b"42"),
    ]
    assert (row.trace.trace_id, row.trace.parent_id) == tuple(TRACE.split("-")[1:3])


def test_strict_stamp(spark):
    got = route(messages(spark, UPPER, CAMEL), F.lit("x"), strict_stamp=True).orderBy("offset").collect()
    assert [bytes(r.headers[0].value) for r in got] == [b"unknown", b"eqbd"]


def test_lookup_follows_insertion_order(spark):
    df = messages(spark, [("A", b"1"), ("a", b"2"), ("A", b"3")])
    assert df.select(header("headers", "a"), header_exact("headers", "A")).first()[:] == ("2", "3")


def test_lookup_matches_a_dict(spark):
    rng = random.Random(3)
    lists = [
        [(rng.choice(["a", "A", "b", "B", "ab"]), rng.choice([b"", b"1", b"2", b"3"])) for _ in range(rng.randint(0, 6))]
        for _ in range(300)
    ]

    def expected(pairs):
        folded = {k.lower(): v.decode() for k, v in dict(pairs).items()}
        return folded.get("a") or folded.get("b") or None

    got = messages(spark, *lists).orderBy("offset").select(header("headers", "a", "b")).collect()
    assert [r[0] for r in got] == [expected(p) for p in lists]


def test_broken_header_is_a_dead_letter(spark):
    row = check_route(messages(spark, [*SNAKE, ("note", b"\xff")])).first()
    assert row.reject_reason == "header not utf-8" and row.target is None


def test_forward_keeps_all_and_adds_a_trace(spark):
    df = messages(spark, SNAKE, None, key=None, value=None)
    a, b = forward(df, "mapper").orderBy("offset").collect()
    assert a.key is None and a.value is None and a.topic == "mapper"
    assert [h.key for h in a.headers] == ["schema_type", "org_name", "product_type", "traceparent"]
    assert [h.key for h in b.headers] == ["traceparent"] and a.headers[-1].value != b.headers[-1].value
    again = forward(df, "mapper").orderBy("offset").first()
    assert again.headers[-1].value == a.headers[-1].value
    one_run = forward(df, "mapper", run="r1").collect()
    assert len({bytes(r.headers[-1].value)[3:35] for r in one_run}) == 1


def test_malformed_trace_starts_anew(spark):
    for bad in (b"x", TRACE.replace("00-", "ff-", 1).encode(), ("00-" + "0" * 32 + "-" + "1" * 16 + "-01").encode()):
        row = with_trace(messages(spark, [("traceparent", bad)]), new_root=False).first()
        assert row.trace.parent_id is None and len(row.trace.trace_id) == 32


def test_static_enrich(spark):
    row = enrich_static(messages(spark, SNAKE), "QUAY", "", "EQBD PG Gas", F.lit("t")).first()
    assert row.topic == "dpn-producer-quay-unknown-eqbdpggas-target"


def test_handler_isolates_errors(spark):
    df = spark.createDataFrame([(b'{"k": 1}',), (b"bad",), (b'{"k": 0}',), (None,)], "value binary")
    got = apply_handler(df, lambda p: 10 / p["k"]).collect()
    assert [r.result for r in got] == ["10.0", None, None, None]
    assert [r.error_type for r in got] == [None, "JSONDecodeError", "ZeroDivisionError", "TypeError"]


def test_schema_rules(spark):
    df = spark.createDataFrame([("id,name\n1,a",), ("",), ('{"a":1}',), (None,)], "c string")
    assert schema_gate(df).count() == 4
    assert schema_gate(df, non_empty("c")).count() == 2
    assert [r.c for r in schema_gate(df, has_csv_columns("c", ["name", "id"])).collect()] == ["id,name\n1,a"]
    assert [r.c for r in schema_gate(df, parses_as_json("c", "a int")).collect()] == ['{"a":1}']


def test_catalogue(spark):
    need = spark.createDataFrame([("a",), ("b",), ("a",)], "topic string")
    have = spark.createDataFrame([("b",), ("c",)], "topic string")
    assert [r.topic for r in missing_topics(need, have).collect()] == ["a"]
    assert [r.topic for r in present_topics(need, have).collect()] == ["b"]


def test_event_messages_and_options(spark):
    df = spark.range(1).select(F.struct(F.lit("S3").alias("sourceType"), F.lit("p").alias("path")).alias("event"))
    row = event_messages(df, "t").first()
    assert row.key is None and json.loads(bytes(row.value)) == {"sourceType": "S3", "path": "p"}
    assert reader_options("h:1", "t")["startingOffsets"] == "earliest"
    assert writer_options("h:1")["kafka.acks"] == "all" and writer_options("h:1")["kafka.compression.type"] == "lz4"
