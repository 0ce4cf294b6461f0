"""JSON documents without a fixed schema."""

import json

import pytest
from pyspark.sql import functions as F

from wharfline.operators.screening import REASON, dead_letters, decode_documents, with_fields
from wharfline.streaming.runs import run_drain

SCHEMA = "id int, value binary"
FORGED = "43b9f4b2c9b1dc4d3d5f0bd1a7b0b6a5"
MESSAGES = {
    b'{"a":1}': None,
    b' {"a" : {"b" : [1, {"c" : "d"}]}} \n': None,
    b"{}": None,
    '{"ä":"\\u0000 é"}'.encode(): None,
    b'{"a":1e999}': None,
    None: "null value",
    b'{"a":"\xff"}': "not utf-8",
    b"": "malformed json",
    b" \t": "malformed json",
    b"{'a':1}": "malformed json",
    b'{"a":1': "malformed json",
    b'{"a":1} x': "malformed json",
    b'{"a":1}{"b":2}': "malformed json",
    b'{"a":1}]': "malformed json",
    b'{"a":1},2': "malformed json",
    b'{"a":1}],[2': "malformed json",
    f'{{"a":1}},"{FORGED}"],[1'.encode(): "malformed json",
    b'{"a":1,"a":2}': "malformed json",
    b"[1]": "not an object",
    b"null": "not an object",
    b'"text"': "not an object",
    b"5": "not an object",
    b"true": "not an object",
}


def test_any_document_or_a_reason(spark):
    rows = [(i, v) for i, v in enumerate(MESSAGES)] * 2
    decoded = decode_documents(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = decoded.select("id", REASON, F.col("body").cast("string").alias("body")).collect()
    assert len(got) == len(rows)
    for r in got:
        value, reason = list(MESSAGES.items())[r.id]
        assert r[REASON] == reason
        assert (r.body is None) == (reason is not None)
    assert json.loads(next(r.body for r in got if r.id == 1)) == json.loads(list(MESSAGES)[1])
    assert dead_letters(decoded).count() + decoded.filter(F.col(REASON).isNull()).count() == len(rows)
    assert decode_documents(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"n":5,"s":"x","in":{"k":[7,8]}}', (5, "x", 8)),
        ('{"n":"5","s":5}', (5, "5", None)),
        ('{"n":"many","s":null,"in":[1]}', (None, None, None)),
        ("[]", (None, None, None)),
    ],
)
def test_fields_by_path(spark, text, want):
    fields = {"n": ("$.n", "bigint"), "s": ("$.s", "string"), "k": ("$.in.k[1]", "bigint")}
    row = with_fields(decode_documents(spark.createDataFrame([(1, text.encode())], SCHEMA)), fields).first()
    assert (row.n, row.s, row.k) == want


def test_documents_of_a_stream(spark, tmp_path):
    """A stream goes on past bad messages; what is kept and what is passed over add up."""
    rows = [(i, v) for i, v in enumerate(MESSAGES)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = decode_documents(stream).select("id", REASON, F.col("body").cast("string").alias("body"))
    run_drain(out.writeStream.option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").format("parquet"))
    got = {r.id: r[REASON] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {i: MESSAGES[v] for i, v in rows}
