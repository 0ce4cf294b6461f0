"""File cycles over real objects: stages commit, broken runs go on, every object gets an answer."""

import hashlib

import pytest
from pyspark.sql import functions as F

from wharfline.plans.staged_cycle import STAGES, run_cycle
from wharfline.sources.objects import inspect_objects

OBJECTS = {"a/one.csv": b"id,name\n1,x\n", "a/two.csv": b"bad\n", "b/three file.csv": b"id,name\n", "b/four.csv": b"id,name\n4,\n", "empty.csv": b""}


def header_rule():
    return F.col("head").cast("string").startswith("id,name")


def fill(root, objects):
    for name, content in objects.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)


def roots(tmp_path):
    return [str(tmp_path / x) for x in ("source", "staging", "target", "out")]


def told(report):
    return {r.object_key: (r.outcome, r.target_hash, r.error and tuple(r.error)) for r in report.collect()}


def md5(data):
    return hashlib.md5(data).hexdigest()


EXPECTED = {
    "a/one.csv": ("copied", md5(OBJECTS["a/one.csv"]), None),
    "a/two.csv": ("refused", None, None),
    "b/three file.csv": ("refused", None, None),  # a name that may not be copied
    "b/four.csv": ("copied", md5(OBJECTS["b/four.csv"]), None),
    "empty.csv": ("refused", None, None),
}


@pytest.mark.parametrize("stops", [(), STAGES[:-1], ("staged", "staged", "planned")])
def test_cut_off_runs_end_with_the_same_rows(spark, tmp_path, stops):
    fill(tmp_path / "source", OBJECTS)
    for stage in stops:
        assert run_cycle(spark, *roots(tmp_path), target_container="t", rule=header_rule(), stop_after=stage) is None
    report = run_cycle(spark, *roots(tmp_path), target_container="t", rule=header_rule())
    assert told(report) == EXPECTED
    events = spark.read.parquet(f"{tmp_path}/out/8-published")
    assert sorted(bytes(r.value).decode() for r in events.collect()) == [
        '{"sourceType":"S3","storageContainer":"t","path":"a/one.csv"}',
        '{"sourceType":"S3","storageContainer":"t","path":"b/four.csv"}',
    ]
    # a finished cycle is read, a new one finds nothing to do
    (tmp_path / "target" / "a" / "one.csv").write_bytes(b"changed later")
    assert told(run_cycle(spark, *roots(tmp_path), target_container="t", rule=header_rule())) == EXPECTED
    again = run_cycle(spark, *roots(tmp_path)[:3], f"{tmp_path}/next", target_container="t", rule=header_rule())
    assert {k: v[0] for k, v in told(again).items()} == {k: "refused" if k == "b/three file.csv" else "skipped" for k in OBJECTS}


def test_lost_and_changed_objects_are_errors(spark, tmp_path):
    fill(tmp_path / "source", OBJECTS)
    run_cycle(spark, *roots(tmp_path), target_container="t", provider="Azure", stop_after="announced")
    (tmp_path / "staging" / "a" / "one.csv").unlink()
    run_cycle(spark, *roots(tmp_path), target_container="t", provider="Azure", stop_after="landed")
    (tmp_path / "target" / "a" / "two.csv").write_bytes(b"something else")
    (tmp_path / "target" / "b" / "four.csv").unlink()
    got = told(run_cycle(spark, *roots(tmp_path), target_container="t", provider="Azure"))
    assert got["a/one.csv"] == ("failed", None, ("Azure", "FileNotFoundError", "source blob not found"))
    for lost in ("a/two.csv", "b/four.csv"):
        assert got[lost] == ("failed", None, ("Azure", "OSError", "target differs from what was inspected"))
    assert got["empty.csv"] == ("copied", md5(b""), None)
    assert spark.read.parquet(f"{tmp_path}/out/8-published").count() == 1


def test_names_are_mapped_and_one_destination_is_taken_once(spark, tmp_path):
    fill(tmp_path / "source", {"x-1.csv": b"1", "x_1.csv": b"2"})
    report = run_cycle(spark, *roots(tmp_path), target_container="t", dest=F.translate("object_key", "-", "_"))
    assert {k: v[0] for k, v in told(report).items()} == {"x-1.csv": "copied", "x_1.csv": "skipped"}
    assert (tmp_path / "target" / "x_1.csv").read_bytes() == b"1"


def test_empty_container_and_unknown_stage(spark, tmp_path):
    (tmp_path / "source").mkdir()
    assert run_cycle(spark, *roots(tmp_path), target_container="t").collect() == []
    with pytest.raises(ValueError, match="no such stage"):
        run_cycle(spark, *roots(tmp_path), target_container="t", stop_after="nowhere")


def test_objects_are_inspected_in_pieces(spark, tmp_path, monkeypatch):
    from wharfline.sources import objects

    monkeypatch.setattr(objects, "CHUNK", 7)
    body = bytes(range(256)) * 5
    fill(tmp_path, {"big.bin": body, "none.bin": b""})
    keys = spark.createDataFrame([("big.bin",), ("big.bin",), ("none.bin",), ("gone.bin",), (None,)], "object_key string")
    got = {r.object_key: r for r in inspect_objects(keys, str(tmp_path), head=10, tail=20).collect()}
    assert len(got) == 3 and got["gone.bin"].found is False
    big = got["big.bin"]
    assert (bytes(big.head), bytes(big.tail), big.length, big.content_hash) == (body[:10], body[-20:], len(body), md5(body))
    assert got["none.bin"].length == 0 and got["none.bin"].found
