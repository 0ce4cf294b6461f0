"""Copy plans, real copies and moves."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wharfline.functions.objects import mapped_name
from wharfline.operators import copies as cp
from wharfline.operators.metrics import copy_counters
from wharfline.plans.file_flow import announce, consumer_flow, first_stage, producer_flow, second_stage
from wharfline.sources import objects as ob

D1, D2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
LISTING = "object_key string, modified timestamp, length bigint"


def listing(spark, rows):
    return spark.createDataFrame([(k, m, 1) for k, m in rows], LISTING)


@pytest.fixture(scope="module")
def plan(spark):
    asked = spark.createDataFrame([(k,) for k in ["missing.csv", "a.csv", "b.csv", "c.csv", "e.csv", "bad key", "b.csv"]], "object_key string")
    src = listing(spark, [("a.csv", D1), ("b.csv", D2), ("c.csv", D2), ("e.csv", D1), ("bad key", D2)])
    tgt = listing(spark, [("a.csv", D2), ("c.csv", D1), ("e.csv", D1)])
    return cp.copy_plan(asked, src, tgt).cache()


def test_decisions(plan):
    got = {r.object_key: (r.copied, r.skipped, r.reason) for r in plan.collect()}
    assert got == {
        "missing.csv": (False, False, "source object not found"),
        "a.csv": (False, True, "target up-to-date (src=2026-01-01T00:00:00+00:00, tgt=2026-01-02T00:00:00+00:00)"),
        "b.csv": (True, False, "created"),
        "c.csv": (True, False, "overwritten"),
        "e.csv": (False, True, "target up-to-date (src=2026-01-01T00:00:00+00:00, tgt=2026-01-01T00:00:00+00:00)"),
        "bad key": (False, False, "unsafe object key"),
    }


def test_summary_and_counters(plan):
    row = cp.cycle_summary(plan).first()
    assert (row.total, row.copied, row.skipped, row.failed, row.reference_skipped) == (7, 2, 3, 2, 4)
    assert cp.needs_copy(plan).count() == 2
    assert plan.where(cp.succeeded(plan)).count() == 4
    got = {(r.status, r.reference_status): r.files_processed_total for r in copy_counters(plan).collect()}
    assert got == {("success", "success"): 3, ("skipped", "skipped"): 2, ("error", "skipped"): 1, ("error", "error"): 1}


def test_vendors(spark):
    one = listing(spark, [("a", D1)])
    empty = listing(spark, [("z", D1)])
    asked = one.select("object_key").unionByName(spark.sql("select 'q' object_key"))
    azure = {r.object_key: r.reason for r in cp.copy_plan(asked, one, empty, vendor="azure").collect()}
    assert azure == {"a": "created", "q": "source blob not found"}
    other = cp.copy_plan_of_listing(one, empty, "gcp").first()
    assert (other.copied, other.skipped, other.reason) == (False, False, "unsupported vendor")


def test_only_the_first_of_one_destination_is_copied(spark):
    src = listing(spark, [("A-b", D2), ("a_b", D2), ("a-b", D1), ("x", D2)])
    asked = spark.createDataFrame([("a-b", 0), ("a_b", 1), ("A-b", 2), ("x", 3)], "object_key string, order_no bigint")
    name = mapped_name(F.lit("S"), F.lit("O"), "object_key")
    tgt = listing(spark, [("s-o-a_b", D1)])
    got = {r.object_key: (r.dest_key, r.copied, r.skipped) for r in cp.copy_plan(asked, src, tgt, name).collect()}
    assert got == {
        "a-b": ("s-o-a_b", False, True), "a_b": ("s-o-a_b", True, False), "A-b": ("s-o-a_b", False, True), "x": ("s-o-x", True, False),
    }


def test_rule_and_announcement(spark):
    src = spark.createDataFrame([("a", D1, 1, b"x"), ("b", D1, 0, b"")], LISTING + ", content binary")
    tgt = listing(spark, [("z", D1)])
    plan = cp.copy_plan(src.select("object_key"), src, tgt, rule=F.octet_length("content") > 0)
    assert {r.object_key: r.reason for r in plan.collect()} == {"a": "created", "b": "schema rule not met"}
    assert [r.event.asDict() for r in announce(plan, "t", "aws").collect()] == [
        {"sourceType": "S3", "storageContainer": "t", "path": "a"}
    ]


def test_attach_content(spark):
    events = spark.createDataFrame([("a",), ("gone",)], "path string")
    objects = spark.createDataFrame([("a", b"xyz")], "object_key string, content binary")
    got = {r.path: (r.found, r.valid, r.length) for r in cp.attach_content(events, objects).collect()}
    assert got == {"a": (True, True, 3), "gone": (False, None, None)}


def test_two_stage_flows(spark):
    src = listing(spark, [("Data/My-File.csv", D2), ("old.csv", D1)])
    staging = listing(spark, [("old.csv", D2)])
    none = listing(spark, [("z", D1)])
    kw = dict(staging_container="m", target_container="t", provider="azure", copied_at=F.lit(D2))
    made = producer_flow(src, staging, none, schema="NaturalGas", org="Mole", **kw).collect()
    assert [r.event.path for r in made] == ["naturalgas-mole-data/my_file.csv"] and made[0].event.sourceType == "AZURE"
    kept = consumer_flow(src, staging, none, **kw).collect()
    assert [r.event.path for r in kept] == ["Data/My-File.csv"]
    messages = first_stage(src, staging, "m", "azure")
    assert second_stage(messages, src, none, "azure").count() == 1


@pytest.fixture
def container(tmp_path):
    src = tmp_path / "src"
    for name, text in {"d/a.txt": b"alpha", "d/b.txt": b"beta" * 1000, "c.txt": b""}.items():
        (src / name).parent.mkdir(parents=True, exist_ok=True)
        (src / name).write_bytes(text)
        os.utime(src / name, (1_700_000_000, 1_700_000_000))
    return tmp_path


def test_listings_agree(spark, container):
    root = str(container / "src")
    a = ob.list_data_files(spark, root).orderBy("object_key").collect()
    b = ob.list_objects(spark, f"file:{root}").orderBy("object_key").collect()
    c = ob.list_objects(spark, root).orderBy("object_key").collect()
    assert [r.object_key for r in b] == ["c.txt", "d/a.txt", "d/b.txt"] and b == c
    assert [tuple(r) for r in a] == [tuple(r) for r in b if r.length]
    assert ob.list_objects(spark, str(container / "none"), may_be_absent=True).count() == 0
    assert ob.container(root, "gcp") is None and ob.container(root, " AWS ") == root


def test_reading(spark, container):
    root = str(container / "src")
    keys = spark.createDataFrame([("d/a.txt",), ("no.txt",), ("d/a.txt",)], "object_key string")
    assert [bytes(r.content) for r in ob.read_objects(spark, root, keys).collect()] == [b"alpha"]
    got = {r.object_key: r.content for r in ob.fetch_objects(keys, root, 2).collect()}
    assert bytes(got["d/a.txt"]) == b"alpha" and got["no.txt"] is None


def test_copy_then_skip_then_overwrite(spark, container):
    src, dst = str(container / "src"), str(container / "dst")

    def cycle(n):
        plan = cp.copy_plan_of_listing(
            ob.list_objects(spark, src), ob.list_objects(spark, dst, may_be_absent=True)
        )
        done = ob.execute_copy(plan, src, dst, str(container / f"out{n}"), 2).collect()
        return {r.object_key: r.reason.split(" (")[0] for r in done}

    assert set(cycle(1).values()) == {"created"}
    assert (container / "dst/d/b.txt").read_bytes() == b"beta" * 1000
    assert set(cycle(2).values()) == {"target up-to-date"}
    (container / "src/d/a.txt").write_bytes(b"newer")
    os.utime(container / "src/d/a.txt", (4_000_000_000, 4_000_000_000))
    assert cycle(3)["d/a.txt"] == "overwritten" and (container / "dst/d/a.txt").read_bytes() == b"newer"
    assert not list(container.glob("dst.landing*"))


def test_a_failing_object_does_not_stop_the_others(spark, container):
    src, dst = str(container / "src"), str(container / "dst")
    listed = ob.list_objects(spark, src)
    wrong = listed.withColumn("length", F.when(F.col("object_key") == "d/a.txt", 99).otherwise(F.col("length")))
    plan = cp.copy_plan_of_listing(wrong, listed.limit(0))
    got = {r.object_key: r for r in ob.execute_copy(plan, src, dst, str(container / "out"), 2).collect()}
    assert not got["d/a.txt"].copied and got["d/a.txt"].error_type == "OSError" and got["d/b.txt"].copied
    assert not (container / "dst/d/a.txt").exists()
    assert announce(spark.createDataFrame(list(got.values()), ob.RESULT), "t", "aws").count() == 2


def test_move_and_repeat(spark, container):
    src, dst = str(container / "src"), str(container / "dst")
    listed = spark.createDataFrame(ob.list_objects(spark, src).collect(), LISTING)
    asked = listed.select("object_key").unionByName(spark.sql("select 'no.txt' object_key union all select 'bad key'"))
    for n in (1, 2):  # the second round stands for a task that runs again
        got = {r.object_key: r.reason for r in ob.execute_move(asked, listed, src, dst, str(container / f"o{n}"), 2).collect()}
        assert got == {"c.txt": "moved", "d/a.txt": "moved", "d/b.txt": "moved",
                       "no.txt": "source object not found", "bad key": "unsafe object key"}
    assert not [p for p in (container / "src").rglob("*") if p.is_file()]
    assert (container / "dst/d/a.txt").read_bytes() == b"alpha"


def test_listing_leaves_nothing_out(spark, tmp_path):
    root = tmp_path / "odd"
    (root / "p/q").mkdir(parents=True)
    (root / "a/b/c").mkdir(parents=True)
    names = [".hidden", "_under", "empty", "a/b/c/deep", f"x.{'0' * 32}.part"]
    for name in names:
        (root / name).write_bytes(b"" if name == "empty" else b"x")
    assert {r.object_key: r.length for r in ob.list_objects(spark, str(root)).collect()} == {n: int(n != "empty") for n in names}
    bare = tmp_path / "bare/only/folders"
    bare.mkdir(parents=True)
    assert ob.list_objects(spark, str(tmp_path / "bare")).count() == 0
    assert ob.list_objects(spark, str(root), provider="gcp").count() == 0
    with pytest.raises(Exception, match="none"):
        ob.list_objects(spark, str(tmp_path / "none")).count()


def test_providers_are_spelled_freely(spark, container):
    listed = ob.list_objects(spark, str(container / "src"))
    for vendor, copied in (("AWS", 3), (" aws ", 3), ("Azure", 3), ("gcp", 0)):
        plan = cp.copy_plan_of_listing(listed, listed.limit(0), vendor)
        assert plan.where("copied").count() == copied
        assert plan.where(f"reason = '{cp.UNSUPPORTED}'").count() == 3 - copied


def test_moves_take_a_destination(spark, container):
    src, dst = str(container / "src"), str(container / "dst")
    listed = spark.createDataFrame(ob.list_objects(spark, src).collect(), LISTING)
    to = F.lit("one.txt")
    done = ob.execute_move(listed.select("object_key"), listed, src, dst, str(container / "o"), dest=to, vendor=" AZURE ")
    assert sorted(r.reason for r in done.collect())[-1] == "moved"
    assert [r.object_key for r in ob.list_objects(spark, dst).collect()] == ["one.txt"]
    assert ob.list_objects(spark, src).count() == 2  # what lost its destination stays
    done = ob.execute_move(listed.select("object_key"), listed, src, dst, str(container / "o2"), vendor="gcp")
    assert {r.reason for r in done.collect()} == {cp.UNSUPPORTED}
