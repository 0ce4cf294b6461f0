"""Object steps whose cost must follow the objects: batches handed over, files opened by the scan, cycles of a stream."""

import os
import shutil
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wharfline.sources import objects as ob
from wharfline.streaming import files
from wharfline.streaming.files import file_ready_stream
from wharfline.streaming.runs import run_drain


@pytest.fixture
def root(tmp_path):
    src = tmp_path / "src"
    (src / "d").mkdir(parents=True)
    for n in range(12):
        (src / f"d/{n:02}.txt").write_bytes(b"x" * n)
    return src


def test_objects_are_handed_over_many_at_once(spark, root, monkeypatch):
    import pyarrow as pa

    keys = pa.RecordBatch.from_pydict({"object_key": [f"d/{n:02}.txt" for n in range(12)] + ["no.txt", None]})
    run = ob._fetch(str(root))
    whole = list(run(iter([keys])))
    assert [b.num_rows for b in whole] == [14]
    assert [None if c is None else len(c) for c in whole[0].column("content").to_pylist()] == [*range(12), None, None]
    monkeypatch.setattr(ob, "FETCH_BYTES", 11)
    cut = list(run(iter([keys])))
    assert max(sum(len(c or b"") for c in b.column("content").to_pylist()) for b in cut) <= 11
    assert pa.Table.from_batches(cut).to_pylist() == pa.Table.from_batches(whole).to_pylist()


def test_tasks_of_grouped_keys_are_kept(spark, root):
    """As many tasks as there are shuffle partitions were merged into one."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ob.list_objects(spark, str(root)).select("object_key")
    for read in (ob.fetch_objects, ob.inspect_objects):
        got = read(keys, str(root), tasks)
        assert got.rdd.getNumPartitions() == tasks and got.count() == 12


def test_scan_names_what_spark_names(spark, root):
    for name in (".a", "_b", "_c=1", "_metadata", "_metadata_x/y", "c._COPYING_", "d e+%20f.txt", ".h/x", "_h/x", "_p=1/x"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root))
    plain = files.select(ob.object_key(str(root)).alias("object_key"), F.col("modificationTime").alias("modified"), "length", "content")
    scan = ob.read_objects(spark, str(root))
    assert scan.columns == plain.columns and sorted(scan.collect()) == sorted(plain.collect())
    assert not [f for f in scan.inputFiles() if f.endswith(".txt")]  # the driver names no object
    os.remove(root / "d/05.txt")
    with pytest.raises(Exception, match="gone"):
        scan.collect()


def test_one_cycle_takes_all_batches_of_files(spark, root, tmp_path):
    src, dst, out = str(root), str(tmp_path / "dst"), tmp_path / "out"

    def drain():
        run_drain(file_ready_stream(spark, src, dst, str(out), str(tmp_path / "checkpoint"), container="t", files_per_batch=3))
        return len(list(out.glob("query=*/cycle=*/events")))

    assert drain() == 1
    assert {r.object_key for r in ob.list_objects(spark, dst).collect()} == {f"d/{n:02}.txt" for n in range(12)}
    (root / "new").write_bytes(b"n")
    os.utime(root / "d/07.txt", (4_000_000_000, 4_000_000_000))
    assert drain() == 2
    assert (tmp_path / "dst/new").read_bytes() == b"n"
    done = spark.read.parquet(f"{out}/query=*/cycle=*/results").where("copied")
    assert done.count() == 14 and done.where("object_key = 'd/07.txt'").count() == 2


def test_the_driver_names_no_noticed_file(spark, root, tmp_path):
    """The stream's own source, and so the driver, kept every object; now it keeps one file for a batch of them."""
    src, seen, checkpoint = str(root), str(tmp_path / "checkpoint/noticed"), tmp_path / "checkpoint"
    (root / "d/.hidden").write_bytes(b"h")
    (root / "_p/x").mkdir(parents=True)
    (root / "_p/x/y").write_bytes(b"h")
    got = []

    def drain():
        writer = file_ready_stream(spark, src, str(tmp_path / "dst"), str(tmp_path / "out"), str(checkpoint), container="t", files_per_batch=4)
        batches = []
        writer.foreachBatch(lambda batch, n: batches.append(batch.collect()))
        run_drain(writer)
        got.append(batches)

    for _ in range(2):
        drain()
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src).select(ob.object_key(src).alias("object_key"), F.col("modificationTime").alias("modified"), "length")
    assert sorted(r for batch in got[0] for r in batch) == sorted(plain.collect())
    assert max(map(len, got[0])) <= 4 and len(got[0]) >= 3 and not got[1]
    logs = "".join(f.read_text() for f in (checkpoint / "sources/0").iterdir() if f.is_file() and not f.name.startswith("."))
    assert seen in logs and src + "/" not in logs
    (root / "d/03.txt").unlink()
    for n in (20, 21):
        (root / f"d/{n}.txt").write_bytes(b"x")
    assert ob.notice_objects(spark, src, seen) == 2
    (root / "d/20.txt").unlink()  # what is gone again is no news
    drain()
    assert [r.object_key for batch in got[2] for r in batch] == ["d/21.txt"]


def test_a_stream_that_goes_on_looks_again(spark, root, tmp_path, monkeypatch):
    src, out = str(root), tmp_path / "out"
    writer = file_ready_stream(spark, src, str(tmp_path / "dst"), str(out), str(tmp_path / "checkpoint"), container="t")
    query = writer.trigger(processingTime="1 second").start()

    def until(done):
        for _ in range(600):
            if done() or not query.isActive:
                break
            time.sleep(0.1)
        assert done()

    try:
        until((tmp_path / "dst/d/11.txt").exists)
        (root / "late").write_bytes(b"late")
        until((tmp_path / "dst/late").exists)
        shutil.move(root, tmp_path / "away")  # gone for a while, it holds no news
        assert not query.awaitTermination(4)
        shutil.move(tmp_path / "away", root)
        (root / "later").write_bytes(b"later")
        until((tmp_path / "dst/later").exists)

        def broken(*_):
            raise OSError("no answer")

        monkeypatch.setattr(files, "notice_objects", broken)
        with pytest.raises(StreamingQueryException, match="no answer"):
            query.awaitTermination(60)
    finally:
        query.stop()
    shutil.move(root, tmp_path / "away")
    with pytest.raises(FileNotFoundError):
        file_ready_stream(spark, src, str(tmp_path / "dst"), str(out), str(tmp_path / "checkpoint"), container="t")
