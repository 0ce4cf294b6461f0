"""Object containers: listing, reading, copying and moving.

Listing, fetching and copying run in the executors: each task works on its share
of the prefixes, keys or plan through the file-system layer of Arrow, which also
covers S3, GCS, ABFS and HDFS.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.objects import is_safe_key
from ..operators.copies import NOT_FOUND, UNSUPPORTED
from ..session import run_folder

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def object_key(root: str) -> Column:
    """Object key: the part of the file's path below the root."""
    below = re.sub(r"^[a-z][a-z0-9+.\-]*:(//[^/]*)?", "", root.rstrip("/")) + "/"
    return F.substring(
        F.col("path"), F.instr(F.col("path"), below) + F.lit(len(below)), F.length("path")
    )


def container(root: str, provider: str | None = None) -> str | None:
    """The root when the provider is supported, else nothing to list."""
    known = provider is None or provider.strip().lower() in NOT_FOUND
    return root if known else None


def qualified(spark: SparkSession, root: str) -> str:
    """The root with its store's name, as the session resolves it; tasks then open the same store."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(root)
    return where.getFileSystem(conf).makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, by the file system the session uses for it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run's own, if it is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


LISTED = pa.schema(
    [("object_key", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("is_prefix", pa.bool_())]
)
LISTING = "object_key string, modified timestamp, length bigint"


def _walk(root: str):
    """Task function: what lies directly below each of the given prefixes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        for batch in batches:
            for prefix in batch.column("object_key").to_pylist():
                # a prefix may go between two levels
                found = store.get_file_info(pafs.FileSelector(f"{base}/{prefix}".rstrip("/"), allow_not_found=bool(prefix)))
                for start in range(0, max(len(found), 1), 10_000):
                    some = found[start : start + 10_000]
                    columns = [
                        [i.path[len(base) + 1 :] for i in some],
                        [i.mtime_ns // 1000 if i.mtime_ns else None for i in some],
                        [i.size if i.type == pafs.FileType.File else None for i in some],
                        [i.type == pafs.FileType.Directory for i in some],
                    ]
                    typed = [pa.array(c, f.type) for c, f in zip(columns, LISTED)]
                    yield pa.RecordBatch.from_arrays(typed, schema=LISTED)

    return rows


def list_objects(
    spark: SparkSession, root: str, *, provider: str | None = None, may_be_absent: bool = False
) -> DataFrame:
    """All objects of a container with time and length: empty and hidden ones too, nothing is left out.

    The executors list level by level: each folder is opened once, by one task, and its
    row count alone tells whether there is a further level. Every level is written to the shared
    folder, so all readers of the listing see one state of a container that goes on changing. A
    target that nothing was copied to yet may be absent and is then empty, as is the container
    of an unsupported provider.
    """
    nothing = spark.createDataFrame([], LISTING)
    if container(root, provider) is None or (may_be_absent and not exists(spark, root)):
        return nothing
    return _listed(spark, root, run_folder(spark, "listing"))


def _listed(spark: SparkSession, root: str, out: str) -> DataFrame:
    """The objects of a container, from a listing written to the folder ``out``."""
    where = qualified(spark, root)
    schema = f"{LISTING}, is_prefix boolean"
    prefixes, level = spark.range(1, numPartitions=1).select(F.lit("").alias("object_key")), 0
    while True:
        prefixes.mapInArrow(_walk(where), schema).write.parquet(f"{out}/level={level}")
        below = spark.read.schema(schema).parquet(f"{out}/level={level}").where("is_prefix").select("object_key")
        n = below.count()
        if not n:
            break
        # a folder is a call to the store, however many bytes its name has
        prefixes, level = below.repartition(min(n, 16 * spark.sparkContext.defaultParallelism)), level + 1
    return spark.read.schema(schema).parquet(f"{out}/level=*").where("not is_prefix").drop("is_prefix")


def list_data_files(spark: SparkSession, root: str) -> DataFrame:
    """The same by Spark's file index: quick for small containers.

    That index leaves out empty files and names that begin with a dot or underscore.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(object_key(root).alias("object_key"), F.col("modificationTime").alias("modified"), "length")
    )


def notice_objects(spark: SparkSession, root: str, noticed: str, files_per_batch: int = 100_000) -> int:
    """Write the data files that the folder ``noticed`` doesn't name yet to it, at most so many in one file; how many they are.

    The executors list the container and compare the names; the driver holds no list of files.
    """
    make_folder(spark, noticed)
    listing = run_folder(spark, "noticing")
    try:
        found = _listed(spark, root, listing).where(_is_data(F.col("object_key")))
        news = found.join(spark.read.schema(LISTING).parquet(noticed).select("object_key"), "object_key", "left_anti")
        n = news.count()
        if n:
            dealt = news.select("object_key", "modified", "length").repartition(-(-n // files_per_batch))
            dealt.write.mode("append").option("maxRecordsPerFile", files_per_batch).parquet(noticed)
        return n
    finally:
        remove(spark, listing)


def stream_objects(spark: SparkSession, root: str, noticed: str, files_per_batch: int = 100_000) -> DataFrame:
    """New data files as a stream: each comes once, in the batch it is noticed in, as :func:`notice_objects` wrote them to ``noticed``.

    The tasks look each of them up again, so a file comes with the time and length it has by then; what is gone again is no news.
    The stream's own source knows the files of ``noticed`` alone, one for ``files_per_batch`` objects. Files that were noticed at once come in no given order.
    """
    if not exists(spark, root):
        raise FileNotFoundError(f"no container to watch: {root}")
    make_folder(spark, noticed)
    named = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).parquet(noticed).select("object_key")
    return named.repartition(-(-files_per_batch // TASK_OBJECTS)).mapInArrow(_look_up(qualified(spark, root)), LISTING)


def _look_up(root: str):
    """Task function: time, in whole milliseconds, and length of the given objects; none of those that are gone or empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        schema = pa.schema([LISTED.field(n) for n in ("object_key", "modified", "length")])
        for batch in batches:
            keys = batch.column("object_key").to_pylist()
            seen = [(k, i.mtime_ns // 1_000_000 * 1000 if i.mtime_ns else None, i.size) for k, i in zip(keys, store.get_file_info([f"{base}/{k}" for k in keys])) if i.size]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*seen) if seen else ((), (), ()), schema)], schema=schema)

    return rows


def _is_data(key: Column) -> Column:
    """Whether Spark's file index would name the object: no part of its name begins with a dot or underscore."""
    copying = r"(?!_metadata|_common_metadata)[^/]*\._COPYING_"
    folder = rf"(^|/)(\.[^/]*|(?!_metadata|_common_metadata)_[^=/]*|{copying})/"
    return ~key.rlike(folder) & ~key.rlike(rf"(^|/)(\.[^/]*|_[^=/]*|{copying})\z")


def read_objects(spark: SparkSession, root: str, keys: DataFrame | None = None) -> DataFrame:
    """Objects with their bytes; with ``keys`` only the requested ones.

    Empty and hidden files are left out; for every kind of object, use :func:`fetch_objects`. The executors list
    the container and read what is left in tasks of many objects; the driver holds no list of files.
    """
    listed = list_objects(spark, root).where((F.col("length") > 0) & _is_data(F.col("object_key")))
    if keys is not None:
        listed = listed.join(keys.select("object_key").distinct(), "object_key", "left_semi")
    dealt = _dealt(listed, sized_tasks(listed)).withColumn("modified", F.date_trunc("millisecond", "modified"))
    read = dealt.mapInArrow(_fetch(qualified(spark, root)), FILES.replace("path ", "object_key ").replace("modificationTime ", "modified "))
    gone = F.raise_error(F.concat(F.lit("object is gone since it was listed: "), "object_key"))
    return read.withColumn("content", F.coalesce("content", gone.cast("binary")))


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and base path of a root. ``file:/x`` is a local path too."""
    text = re.sub(r"^file:/+", "/", root).replace("s3a://", "s3://").rstrip("/")
    if text.startswith("/"):
        return pafs.LocalFileSystem(), text
    store, base = pafs.FileSystem.from_uri(text)
    return store, base.rstrip("/")


#: Bytes and objects a task is meant to move.
TASK_BYTES, TASK_OBJECTS = 256 << 20, 5_000


def sized_tasks(rows: DataFrame, length: str = "length") -> int:
    """Tasks for that many bytes and objects; an object of unknown length counts as one."""
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()
    return max(1, -(-n // TASK_OBJECTS), -(-int(size) // TASK_BYTES))


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows in so many tasks. Dealt by the bare key, rows that were grouped by it just before would keep that grouping's few tasks."""
    return rows.repartition(tasks, F.xxhash64("object_key"))


def fetch_objects(keys: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Bytes of the requested objects, read by the tasks; null content where one is missing.

    With a ``length`` column the tasks follow the bytes, else the number of keys, unless ``tasks`` is given.
    """
    spark = keys.sparkSession
    size = F.max("length") if "length" in keys.columns else F.lit(None).cast("bigint")
    wanted = keys.groupBy("object_key").agg(size.alias("length"))
    wanted = _dealt(wanted, tasks or sized_tasks(wanted)).select("object_key")
    return wanted.mapInArrow(_fetch(qualified(spark, root)), "object_key string, content binary")


#: Objects and bytes that a task hands over at once; a larger object goes alone.
FETCH_OBJECTS, FETCH_BYTES = 1_000, 16 << 20


def _fetch(root: str):
    """Task function: the given rows and the bytes of their objects, in batches bounded by rows and bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        for batch in batches:
            start, held, size = 0, [], 0

            def given(upto: int) -> pa.RecordBatch:
                columns = [*batch.slice(start, upto - start).columns, pa.array(held, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "content"])

            for at, key in enumerate(batch.column("object_key").to_pylist()):
                info = store.get_file_info(f"{base}/{key}")
                is_file = info.type == pafs.FileType.File
                if held and (len(held) == FETCH_OBJECTS or size + (info.size or 0) > FETCH_BYTES):
                    yield given(at)
                    start, held, size = at, [], 0
                content = None
                if is_file:
                    with store.open_input_stream(info.path) as stream:
                        content = stream.read()
                held.append(content)
                size += len(content or b"")
            if held:
                yield given(batch.num_rows)

    return rows


INSPECTED = (
    "object_key string, found boolean, modified timestamp, length bigint, head binary, tail binary, "
    "content_hash string, error_type string, error_message string"
)
#: Bytes that are read at a time.
CHUNK = 16 << 20


def inspect_objects(keys: DataFrame, root: str, tasks: int | None = None, *, head: int = 1 << 16, tail: int = 1 << 12) -> DataFrame:
    """What a rule may ask of each requested object, without holding an object whole.

    An object is read once, a piece at a time: its first and last bytes, its length and its MD5. So an object of any
    size can be gated by a header line, a footer or its hash. A missing object has ``found`` = false; one that can't
    be read has the error instead. Requests for one key are one row.
    """
    spark = keys.sparkSession
    wanted = keys.select("object_key").where("object_key IS NOT NULL").distinct()
    wanted = _dealt(wanted, tasks or sized_tasks(wanted.withColumn("length", F.lit(None).cast("bigint"))))
    where = qualified(spark, root)

    def look(store: pafs.FileSystem, path: str) -> dict:
        info = store.get_file_info(path)
        if info.type != pafs.FileType.File:
            return {"found": False}
        first, last, size, md5 = b"", b"", 0, hashlib.md5(usedforsecurity=False)
        with store.open_input_stream(path) as stream:
            while chunk := stream.read(CHUNK):
                md5.update(chunk)
                size += len(chunk)
                if len(first) < head:
                    first += chunk[: head - len(first)]
                last = (last + chunk[-tail:])[-tail:]
        return {"found": True, "modified": info.mtime, "length": size, "head": first, "tail": last, "content_hash": md5.hexdigest()}

    schema = pa.schema(
        [
            ("object_key", pa.string()), ("found", pa.bool_()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("head", pa.binary()),
            ("tail", pa.binary()), ("content_hash", pa.string()), ("error_type", pa.string()), ("error_message", pa.string()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(where)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = []
                for key in batch.column("object_key").slice(start, 200).to_pylist():
                    try:
                        seen = look(store, f"{base}/{key}")
                    except Exception as exc:  # noqa: BLE001 - one object never stops the rest
                        seen = {"found": False, "error_type": type(exc).__name__, "error_message": str(exc)}
                    out.append({"object_key": key, **seen})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return wanted.mapInArrow(rows, INSPECTED)


def write_objects(rows: DataFrame, root: str) -> DataFrame:
    """Write ``content`` under ``object_key`` below the root; key and length of what was written, once it is asked for.

    A task that runs again writes the same bytes under the same names.
    """
    where = qualified(rows.sparkSession, root)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(where)
        for pdf in parts:
            for folder in {k.rpartition("/")[0] for k in pdf["object_key"]}:
                store.create_dir(f"{base}/{folder}", recursive=True)
            for key, content in zip(pdf["object_key"], pdf["content"]):
                with store.open_output_stream(f"{base}/{key}") as stream:
                    stream.write(content)
            yield pd.DataFrame({"object_key": pdf["object_key"], "length": [len(c) for c in pdf["content"]]})

    return rows.select("object_key", "content").mapInPandas(run, "object_key string, length bigint")


def make_folder(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).mkdirs(where)


#: A store copies by itself up to so many bytes in one call.
STORE_COPY_BYTES = 5 * 10**9
#: Folders that a task remembers having made.
FOLDERS_KEPT = 10_000


def _copy_one(
    src: pafs.FileSystem, src_path: str, dst: pafs.FileSystem, dst_path: str, length: int | None, landing_root: str, made: set[str]
) -> None:
    """Copy by way of a landing folder, so readers never see a part and repeats are harmless.

    An S3 object appears whole, it needs no landing. Whatever fails, nothing stays in the landing folder.
    ``made`` are the folders that this task made already.
    """
    by_rename = not isinstance(dst, pafs.S3FileSystem)
    landing = f"{landing_root}/{uuid.uuid4().hex}" if by_rename else dst_path
    if by_rename:
        for folder in (landing_root, dst_path.rsplit("/", 1)[0]):
            if folder not in made:
                dst.create_dir(folder, recursive=True)
                if len(made) >= FOLDERS_KEPT:
                    made.clear()
                made.add(folder)
    try:
        if src.equals(dst) and (by_rename or (length is not None and length <= STORE_COPY_BYTES)):
            dst.copy_file(src_path, landing)
        else:
            with src.open_input_stream(src_path) as read, dst.open_output_stream(landing) as write:
                while chunk := read.read(16 << 20):
                    write.write(chunk)
        size = dst.get_file_info(landing).size
        if length is not None and size != length:
            raise OSError(f"copied {size} bytes of {length}")
        if by_rename:
            dst.move(landing, dst_path)
    except BaseException:
        if by_rename and dst.get_file_info(landing).type == pafs.FileType.File:
            dst.delete_file(landing)
        raise


RESULT = (
    "object_key string, dest_key string, requests bigint, length bigint, copied boolean, "
    "skipped boolean, reason string, error_type string, error_message string"
)


def _run(work: DataFrame, src_root: str, dst_root: str, landing: str, delete_source: bool) -> DataFrame:
    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        src, src_base = _open(src_root)
        dst, dst_base = _open(dst_root)
        # a landing folder for each task: tasks don't queue for one folder's entries
        landing_root, made = f"{_open(landing)[1]}/{uuid.uuid4().hex}", set()
        for pdf in parts:
            copied, kinds, texts = [], [], []
            for key, dest, length in zip(pdf["object_key"], pdf["dest_key"], pdf["length"]):
                kind = text = None
                size = None if pd.isna(length) else int(length)
                from_path, to_path = f"{src_base}/{key}", f"{dst_base}/{dest}"
                try:
                    gone = delete_source and src.get_file_info(from_path).type == pafs.FileType.NotFound
                    if gone and dst.get_file_info(to_path).size == size:
                        pass  # an earlier attempt of this task finished the move
                    else:
                        _copy_one(src, from_path, dst, to_path, size, landing_root, made)
                        if delete_source:
                            src.delete_file(from_path)
                except Exception as exc:  # noqa: BLE001 - one object never stops the rest
                    kind, text = type(exc).__name__, str(exc)
                copied.append(kind is None)
                kinds.append(kind)
                texts.append(text)
            reason = [r if k is None else "failed" for r, k in zip(pdf["reason"], kinds)]
            yield pdf.assign(copied=copied, reason=reason, error_type=kinds, error_message=texts)

    return work.mapInPandas(rows, RESULT)


def _columns(plan: DataFrame) -> DataFrame:
    return plan.select(
        "object_key", "dest_key", "requests", F.col("src_length").alias("length"), "copied", "skipped", "reason"
    )


def _fix(work: DataFrame, out: str) -> DataFrame:
    """Write what is to be done before anything is done, and work from that.

    Bytes that move change the listings the work was derived from. A task that is
    repeated, or a run that is resumed in the same folder, must not see that.
    """
    spark, planned = work.sparkSession, f"{out}/plan"
    if not exists(spark, f"{planned}/_SUCCESS"):
        work.write.mode("overwrite").parquet(planned)
    return spark.read.parquet(planned)


def _finish(work: DataFrame, src_root: str, dst_root: str, out: str, tasks: int | None, delete_source: bool) -> DataFrame:
    spark = work.sparkSession
    fixed = _fix(work, out)
    due = fixed.where("copied")
    source, target = qualified(spark, src_root), qualified(spark, dst_root)
    landing = f"{target.rstrip('/')}.landing-{uuid.uuid4().hex[:12]}"  # beside the container, so no listing meets it
    dealt = due.repartition(tasks or sized_tasks(due), F.xxhash64("dest_key"))
    moved = _run(dealt, source, target, landing, delete_source)
    none = F.lit(None).cast("string")
    left = fixed.where("not copied").withColumns({"error_type": none, "error_message": none})
    try:
        moved.unionByName(left).write.mode("overwrite").parquet(f"{out}/results")
    finally:
        remove(spark, landing)
    return spark.read.parquet(f"{out}/results")


def execute_copy(plan: DataFrame, src_root: str, dst_root: str, out: str, tasks: int | None = None) -> DataFrame:
    """Carry out a copy plan and return its results.

    ``out`` is a folder of this run's own: the plan is written there first, the
    results after it. The same folder again resumes the same plan. Only rows to
    be copied visit the tasks that move bytes; how many there are follows the bytes.
    """
    return _finish(_columns(plan), src_root, dst_root, out, tasks, delete_source=False)


def execute_move(
    requested: DataFrame,
    source: DataFrame,
    src_root: str,
    dst_root: str,
    out: str,
    tasks: int | None = None,
    *,
    dest: Column | None = None,
    vendor: str = "aws",
) -> DataFrame:
    """Copy each requested object to its destination, then delete its source; times do not matter.

    ``dest`` names the destination, else it is the key. Of several objects with one destination the first
    by key is moved. The source goes only after the copy's length was checked. ``out`` is as in
    :func:`execute_copy`.
    """
    provider = vendor.strip().lower()
    asked = requested.groupBy("object_key").agg(F.count(F.lit(1)).alias("requests"))
    met = asked.join(source.select("object_key", "length"), "object_key", "left")
    met = met.withColumn("dest_key", F.col("object_key") if dest is None else dest)
    found = F.col("length").isNotNull()
    safe = is_safe_key("object_key") & is_safe_key("dest_key")
    able = F.lit(provider in NOT_FOUND) & safe & found
    first = F.lit(True)
    if dest is not None:
        winners = met.where(able).groupBy("dest_key").agg(F.min("object_key").alias("winner"))
        met = met.join(winners, "dest_key", "left")
        first = F.col("winner") == F.col("object_key")
    work = met.select(
        "object_key",
        "dest_key",
        "requests",
        "length",
        F.coalesce(able & first, F.lit(False)).alias("copied"),
        F.lit(False).alias("skipped"),
        F.when(~safe, "unsafe object key")
        .when(F.lit(provider not in NOT_FOUND), UNSUPPORTED)
        .when(~found, NOT_FOUND.get(provider, ""))
        .when(~first, "destination taken by another object of this run")
        .otherwise("moved")
        .alias("reason"),
    )
    return _finish(work, src_root, dst_root, out, tasks, delete_source=True)
