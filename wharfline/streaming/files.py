"""File cycles: what is new or changed in a container is copied and announced."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.copies import copy_plan_of_listing
from ..plans.file_flow import announce
from ..sources.objects import LISTING, execute_copy, exists, list_objects, notice_objects, stream_objects
from ..sources.topics import event_messages
from .sinks import query_id


def file_cycle(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    out: str,
    cycle: str,
    *,
    container: str,
    provider: str = "aws",
    tasks: int | None = None,
) -> DataFrame:
    """One cycle: list both sides, plan, copy, write the events; returns the results.

    A cycle that is run again under the same name goes on with its first plan,
    so it does not find its own copies. What it saw of the source stays beside its results.
    """
    listed = f"{out}/cycle={cycle}/listed"
    if not exists(spark, f"{listed}/_SUCCESS"):
        list_objects(spark, src_root, provider=provider).write.mode("overwrite").parquet(listed)
    source = spark.read.parquet(listed)
    target = list_objects(spark, dst_root, provider=provider, may_be_absent=True)
    plan = copy_plan_of_listing(source, target, provider)
    results = execute_copy(plan, src_root, dst_root, f"{out}/cycle={cycle}", tasks)
    events = event_messages(announce(results, container, provider), "mapper-topic")
    events.write.mode("overwrite").parquet(f"{out}/cycle={cycle}/events")
    return results


def has_news(noticed: DataFrame, cycle_folder: str) -> bool:
    """Whether a noticed file is one that the cycle didn't see in that state, or couldn't copy."""
    spark = noticed.sparkSession
    tried = spark.read.parquet(f"{cycle_folder}/results").where("error_type IS NULL").select("object_key")
    seen = spark.read.parquet(f"{cycle_folder}/listed").join(tried, "object_key", "left_semi")
    seen = seen.select("object_key", F.col("modified").alias("seen_at"))
    # a stream's times are whole milliseconds
    known = (noticed["object_key"] == seen["object_key"]) & (F.date_trunc("millisecond", "seen_at") >= noticed["modified"])
    return not noticed.join(seen, known, "left_anti").isEmpty()


#: Seconds between two looks at a container, at least.
LEAST_PAUSE = 1.0
_LOOKING: dict[str, threading.Lock] = defaultdict(threading.Lock)  # by folder: a look that outlives its stream is waited for


class NoticingWriter(DataStreamWriter):
    """Looks for new files before the stream starts and, unless that ends with what is there, at every interval of its trigger.

    A look that fails fails the stream: it is woken by a file without rows and raises what ``failed`` holds.
    """

    def __init__(self, stream: DataFrame, look: Callable[[], object], wake: Callable[[], object], failed: list[Exception]) -> None:
        super().__init__(stream)
        self._look, self._wake, self._failed = look, wake, failed
        self._pause: float | None = LEAST_PAUSE  # none: one look is all

    def trigger(self, **kind) -> NoticingWriter:
        super().trigger(**kind)
        self._pause = None
        if every := kind.get("processingTime"):
            interval = self._spark._jvm.org.apache.spark.sql.streaming.Trigger.ProcessingTime(every.strip())
            self._pause = max(LEAST_PAUSE, interval.intervalMs() / 1000)
        return self

    def start(self, *args, **options) -> StreamingQuery:
        fine = self._looked()
        query = super().start(*args, **options)
        if fine and self._pause is not None:
            threading.Thread(target=self._go_on, args=(query,), daemon=True).start()
        return query

    def _looked(self) -> bool:
        try:
            self._look()
        except Exception as exc:  # noqa: BLE001 - the stream raises it
            self._failed.append(exc)
            self._wake()
            return False
        return True

    def _go_on(self, query: StreamingQuery) -> None:
        due = time.monotonic() + self._pause
        while query.isActive:
            time.sleep(max(0.0, min(0.1, due - time.monotonic())))
            if time.monotonic() < due or not query.isActive:
                continue
            due = time.monotonic() + self._pause
            try:
                if not self._looked():
                    return
            except Exception:  # noqa: BLE001 - not even that can be told, so the stream ends
                query.stop()
                raise


def file_ready_stream(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    out: str,
    checkpoint: str,
    *,
    container: str,
    provider: str = "aws",
    tasks: int | None = None,
    files_per_batch: int = 100_000,
) -> DataStreamWriter:
    """A cycle whenever new files are noticed.

    The stream only says when; the cycle compares the whole containers, so it
    also finds objects that were changed in place or that the stream overlooks. Many files come in many batches, though
    the first cycle takes them all: a batch whose files the run's last cycle saw as they are needs no cycle of its own. Cycles are kept
    by the stream's own id and batch: another stream, or a new checkpoint, makes plans of its own. What was noticed is kept beside
    the checkpoint's logs, in tables; the driver holds none of it.
    """
    last: list[str] = []  # folder of this run's last cycle
    failed: list[Exception] = []  # what a look at the container raised
    seen = f"{checkpoint.rstrip('/')}/noticed"

    def look() -> None:
        with _LOOKING[seen]:
            if exists(spark, src_root):  # a container that is gone for a while holds no news
                notice_objects(spark, src_root, seen, files_per_batch)

    def wake() -> None:
        spark.createDataFrame([], LISTING).coalesce(1).write.mode("append").parquet(seen)

    def run(batch: DataFrame, batch_id: int) -> None:
        if failed:
            raise failed.pop()
        own = f"{out}/query={query_id(batch.sparkSession, checkpoint)}"
        if last and not has_news(batch, last[0]):
            return
        file_cycle(batch.sparkSession, src_root, dst_root, own, str(batch_id), container=container, provider=provider, tasks=tasks)
        last[:] = [f"{own}/cycle={batch_id}"]

    noticed = stream_objects(spark, src_root, seen, files_per_batch)
    return NoticingWriter(noticed, look, wake, failed).foreachBatch(run).option("checkpointLocation", checkpoint)
