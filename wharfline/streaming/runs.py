"""Run modes of a stage. Progress is kept in the checkpoint, whatever the mode."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from ..operators.batches import DRAIN_IDLE_SECS


def run_drain(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Handle all that is there, then end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return query


def run_window(writer: DataStreamWriter, secs: float = 600, poll: str = "1 second") -> StreamingQuery:
    """Run for a time box, then stop once the batch at hand is through.

    A batch that begins between the last look and the stop is broken off; its checkpoint makes the next run repeat it.
    """
    query = writer.trigger(processingTime=poll).start()
    if not query.awaitTermination(secs):
        while query.isActive and query.status["isTriggerActive"]:
            time.sleep(0.05)
        query.stop()
    return query


def run_until_idle(
    writer: DataStreamWriter,
    idle_secs: float = DRAIN_IDLE_SECS,
    poll: str = "1 second",
    handled: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Run until nothing was handled for ``idle_secs``, as the progress records tell it.

    The clock starts with the query and again at the end of every batch that had rows. ``handled`` names an observed total
    (``observed``); then only batches where it is above 0 set the clock back. A batch at hand is always waited for; one that
    begins in the moment of the stop is broken off and comes again in the next run. A failure of the query is raised.
    """
    query = writer.trigger(processingTime=poll).start()
    last, seen = time.monotonic(), -1
    while not query.awaitTermination(0.1):
        # the status comes first: a batch that ends after it is counted in the next round
        busy = query.status["isTriggerActive"]
        progress = [p for p in query.recentProgress if p.batchId > seen]
        if any(_rows(p, handled) for p in progress):
            last = time.monotonic()
        # idle triggers repeat the number of the batch to come
        seen = max([seen, *(p.batchId for p in progress if p.numInputRows)])
        if not busy and time.monotonic() - last >= idle_secs:
            query.stop()
            break
    return query


def _rows(progress: StreamingQueryProgress, handled: tuple[str, str] | None) -> int:
    if handled is None:
        return progress.numInputRows
    totals = progress.observedMetrics.get(handled[0])
    return totals[handled[1]] if totals and progress.numInputRows else 0


def run_interval(writer: DataStreamWriter, secs: int) -> StreamingQuery:
    """A cycle every ``secs`` seconds, the first one at once. Returns the running query."""
    return writer.trigger(processingTime=f"{secs} seconds").start()


def run_forever(
    make_writer: Callable[[], DataStreamWriter],
    retry_secs: float = 5,
    keep_going: Callable[[int], bool] = lambda failures: True,
) -> int:
    """Restart the same query from its checkpoint after each failure.

    ``keep_going`` gets the number of failures so far and may end the loop.
    Returns that number when the query ends without an error.
    """
    failures = 0
    while True:
        try:
            make_writer().start().awaitTermination()
            return failures
        except StreamingQueryException:
            failures += 1
            if not keep_going(failures):
                raise
            time.sleep(retry_secs)
