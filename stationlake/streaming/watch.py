"""Waiting for streams: until they fall quiet, end, or are asked to stop.

A stream that goes on for ever has no end to wait for. Its progress events say
when rows came last; a signal, as schedulers send it, only sets a flag that the
waiting loop reads, so that no call into Spark is cut off half way.
"""

from __future__ import annotations

import signal
import threading
import time
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_LOOK = 0.1  # seconds between two looks at the flag and the queries


class Arrivals(StreamingQueryListener):
    """What progress events say of the rows that queries take in."""

    def __init__(self, *queries: StreamingQuery):
        self.rows: Counter[str] = Counter()
        self.rows_at = time.monotonic()
        self._ids = {str(q.runId) for q in queries}
        self._batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.runId)
        if run not in self._ids:
            return
        if progress.numInputRows:
            self.rows[run] += progress.numInputRows
            self.rows_at = time.monotonic()
        self._batches[run] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def skip(self, query: StreamingQuery) -> None:
        """Batches that ended before the listener was there send no event."""
        self._batches.setdefault(str(query.runId), _last_batch(query))

    def knows(self, query: StreamingQuery) -> bool:
        """Have the events of all batches that ended arrived?"""
        return self._batches.get(str(query.runId), -1) >= _last_batch(query)


def _last_batch(query: StreamingQuery) -> int:
    last = query.lastProgress
    return last["batchId"] if last else -1


def _resting(query: StreamingQuery, arrivals: Arrivals) -> bool:
    return not query.status["isTriggerActive"] and arrivals.knows(query)


def wait(
    spark: SparkSession,
    *queries: StreamingQuery,
    quiet: float | None = None,
    stop: threading.Event | None = None,
) -> int:
    """Wait until all queries have ended, ``stop`` is set, or no query has taken
    in a row for ``quiet`` seconds; return the rows taken in meanwhile.

    A micro-batch that still runs is not quiet, however long it takes. The
    queries are left as they are: stop them with ``stop_gracefully``.
    """
    stop = stop or threading.Event()
    arrivals = Arrivals(*queries)
    spark.streams.addListener(arrivals)
    try:
        for query in queries:
            arrivals.skip(query)
        while not stop.is_set():
            running = [q for q in queries if q.isActive]
            if not running:
                break
            # Looked at before the clock: rows that come in between count.
            resting = all(_resting(q, arrivals) for q in running)
            if quiet is not None and resting and time.monotonic() - arrivals.rows_at >= quiet:
                break
            stop.wait(_LOOK)
    finally:
        spark.streams.removeListener(arrivals)
    return arrivals.rows.total()


def raise_failures(*queries: StreamingQuery) -> None:
    """Raise what ended a query, if it did not end by itself."""
    for query in queries:
        failure = query.exception()
        if failure:
            raise failure


@contextmanager
def stop_signals(
    signals: tuple[signal.Signals, ...] = (signal.SIGINT, signal.SIGTERM),
) -> Iterator[threading.Event]:
    """A flag that the given signals set, in place of what they did before. For
    the main thread, as only it can take signals."""
    stop = threading.Event()
    before = {s: signal.signal(s, lambda *_: stop.set()) for s in signals}
    try:
        yield stop
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
