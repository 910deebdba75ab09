"""Running many named queries (W8): counts from their progress, and restarts of those that fail.

A listener hears of every finished micro-batch and every ended query.  It adds up what a run should
report (packets read, rows behind the watermark, the ingest's counts) as a few numbers per query, and
wakes the supervisor, which starts a failed query again from its checkpoint, a bounded number of
times, while the others go on."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

Start = Callable[[], StreamingQuery]
COUNTS_SCHEMA = "query string, count string, value long"


class StreamCounts(StreamingQueryListener):
    """Totals per query: micro-batches, input rows, rows dropped behind the watermark (counted where an
    operator with state meets them) and every observed count.  A micro-batch that is run again after a
    restart counts once."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self._last: dict[str, int] = {}
        self._started, self._ended = 0, 0
        self.woken = threading.Event()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._started += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        with self._lock:
            if p.batchId <= self._last.get(name, -1):
                return
            self._last[name] = p.batchId
            own = self._totals[name]
            own["batches"] += 1
            own["input_rows"] += max(p.numInputRows, 0)
            own["late_rows"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            for row in p.observedMetrics.values():
                for count, value in row.asDict().items():
                    own[count] += value or 0

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended += 1
        self.woken.set()

    def settle(self, seconds: float = 20.0) -> None:
        """Events come a moment after the queries end: wait until all have come."""
        until = time.time() + seconds
        while time.time() < until:
            with self._lock:
                if self._ended >= self._started:
                    return
            time.sleep(0.05)

    def totals(self) -> dict[str, dict[str, int]]:
        with self._lock:
            return {name: dict(own) for name, own in self._totals.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """(query, count, value): a handful of rows per query."""
        rows = [(name, count, int(value)) for name, own in sorted(self.totals().items())
                for count, value in sorted(own.items())]
        return spark.createDataFrame(rows, COUNTS_SCHEMA)


class Supervisor:
    """Keeps named queries running.  ``starters`` start a query on its own checkpoint, so a restart goes
    on where the failed run stopped."""

    def __init__(self, starters: Mapping[str, Start], counts: StreamCounts, retries: int = 3, pause: float = 1.0):
        self.starters, self.counts, self.retries, self.pause = dict(starters), counts, retries, pause
        self.queries: dict[str, StreamingQuery] = {}
        self.restarts: dict[str, int] = defaultdict(int)
        self.failed: dict[str, str] = {}

    def start(self) -> "Supervisor":
        for name, begin in self.starters.items():
            if name not in self.queries:
                self.queries[name] = begin()
        return self

    def _look(self) -> bool:
        """Restart what failed; whether anything still runs."""
        running = False
        for name, query in list(self.queries.items()):
            if query.isActive:
                running = True
                continue
            error = query.exception()
            if error is None or name in self.failed:
                continue
            if self.restarts[name] >= self.retries:
                self.failed[name] = str(error)
                continue
            self.restarts[name] += 1
            time.sleep(self.pause)
            self.queries[name] = self.starters[name]()
            running = True
        return running

    def watch(self, timeout: float | None = None) -> None:
        """Until every query has ended, or the timeout; then stop what runs.  Raises if a query failed
        more often than it may."""
        until = None if timeout is None else time.time() + timeout
        try:
            while self._look() and (until is None or time.time() < until):
                self.counts.woken.wait(1.0 if until is None else max(0.0, min(1.0, until - time.time())))
                self.counts.woken.clear()
        finally:
            for query in self.queries.values():
                if query.isActive:
                    query.stop()
        if self.failed:
            raise RuntimeError(f"queries failed after {self.retries} restarts: {self.failed}")
