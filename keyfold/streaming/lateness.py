"""Streams that must not lose a row: count what the watermark drops, over the whole run."""

from __future__ import annotations

import threading
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Seconds to wait for a query's last reports once it has ended.
_LAST_REPORTS = 60


class LateRowGuard(StreamingQueryListener):
    """Stops a watched query at its first report of late rows, and fails it.

    A query's own progress keeps only its last reports, so a long run must be listened to.
    Rows are counted per run of a query, from every report of every stateful step.

    Usage::

        with LateRowGuard(spark) as guard:
            query = guard.watch(writer.start())
            guard.finish(query)

    A micro-batch that dropped rows has been committed when its report comes: the guard
    keeps the loss from going on and from going unseen; a run from the last good
    checkpoint with a larger ``lateness`` repairs it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._watched: dict[str, StreamingQuery] = {}
        self._dropped: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> LateRowGuard:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: Any) -> None:
        self._spark.streams.removeListener(self)

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        """Guard a query; reports that came before this call count."""
        run = str(query.runId)
        with self._lock:
            self._watched[run] = query
            late = self._dropped.get(run, 0)
        if late:
            self._stop(query)
        return query

    def dropped(self, query: StreamingQuery) -> int:
        """Rows the query has dropped in this run, by the reports that have come."""
        with self._lock:
            return self._dropped.get(str(query.runId), 0)

    def finish(self, query: StreamingQuery, timeout: float | None = None) -> None:
        """Wait for the query's end and its last report; raise if any row was late."""
        ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
        if ended is False:
            raise TimeoutError(f"the query still runs after {timeout} s")
        self._end(str(query.runId)).wait(_LAST_REPORTS)
        late = self.dropped(query)
        if late:
            raise RuntimeError(f"{late} late events were dropped; raise the lateness")

    # Spark's entry points

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        late = sum(step.numRowsDroppedByWatermark for step in event.progress.stateOperators)
        if not late:
            return
        run = str(event.progress.runId)
        with self._lock:
            self._dropped[run] = self._dropped.get(run, 0) + late
            query = self._watched.get(run)
        if query is not None:
            self._stop(query)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    @staticmethod
    def _stop(query: StreamingQuery) -> None:
        # not on the listener's thread, which delivers the reports the stop waits for
        threading.Thread(target=query.stop, daemon=True).start()
