"""Late rows of a whole streaming run.

A query's ``recentProgress`` holds its last hundred batches only. A listener sees every batch, so its
count is that of the whole run, however many batches there were.
"""

from __future__ import annotations

import threading
import time
from contextlib import contextmanager
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRowCounter(StreamingQueryListener):
    """Rows dropped by the watermark, per query, over all batches since the listener was added.

    Every stateful operator of a query drops the same late row, so a batch counts by its largest
    operator: single readings where the query holds a join (:func:`detect_stream`), and rows already
    combined per group in the map tasks where it only aggregates. A batch that is reported again
    replaces its own report. Per query a total and the last batch are held, however many there were.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, int] = {}
        self._last: dict[str, tuple[int, int]] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = max((int(op.numRowsDroppedByWatermark or 0) for op in progress.stateOperators), default=0)
        query = str(progress.id)
        with self._lock:
            batch, before = self._last.get(query, (-1, 0))
            if batch == progress.batchId:
                # Progress without new data repeats the batch number with a count of its own.
                late = max(late, before)
                self._totals[query] -= before
            self._totals[query] = self._totals.get(query, 0) + late
            self._last[query] = (progress.batchId, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def total(self, query: StreamingQuery, wait_seconds: float = 30.0) -> int:
        """Late rows of ``query`` so far. Events arrive behind the query's own thread, so of a run
        that has ended the last one is waited for."""
        until = time.monotonic() + wait_seconds
        while not query.isActive and time.monotonic() < until:
            with self._lock:
                if str(query.runId) in self._ended:
                    break
            time.sleep(0.02)
        with self._lock:
            return self._totals.get(str(query.id), 0)


@contextmanager
def counting_late_rows(spark: SparkSession) -> Iterator[LateRowCounter]:
    """A counter that listens to the session's queries inside the ``with`` block."""
    counter = LateRowCounter()
    spark.streams.addListener(counter)
    try:
        yield counter
    finally:
        spark.streams.removeListener(counter)
