"""Rows and duration of every micro-batch, as Spark reports them, in the record of operations."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillcast.operators.history import Operations

MICRO_BATCH = "micro_batch"


class ProgressLog(StreamingQueryListener):
    """Gathers the progress of the queries it watches; ``flush`` puts on record what there is.

    Spark reports from a thread of its own, which shouldn't wait for jobs, so the records are written
    by the caller: after a query's end, or now and then while it runs. What a micro-batch that is
    given again reports is one more record, as it is one more attempt.
    """

    def __init__(self, spark: SparkSession, operations: Operations):
        self.spark = spark
        self.operations = operations
        self._lock = threading.Lock()
        self._names: dict[str, str] = {}
        self._ended: dict[str, threading.Event] = {}
        self._rows: list[dict[str, object]] = []
        spark.streams.addListener(self)

    def watch(self, query: StreamingQuery, name: str) -> StreamingQuery:
        with self._lock:
            self._names[str(query.runId)] = name
        return query

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seconds = progress.batchDuration / 1000
        row = {
            "run": str(progress.runId),
            "batch": progress.batchId,
            "timestamp": datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
            "operation": MICRO_BATCH,
            "status": "success",
            "duration_seconds": seconds,
            "input_rows": progress.numInputRows,
        }
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.setdefault(str(event.runId), threading.Event()).set()

    def flush(self, ended: StreamingQuery | None = None, seconds: float = 30.0) -> int:
        """Write what was reported of watched queries; of an ended query wait for the last report."""
        if ended is not None:
            with self._lock:
                done = self._ended.setdefault(str(ended.runId), threading.Event())
            done.wait(seconds)
        with self._lock:
            told = [r for r in self._rows if r["run"] in self._names]
            self._rows = [r for r in self._rows if r["run"] not in self._names]
            rows = [{**r, "run_id": f"{self._names[r['run']]}-{r['batch']}"} for r in told]
        self.operations.append(rows)
        return len(rows)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
