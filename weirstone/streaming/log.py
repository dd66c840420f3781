"""A log of streamed loads: rows and ends of every batch, and what stopped a query."""

from __future__ import annotations

import threading
from types import TracebackType

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sinks.load_log import ERROR_STATUS
from .ingest import LOADED

STREAM_LOG_SCHEMA = "query string, load_name string, batch bigint, rows bigint, status string, ends string, message string"
DONE_STATUS = "done"


class StreamLog(StreamingQueryListener):
    """Logs the queries that are started inside its ``with`` block to a parquet folder.

    One row for each batch with rows, taken from the progress that the query
    reports, with the number of rows observed while they were written and where
    each source ended; one more for an error, with the number of the batch that
    did not come through. Nothing is read or counted again. Rows are held until
    there are ``every`` of them or the block ends, so a log has few files.
    """

    def __init__(self, spark: SparkSession, path: str, load_name: str, *, every: int = 1_000, patience: float = 60.0) -> None:
        self.spark, self.path, self.load_name = spark, path, load_name
        self.every, self.patience = every, patience
        self.rows: list[tuple] = []
        self.last: dict[str, int] = {}
        self.running: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> StreamLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        active = {str(q.id) for q in self.spark.streams.active}
        with self.changed:  # progress comes on a thread of its own, after the query has ended
            self.changed.wait_for(lambda: self.running <= active, self.patience)
        self.spark.streams.removeListener(self)
        self.flush()

    def flush(self) -> None:
        """Append what is held."""
        with self.changed:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, STREAM_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.running.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        counted = (report.observedMetrics or {}).get(LOADED)
        rows = report.numInputRows if counted is None else counted["rows"]
        with self.changed:
            if str(report.id) not in self.running:
                return
            self.last[str(report.id)] = report.batchId
            if not rows:
                return
            ends = "; ".join(f"{s.description}: {s.endOffset}" for s in report.sources)
            self.rows.append((str(report.id), self.load_name, report.batchId, rows, DONE_STATUS, ends, None))
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        """Nothing came, nothing is logged."""

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            name = str(event.id)
            if name in self.running and event.exception:
                batch = self.last[name] + 1 if name in self.last else None
                self.rows.append((name, self.load_name, batch, None, ERROR_STATUS, None, event.exception))
            self.running.discard(name)
            self.changed.notify_all()
