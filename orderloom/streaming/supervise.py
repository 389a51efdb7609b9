"""Streams that run side by side: what each batch did, and an orderly end when one of them fails."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

LOG_SCHEMA = (
    "event_table string, writer string, batch_id long, started timestamp, rows_in long, kept_rows long, rejected_rows long,"
    " batch_ms long, behind_ms long"
)
_counts: dict[tuple[str, int], dict[str, int]] = {}
_lock = Lock()


def note_count(writer: str, batch_id: int, side: str, n: int) -> None:
    """Note a number of rows of a micro-batch; a batch whose numbers nobody fetches makes room for newer ones."""
    with _lock:
        _counts.setdefault((writer, batch_id), {})[side] = n
        while len(_counts) > 10_000:
            _counts.pop(next(iter(_counts)))


def counted(rows: DataFrame, writer: str, batch_id: int, side: str) -> tuple[DataFrame, Callable[[], None]]:
    """rows whose number is noted while they are written, and a function that notes it afterwards. No pass of its own."""
    seen = Observation()

    def note() -> None:
        note_count(writer, batch_id, side, seen.get["rows"])

    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), note


class _Progress(StreamingQueryListener):
    """Collects progress of the session's streams; nothing here starts a job, as Spark's listeners wait for it."""

    def __init__(self):
        self.lines: list[tuple] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            with _lock:
                self.lines.append((str(p.id), p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution", 0)))
                del self.lines[:-10_000]  # of streams that nobody watches


class Log:
    """A table with one row for each micro-batch of some streams, to be made before they start: rows in, kept and rejected, how long it took, how far it is behind.

    ``behind_ms`` is the time from a batch's start until its rows were there to read, if it took longer than ``interval_ms``: what the next
    batch has to make up.
    """

    def __init__(self, spark: SparkSession, path: str, interval_ms: int = 30_000):
        self.spark, self.path, self.interval_ms = spark, path, interval_ms
        self.names: dict[str, str] = {}
        self.listener = _Progress()
        spark.streams.addListener(self.listener)

    def watch(self, queries: Mapping[str, StreamingQuery]) -> None:
        """The streams whose batches are logged, those included that they did since the log was made."""
        self.names |= {str(q.id): table for table, q in queries.items()}

    def flush(self) -> None:
        """Append what has come in since the last time."""
        with _lock:
            lines = [line for line in self.listener.lines if line[0] in self.names]
            self.listener.lines = [line for line in self.listener.lines if line[0] not in self.names]
            counts = [_counts.pop((writer, batch_id), {}) for writer, batch_id, *_ in lines]
        rows = [
            (self.names[writer], writer, batch_id, started, c.get("in", rows_in), c.get("kept"), c.get("rejected"), ms, max(0, ms - self.interval_ms))
            for (writer, batch_id, started, rows_in, ms), c in zip(lines, counts, strict=True)
        ]
        if rows:
            text = LOG_SCHEMA.replace("started timestamp", "started string")
            df = self.spark.createDataFrame(rows, text).withColumn("started", F.to_timestamp("started"))
            df.coalesce(1).write.mode("append").parquet(self.path)

    def close(self, patience: float = 5.0) -> None:
        """Wait until Spark has told of the streams' ends, which it does after their last batches, and write the rest."""
        until = time.monotonic() + patience
        while not set(self.names) <= self.listener.ended and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self.listener)
        self.flush()


def supervise(spark: SparkSession, queries: Mapping[str, StreamingQuery], log: Log | None = None, every: float = 1.0) -> None:
    """Wait until all queries have ended. When one fails the others are stopped after the batch they are in, and its error is raised.

    Its checkpoint and theirs stay as they are: starting all again goes on where each one stopped.
    """
    if log:
        log.watch(queries)
    try:
        while any(q.isActive for q in queries.values()):
            failed = next((q.exception() for q in queries.values() if not q.isActive and q.exception()), None)
            if failed:
                raise failed
            time.sleep(every)
            if log:
                log.flush()
        failed = next((q.exception() for q in queries.values() if q.exception()), None)
        if failed:
            raise failed
    finally:
        for q in queries.values():
            q.stop()
        if log:
            log.close()
