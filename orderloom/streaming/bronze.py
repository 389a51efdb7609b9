"""Raw event layer: topic to append-only bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "30 seconds"


def start_bronze(
    bodies: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream of ``Body`` text to a table every ``interval``; None drains what is there and stops.

    Each topic gets its own query and checkpoint, so several run side by side in one session.
    """
    writer = bodies.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)
