"""Trusted event layer: micro-batch cleaning and idempotent sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderloom.lake import Lake
from orderloom.schemas import EVENT_SCHEMAS
from orderloom.sources import tables
from orderloom.sources.events import body_stream
from orderloom.streaming.bronze import TRIGGER
from orderloom.streaming.cleaners import CONTRACTS, clean_events, split_tagged, tag_events
from orderloom.streaming.state import Unique
from orderloom.streaming.supervise import counted, note_count


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", writer: str = "orderloom") -> None:
    """Append one micro-batch exactly once.

    ``foreachBatch`` repeats a batch after a failure. On parquet a batch owns the folder
    ``writer=<writer>/batch_id=<n>`` and overwrites it; on Delta the table itself ignores a transaction it
    has seen. ``writer`` tells streams apart that count their batches from 0, such as one that starts
    over with a new checkpoint.
    """
    if fmt == "delta":
        options = {"txnAppId": writer, "txnVersion": str(batch_id)}
        df.write.format(fmt).mode("append").options(**options).save(path)
    else:
        tables.save(df, f"{path}/writer={writer}/batch_id={batch_id}", fmt, "overwrite")


def running_query(batch: DataFrame) -> str:
    """The id of the streaming query that hands out a micro-batch; it lives as long as the checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "orderloom"


def batch_sink(
    table: str,
    path: str,
    quarantine: str | None = None,
    schema: StructType | None = None,
    fmt: str = "parquet",
    unique: Unique | None = None,
    names: tuple[str, str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function that cleans and writes one micro-batch; with ``quarantine`` rejected rows are kept too.

    With ``unique`` trusted rows that an earlier batch kept go. With ``names``, those of the trusted and the rejected table in the
    catalog, each batch makes its own folders known by name.
    """

    def written(rows: DataFrame, to: str, batch_id: int, writer: str, name: str | None) -> None:
        rows, note = counted(rows, writer, batch_id, "kept" if to == path else "rejected")
        write_batch(rows, to, batch_id, fmt, f"{writer}-{'silver' if to == path else 'quarantine'}" if fmt == "delta" else writer)
        note()
        if name and fmt != "delta":
            spark = rows.sparkSession
            if not spark.catalog.tableExists(name):
                tables.register(spark, name, to, fmt, tables.BATCH_PARTS)
            tables.add_part(spark, name, {"writer": writer, "batch_id": batch_id})

    def process(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.count()  # of files, a look at their footers
        if not arrived:
            return
        writer = running_query(batch)
        note_count(writer, batch_id, "in", arrived)
        good, bad = names or (None, None)
        if quarantine is None and unique is None:
            written(clean_events(batch, table, schema), path, batch_id, writer, good)
            return
        # Several passes follow: parse and deduplicate the batch once.
        tagged = tag_events(batch, table, schema).persist()
        try:
            valid, rejected = split_tagged(tagged)
            if unique is not None:
                valid = unique.fresh(valid, writer, batch_id)
            written(valid, path, batch_id, writer, good)
            if quarantine is not None:
                written(rejected, quarantine, batch_id, writer, bad)
            if unique is not None:
                # After the rows and from the same ones: what is remembered is there. A repeated batch doesn't meet itself.
                unique.remember(valid, writer, batch_id)
        finally:
            tagged.unpersist()

    return process


def start_silver(
    bodies: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    interval: str | None = TRIGGER,
    quarantine: str | None = None,
    schema: StructType | None = None,
    fmt: str = "parquet",
    unique: Unique | None = None,
    names: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Clean a stream of bodies into a trusted table every ``interval``; None drains and stops. For the rest see :func:`batch_sink`."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        bodies.writeStream.foreachBatch(batch_sink(table, path, quarantine, schema, fmt, unique, names))
        .queryName(f"{table}-{uuid.uuid4().hex[:8]}")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


#: Event time of each table whose payload has one, by which :func:`start_all` recognises copies.
EVENT_TIMES = {"orders": "order_purchase_timestamp"}


def start_all(
    spark: SparkSession,
    lake: Lake,
    interval: str | None = TRIGGER,
    with_quarantine: bool = False,
    schemas: Mapping[str, StructType] = EVENT_SCHEMAS,
    unique_days: int | None = None,
    prefix: str | None = None,
    only: Iterable[str] = tuple(EVENT_SCHEMAS),
) -> dict[str, StreamingQuery]:
    """One independent query per event table (of ``only`` these), from the lake's raw events to its trusted events.

    ``unique_days`` drops copies of rows that were kept before, where a table has an event time, see :class:`state.Unique`. ``prefix`` makes what is
    written queryable as ``<prefix>stream_silver.<table>`` and ``<prefix>stream_quarantine.<table>``, batch by batch.
    """
    layers = ("stream_silver", "stream_quarantine")
    if prefix is not None:
        for layer in layers:
            tables.create_schema(spark, f"{prefix}{layer}")

    def unique(table: str) -> Unique | None:
        if unique_days is None or table not in EVENT_TIMES:
            return None
        return Unique(CONTRACTS[table].key, EVENT_TIMES[table], unique_days, lake.path("stream_digest", table))

    return {
        table: start_silver(
            body_stream(spark, lake.path("stream_bronze", table), lake.fmt),
            table,
            lake.path("stream_silver", table),
            lake.checkpoint("stream_silver", table),
            interval,
            lake.path("stream_quarantine", table) if with_quarantine else None,
            schemas[table],
            lake.fmt,
            unique(table),
            None if prefix is None else tuple(f"{prefix}{layer}.{table}" for layer in layers),
        )
        for table in only
    }
