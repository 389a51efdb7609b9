"""One gold layer over both pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import upper_code
from orderloom.operators.dedupe import latest_per_key
from orderloom.operators.joins import join_one_per_key
from orderloom.streaming.state import COMMITTED

# Event tables, the batch table each one extends, its key, and its code columns (lower case in events).
BATCH_TABLE = {"orders": "orders", "items": "order_items", "payments": "order_payments"}
KEYS = {
    "orders": ("order_id",),
    "items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
}
CODES = {"orders": ("order_status",), "items": (), "payments": ("payment_type",)}


def as_batch_rows(events: DataFrame, table: str, batch: DataFrame) -> DataFrame:
    """Event rows in the batch table's columns, types and case. Absent columns become NULL."""
    codes: Sequence[str] = CODES[table]

    def column(field):
        if field.name not in events.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        return (upper_code(value) if field.name in codes else value).try_cast(field.dataType).alias(field.name)

    return events.select(*[column(f) for f in batch.schema.fields])


def unify(batch: DataFrame, events: DataFrame, table: str) -> DataFrame:
    """Batch rows plus those event rows whose key the batch table does not hold yet.

    The batch row wins because it carries every column; events only bridge the time until the next
    batch run. Events are first reduced to one row per key, or to distinct rows where the payload
    lacks a key column; the newest by ``committed_at`` of :func:`state.read_history`, then by batch. Of the batch table only distinct keys are compared. Where events are one
    row per key both sides lie by key already; else the events of a hot key are spread over several tasks.
    """
    keys = [k for k in KEYS[table] if k in events.columns]
    held = batch.select(*keys).distinct()
    if len(keys) == len(KEYS[table]):
        newest = latest_per_key(events, keys, [c for c in (COMMITTED, "batch_id") if c in events.columns])
        fresh = as_batch_rows(newest, table, batch).distinct().join(held, keys, "left_anti")
    else:
        fresh = join_one_per_key(as_batch_rows(events, table, batch).distinct(), held, keys, "left_anti")
    return batch.unionByName(fresh)
