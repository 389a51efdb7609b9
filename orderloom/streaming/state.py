"""Across batches: deduplication by a watermark or a digest of what was kept, newest version per key, compaction."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.dedupe import latest_per_key
from orderloom.sources import tables

COMMITTED, BUCKET = "committed_at", "bucket"
#: Parts of a compacted table; about the size of a file at the target size is a good part.
BUCKETS = 64


def dedupe_stream(
    events: DataFrame, keys: Sequence[str], event_time: str, delay: str, salts: int = 0, salt_by: Sequence[str] = ()
) -> DataFrame:
    """First event per key in a stream; duplicates are recognised while the watermark is within ``delay``.

    State grows with the keys inside the window, not with the stream; on large windows use the RocksDB
    state store. If one key is repeated without end, ``salts`` adds a first step that removes most of
    its copies in ``salts`` partitions before the step that owns the key sees the rest. The salt is a
    hash of ``salt_by``, columns that vary between the copies.
    """
    stream = events.withWatermark(event_time, delay)
    if salts:
        salted = stream.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
        stream = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return stream.dropDuplicatesWithinWatermark(list(keys))


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """An append-only table of micro-batches, and when each row was written as ``committed_at``.

    Batch numbers order the batches of one writer; a stream that starts over with a new checkpoint is another writer and counts
    from 0. Only the time tells which came later, so copies of a history must keep their files' times.
    """
    rows = spark.read.format(fmt).load(path)
    return rows.select("*", F.col("_metadata.file_modification_time").alias(COMMITTED))


def newest_versions(history: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """Upserted view of an append-only table: the newest row per key, by default by when it was written, then by batch.

    Streams only append; readers or a periodic :func:`compact` resolve versions. That keeps a
    micro-batch's cost at the size of the batch, where rewriting touched partitions of a large
    table every 30 seconds would not be.
    """
    return latest_per_key(history, keys, list(newest_by) or [c for c in (COMMITTED, "batch_id") if c in history.columns])


class Manifest(NamedTuple):
    """One state of a compacted table: the last batch of each writer that it holds, and which version each bucket is of."""

    version: int
    marks: dict[str, int]
    buckets: dict[int, int]
    count: int


def unseen(marks: Mapping[str, int]) -> Column:
    """Batches beyond the marks, in literals over the folders' own columns, so Spark lists no other folder's files."""
    writer = F.col("writer").cast("string")
    newer = [(writer == w) & (F.col("batch_id") > n) for w, n in sorted(marks.items())]
    return reduce(or_, newer, ~writer.isin(*sorted(marks)) if marks else F.lit(True))


def compact(
    spark: SparkSession, history_path: str, target_path: str, keys: Sequence[str], fmt: str = "parquet", buckets: int = BUCKETS
) -> None:
    """Bring a table of the newest row per key up to date with an append-only history.

    The table is dealt to ``buckets`` by a hash of the key. Of the history only batches beyond the table's marks are read;
    of the table only the buckets that they touch, and only those are written anew, as files of the next version. A manifest then
    names the version of every bucket and the new marks: readers of :func:`compacted` see the state before or the state
    after, and a compaction that fails leaves nothing that they see. ``buckets`` is fixed by a table's first compaction.
    """
    last = manifest(spark, target_path)
    history = read_history(spark, history_path, fmt)
    if "writer" not in history.columns:
        history = history.withColumn("writer", F.lit("orderloom"))
    fresh = history.filter(unseen(last.marks if last else {}))
    marks = {r.writer: r.batch_id for r in fresh.groupBy(F.col("writer").cast("string").alias("writer")).agg(F.max("batch_id").alias("batch_id")).collect()}
    if not marks:
        return
    count = last.count if last else buckets
    bucket = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int").alias(BUCKET)
    # a batch that arrives meanwhile is left to the next compaction
    fresh = fresh.filter(reduce(or_, [(F.col("writer").cast("string") == w) & (F.col("batch_id") <= n) for w, n in sorted(marks.items())])).select("*", bucket)
    fresh = fresh.withColumn("writer", F.col("writer").cast("string"))
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    held = [f"{target_path}/version={last.buckets[b]}/{BUCKET}={b}" for b in touched if last and b in last.buckets]
    rows = fresh
    if held:
        rows = fresh.unionByName(spark.read.format(fmt).option("basePath", target_path).load(held).drop("version"))
    version = last.version + 1 if last else 0
    newest = newest_versions(rows, [*keys, BUCKET])
    newest.repartition(BUCKET).write.format(fmt).mode("overwrite").partitionBy(BUCKET).save(f"{target_path}/version={version}")
    now = Manifest(version, {**(last.marks if last else {}), **marks}, {**(last.buckets if last else {}), **dict.fromkeys(touched, version)}, count)
    text = json.dumps(now._asdict())
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{target_path}/_manifests/{version}")


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest complete state of a compacted table: Spark's writers put ``_SUCCESS`` into a folder when they are done."""
    done = tables.matching(spark, f"{path}/_manifests/*/_SUCCESS")
    if not done:
        return None
    newest = max(int(p.rsplit("/", 2)[-2]) for p in done)
    found = json.loads(spark.read.text(f"{path}/_manifests/{newest}").first().value)
    return Manifest(found["version"], found["marks"], {int(b): v for b, v in found["buckets"].items()}, found["count"])


def compacted(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest complete state of :func:`compact`."""
    now = manifest(spark, path)
    if now is None:
        raise FileNotFoundError(f"{path} holds no complete compaction")
    return spark.read.format(fmt).load([f"{path}/version={v}/{BUCKET}={b}" for b, v in sorted(now.buckets.items())])


def retire(spark: SparkSession, path: str) -> list[str]:
    """Delete the files that the newest state doesn't hold; run it when nobody reads an older one. Returns the deleted folders."""
    now = manifest(spark, path)
    kept = {f"version={v}/{BUCKET}={b}" for b, v in now.buckets.items()} if now else set()
    gone = [p for p in tables.matching(spark, f"{path}/version=*/{BUCKET}=*") if "/".join(p.rsplit("/", 2)[-2:]) not in kept]
    for folder in gone if now else ():
        tables.delete(spark, folder)
    return gone if now else []


def key_hash(keys: Sequence[str]) -> Column:
    """128 bits of a key."""
    return F.struct(F.xxhash64(*keys).alias("a"), F.xxhash64(F.lit(1), *reversed(keys)).alias("b"))


def digest(rows: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """What remembers rows: a hash of 128 bits of their key, their time and its month. Rows without a key or a time are not remembered."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, event_time)])
    return rows.filter(known).select(key_hash(keys).alias("key"), F.col(event_time).alias("at"), F.trunc(event_time, "month").alias("month"))


class Unique(NamedTuple):
    """Keys that a stream keeps once: a row goes if one of its key was kept whose ``event_time`` is at most ``days`` from its own.

    What was kept is remembered in a digest of 128 bits and a time for each key, in folders by month below ``path``. A micro-batch reads those months alone
    that its own rows reach, so memory and reading are bounded by ``days``, not by the stream; the digest outlives checkpoints, so
    a stream that starts over still knows what was kept. Unlike a watermark it drops no row for being late.
    """

    keys: tuple[str, ...]
    event_time: str
    days: int
    path: str

    def fresh(self, rows: DataFrame, writer: str, batch_id: int) -> DataFrame:
        """The rows of a micro-batch that no batch before it kept within reach. A repeated batch doesn't meet itself."""
        spark = rows.sparkSession
        if not tables.exists(spark, self.path):
            return rows
        reach = rows.agg(F.min(F.to_date(self.event_time)).alias("first"), F.max(F.to_date(self.event_time)).alias("last")).first()
        if reach["first"] is None:
            return rows
        span = timedelta(days=self.days)
        first, last = ((d.replace(day=1)).isoformat() for d in (reach["first"] - span, reach["last"] + span))
        schema = "key struct<a: bigint, b: bigint>, at timestamp, month date, writer string, batch_id int"
        kept = spark.read.schema(schema).parquet(self.path)
        kept = kept.filter(F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        kept = kept.filter((F.col("writer") != writer) | (F.col("batch_id") < batch_id)).select(F.col("key").alias("_key"), F.col("at").alias("_kept"))
        marked = rows.withColumn("_of", key_hash(self.keys))
        near = F.abs(F.col("_kept").cast("double") - F.col(self.event_time).cast("timestamp").cast("double")) <= self.days * 86400
        return marked.join(kept, (F.col("_of") == F.col("_key")) & near, "left_anti").drop("_of")

    def remember(self, kept: DataFrame, writer: str, batch_id: int) -> None:
        """Add a micro-batch's kept rows to the digest; repeating a batch replaces its part."""
        spark, mine = kept.sparkSession, f"writer={writer}/batch_id={batch_id}"
        for folder in tables.matching(spark, f"{self.path}/month=*/{mine}"):
            tables.delete(spark, folder)
        rows = digest(kept, self.keys, self.event_time).withColumns({"at": F.col("at").cast("timestamp"), "writer": F.lit(writer), "batch_id": F.lit(batch_id)})
        rows.repartition("month").write.mode("append").partitionBy("month", "writer", "batch_id").parquet(self.path)

    def forget(self, spark: SparkSession, before: str) -> list[str]:
        """Delete the digest of the months that end before a date (``yyyy-MM-dd``): no row of them will come any more."""
        gone = [p for p in tables.matching(spark, f"{self.path}/month=*") if p.rsplit("month=", 1)[-1] < f"{before[:7]}-01"]
        for folder in gone:
            tables.delete(spark, folder)
        return gone
