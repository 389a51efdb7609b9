"""The batch run: raw CSV folders to bronze, silver with quarantine, gold and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.lake import Lake
from orderloom.operators import profile
from orderloom.plans import corrections, gold, kpi, silver
from orderloom.schemas import ENTITIES, EVENT_SCHEMAS, MULTILINE_ENTITIES, raw_schema
from orderloom.sources import files, landing, tables
from orderloom.streaming.silver import running_query, write_batch
from orderloom.streaming.state import read_history
from orderloom.streaming.unify import BATCH_TABLE, unify


def land_batch(lake: Lake, entity: str) -> Callable[[DataFrame, int], None]:
    """The function that brings one micro-batch of arrived files to bronze, whatever their layouts."""

    def process(arrived: DataFrame, batch_id: int) -> None:
        spark, paths = arrived.sparkSession, [r.path for r in arrived.select("path").collect()]
        rows = landing.read_files(spark, paths, raw_schema(entity).names, lake.schema_file(entity), entity in MULTILINE_ENTITIES) if paths else None
        if rows is not None:
            write_batch(rows, lake.bronze(entity), batch_id, lake.fmt, running_query(arrived))

    return process


def ingest(spark: SparkSession, lake: Lake, entities: Iterable[str] = ENTITIES, **options: str) -> None:
    """Append the CSV files that have arrived since the last run to bronze, all entities at once.

    A file's own header says which columns it has, and in which order: files of several layouts may lie side by side. New
    columns join the table, columns that a file lacks are NULL; `landing.schema_history` tells of both.
    Records with too few or too many fields are kept as text in the rescued-data column.
    """
    queries = []
    try:
        for entity in entities:
            arrived = landing.arrivals(spark, lake.raw(entity), **options).writeStream.foreachBatch(land_batch(lake, entity))
            checkpoint = lake.checkpoint("bronze", entity)
            queries.append(arrived.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        for query in queries:
            query.awaitTermination()
    finally:  # one that fails stops the others
        for query in queries:
            query.stop()


def bronze(spark: SparkSession, lake: Lake, entity: str, every_column: bool = False) -> DataFrame:
    """One raw table with its known columns; ``every_column`` adds those that later files brought."""
    names = raw_schema(entity).names
    if every_column:
        history = landing.schema_history(spark, lake.schema_file(entity))
        names = history[-1].names if history else names
    schema = files.with_rescue(StructType([StructField(n, StringType()) for n in names]))
    rows = tables.read_path(spark, lake.bronze(entity), lake.fmt, schema if lake.fmt == "parquet" else None)
    return files.conform(rows, schema)


def refine(
    spark: SparkSession,
    lake: Lake,
    entity: str,
    run_id: str,
    strict: bool = False,
    tolerant: bool = False,
    retire_after: float = tables.RETIRE_AFTER,
) -> None:
    """Rewrite one silver table and add this run's rejected rows to its quarantine.

    Corrected rows are part of what is cleaned, see :mod:`orderloom.plans.corrections`. While both are written their rows and NULLs are counted;
    the counts are the run's lines in ``ledger/<entity>``.

    With ``tolerant`` rows whose text does not parse go to ``quarantine/<entity>_unparsed`` instead of
    failing the run.
    """
    raw = corrections.corrected(spark, lake, entity, bronze(spark, lake, entity))
    if tolerant:
        readable = silver.split_unparsable(raw, entity)
        tables.write_run(readable.rejected, lake.quarantine(f"{entity}_unparsed"), run_id, lake.fmt)
        raw = readable.valid
    cleaned = silver.clean(raw, entity, strict=strict)
    rejected, counts_rejected = profile.observed(cleaned.rejected)
    valid, counts_valid = profile.observed(cleaned.valid)
    tables.write_run(rejected, lake.quarantine(entity), run_id, lake.fmt)
    tables.overwrite(valid, lake.silver(entity), lake.fmt, retire_after)
    lines = [(entity, side, *counts()) for side, counts in (("valid", counts_valid), ("rejected", counts_rejected))]
    tables.write_run(spark.createDataFrame(lines, profile.LEDGER).coalesce(1), lake.path("ledger", entity), run_id, lake.fmt)


def silver_rows(spark: SparkSession, lake: Lake, name: str, with_streams: bool = False) -> DataFrame:
    """A silver table; with ``with_streams`` also the streamed rows whose key it does not hold yet."""
    rows = tables.read_path(spark, lake.silver(name), lake.fmt)
    streamed = {batch_name: table for table, batch_name in BATCH_TABLE.items()}.get(name)
    path = lake.path("stream_silver", streamed) if streamed else ""
    if not with_streams or not streamed or not tables.exists(spark, path):
        return rows
    return unify(rows, read_history(spark, path, lake.fmt), streamed)


def publish_gold(spark: SparkSession, lake: Lake, table: str, with_streams: bool = False, retire_after: float = tables.RETIRE_AFTER) -> None:
    """Rebuild one gold table, over the batch layer alone or over both pipelines.

    Both need the same columns: run the streams with ``orderloom.schemas.WIDE_EVENT_SCHEMAS``, else facts hold NULL where
    the default payload has no column.
    """
    rows = gold.build(table, lambda name: silver_rows(spark, lake, name, with_streams))
    tables.overwrite(rows, lake.gold(table), lake.fmt, retire_after)


def report(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return kpi.run(name, lambda table: tables.read_path(spark, lake.gold(table), lake.fmt))


#: Prefixes under which a lake's tables were registered, by its root; runs refresh them.
_REGISTERED: dict[str, set[str]] = {}


def register(spark: SparkSession, lake: Lake, prefix: str = "") -> None:
    """Make every table that the lake holds queryable as ``<prefix><layer>.<table>``, stream tables included.

    Names that exist see the files as they are now. :func:`run_batch` calls this again for each prefix it knows.
    """
    _REGISTERED.setdefault(lake.root, set()).add(prefix)
    layers = {
        "bronze": (ENTITIES, lake.bronze),
        "silver": (ENTITIES, lake.silver),
        "quarantine": ([*ENTITIES, *(f"{e}_unparsed" for e in ENTITIES)], lake.quarantine),
        "gold": (tuple(gold.TABLES), lake.gold),
        **{layer: (tuple(EVENT_SCHEMAS), partial(lake.path, layer)) for layer in ("stream_bronze", "stream_silver", "stream_quarantine")},
    }
    batches = dict.fromkeys(("bronze", "stream_silver", "stream_quarantine"), tables.BATCH_PARTS)
    parts = {"quarantine": tables.RUN_PARTS, **batches}
    for layer, (names, path) in layers.items():
        tables.create_schema(spark, f"{prefix}{layer}")
        for name in names:
            if tables.exists(spark, path(name)):
                tables.register(spark, f"{prefix}{layer}.{name}", path(name), lake.fmt, parts.get(layer))


def each(spark: SparkSession, names: Iterable[str], step: Callable[[str], None], concurrent: int = 4) -> None:
    """Run ``step`` for every name, up to ``concurrent`` at a time; the first failure is raised."""
    with ThreadPoolExecutor(concurrent) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step), name) for name in names]
    for run in started:
        run.result()


def run_batch(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    strict: bool = False,
    tolerant: bool = False,
    concurrent: int = 4,
    with_streams: bool = False,
    retire_after: float = tables.RETIRE_AFTER,
) -> None:
    """One complete run. Repeating it with the same ``run_id`` leaves every table unchanged.

    The versions of tables that a run replaces stay ``retire_after`` seconds, for those who are still reading them. Where nobody
    reads during a run, 0 frees their space while it is under way.

    With ``with_streams`` the gold layer holds what the streams have brought since, see :func:`publish_gold`.

    Tables of one layer do not depend on each other, so several are submitted together and the small
    ones fill the cluster while a large one ends.
    """
    ingest(spark, lake)
    each(spark, ENTITIES, lambda entity: refine(spark, lake, entity, run_id, strict, tolerant, retire_after), concurrent)
    each(spark, gold.TABLES, lambda table: publish_gold(spark, lake, table, with_streams, retire_after), concurrent)
    for prefix in _REGISTERED.get(lake.root, ()):
        register(spark, lake, prefix)
