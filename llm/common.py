"""What the operators share: reading tables, shared intermediate tables, Arrow batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch holds at most; with the byte limit below it bounds what a Python worker holds.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by Spark's reader, so that any store Spark can read will do."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session may do without one: it takes its temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='llm-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of df from a table in the shared folder: lineage ends here, and a lost executor costs nothing.

    The table takes the place of the shuffles that made it, so their files go with the write.
    """
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _note(path, out)
    return out


#: Tables written since the innermost `passing` began: path and rows.
_made: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("made", default=None)


def _note(path: str, df: DataFrame) -> None:
    if _made.get() is not None:
        _made.get().append((path, df))


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are written in here go at the end, but those that are given to the function that it yields."""
    made: list[tuple[str, DataFrame]] = []
    kept: list[DataFrame] = []
    outer = _made.set(made)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        _made.reset(outer)
        for path, df in made:
            if any(df is k for k in kept):
                _note(path, df)
            else:
                hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def in_buckets(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """As `written`, dealt by a column: joins on it shuffle the other side alone, however often they come."""
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(_CLEANUP, "false")
    known = f"llm_{uuid.uuid4().hex}"
    spark.conf.set(_CLEANUP, "true")
    try:
        df.repartition(buckets, column).write.option("path", path).option("compression", "zstd").bucketBy(buckets, column).saveAsTable(known)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.table(known)
    spark.sql(f"DROP TABLE {known}")  # the name alone: the files lie at a path of their own
    _note(path, out)
    return out


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """df through a function of Arrow batches. make runs once a task and returns it; it gives columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_struct(df.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                arrays = [out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def _struct(spark: SparkSession, schema: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def row_key(df: DataFrame) -> DataFrame:
    """row: 16 hex digits by which rows that differ in doc_id or text differ; equal rows share it."""
    return df.withColumn("row", F.lower(F.hex(F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))))))
