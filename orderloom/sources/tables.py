"""Tables by path and by name."""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_path(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A table by path, in its current version. A known ``schema`` saves the job that reads it from file footers."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path if fmt == "delta" else current(spark, path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _run_schema(spark: SparkSession, path: str, fmt: str) -> StructType:
    """A history's columns, and ``run_id`` as the text that it was given as, whatever it looks like."""
    found = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path).schema
    return StructType([*[f for f in found.fields if f.name != "run_id"], StructField("run_id", StringType())])


def read_runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table that keeps history, see :func:`write_run`."""
    reader = spark.read.format(fmt)
    return (reader if fmt == "delta" else reader.schema(_run_schema(spark, path, fmt))).load(path)


def query_path(spark: SparkSession, path: str, columns: str = "*", fmt: str = "parquet") -> DataFrame:
    """SQL straight over files."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path if fmt == 'delta' else current(spark, path)}`")


#: Of tables on disk: ids in hexadecimal take half of what they take with snappy.
COMPRESSION = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: Counter[int] = Counter()
_lock = Lock()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Writes in here take the files of their shuffles with them when they are done, not when the driver collects its garbage.

    Tables are written side by side: the last one to end puts the session's setting back.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        mine = _writing[session] or spark.conf.get(_CLEANUP, "false") != "true"
        if mine:
            _writing[session] += 1
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            if mine:
                _writing[session] -= 1
                if not _writing[session]:
                    del _writing[session]
                    spark.conf.unset(_CLEANUP)


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write a table's files."""
    writer = df.write.format(fmt).mode(mode)
    with _shuffles_go(df.sparkSession):
        (writer.option("compression", COMPRESSION) if fmt == "parquet" else writer).save(path)


#: How long a replaced version's files stay for those who are still reading them, in seconds.
RETIRE_AFTER = 24 * 3600.0
_POINTERS = "_current"


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str, float]]:
    """(number, version folder, when it became current, in seconds), oldest first. Names say all: nothing is read but a listing."""
    files, pattern = _filesystem(spark, f"{path.rstrip('/')}/{_POINTERS}/*.*")
    found = [(f.getPath().getName(), f.getModificationTime() / 1000) for f in files.globStatus(pattern) or ()]
    return sorted((int(name.split(".")[0]), name.split(".", 1)[1], at) for name, at in found)


def current(spark: SparkSession, path: str) -> str:
    """Where a table's files lie: the version that :func:`overwrite` made current, or the path itself."""
    versions = _pointers(spark, path)
    return f"{path.rstrip('/')}/{versions[-1][1]}" if versions else path


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", retire_after: float = RETIRE_AFTER) -> None:
    """Replace a table's rows.

    Parquet files are written as a version of their own below the path; when they are complete, one new empty file, whose name says
    number and folder, makes them current. No file is moved or copied, on an object store either. Whoever reads by :func:`read_path`
    sees the old rows whole or the new ones whole; a write that fails leaves the old ones, and ``df`` may read the table that it
    replaces. Versions that were replaced ``retire_after`` seconds ago or more are deleted.
    """
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").save(path)
        return
    path, spark = path.rstrip("/"), df.sparkSession
    known = _pointers(spark, path)
    number = known[-1][0] + 1 if known else 0
    folder = f"version-{number}-{uuid.uuid4().hex[:12]}"
    save(df, f"{path}/{folder}", fmt)
    files, pointer = _filesystem(spark, f"{path}/{_POINTERS}/{number}.{folder}")
    if not files.createNewFile(pointer):
        raise OSError(f"{pointer} could not be made; the table is as before, the new rows are in {path}/{folder}")
    retire(spark, path, retire_after)


def retire(spark: SparkSession, path: str, older_than: float = RETIRE_AFTER) -> list[str]:
    """Delete the versions of a table that were replaced so many seconds ago or more; the current one stays. Returns their folders."""
    versions, gone = _pointers(spark, path), []
    now = time.time()
    for (number, folder, _), (_, _, replaced) in zip(versions, versions[1:], strict=False):
        if now - replaced >= older_than:
            delete(spark, f"{path.rstrip('/')}/{folder}")
            delete(spark, f"{path.rstrip('/')}/{_POINTERS}/{number}.{folder}")
            gone.append(folder)
    return gone


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    save(df, path, fmt, "append")


def partition_text(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it into a folder's name, and so as it reads it back."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def write_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Add one run's rows to a table that keeps history.

    A run owns the partition ``run_id``, so repeating the run replaces its rows instead of adding them
    a second time. Any text but the empty one is a run id.
    """
    if not run_id:
        raise ValueError("a run id must not be empty")
    if fmt == "delta":
        stamped = df.withColumn("run_id", F.lit(run_id))
        condition = f"run_id = {_text(run_id)}"
        stamped.write.format(fmt).mode("overwrite").option("replaceWhere", condition).partitionBy("run_id").save(path)
    else:
        save(df, f"{path}/run_id={partition_text(df.sparkSession, run_id)}", fmt, "overwrite")


def replace_table(df: DataFrame, name: str, path: str, fmt: str = "parquet", retire_after: float = RETIRE_AFTER) -> None:
    """Create or replace a named table from a query, its files below ``path``.

    The new version is written whole, then the catalog is told of it in one statement: a query by name sees the old rows or the new
    ones. Where the columns change the name is dropped and made again; for that moment it is unknown.
    """
    spark = df.sparkSession
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)
        return
    overwrite(df, path, fmt, retire_after)
    if spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema] != [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"DROP TABLE {_name(name)}")
    register(spark, name, path, fmt)


def create_schema(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(name)} COMMENT {_text(comment)}")


#: Folders of a table of micro-batches, see :func:`orderloom.streaming.silver.write_batch`, and of one of runs.
BATCH_PARTS = {"writer": "string", "batch_id": "int"}
RUN_PARTS = {"run_id": "string"}


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet", parts: Mapping[str, str] | None = None) -> None:
    """Make existing files queryable by name; where the name exists, let it see the files as they are now.

    ``parts`` are the folders of a table that grows by folders, with their types: :data:`RUN_PARTS` or :data:`BATCH_PARTS`.
    They are looked up anew each time; a writer that adds one folder may tell the catalog by :func:`add_part` instead.
    """
    if parts and fmt != "delta":
        found = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path).schema
        columns = [f"{_name(f.name)} {f.dataType.simpleString()}" for f in found.fields if f.name not in parts]
        columns += [f"{_name(c)} {kind}" for c, kind in parts.items()]
        folders = ", ".join(map(_name, parts))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({', '.join(columns)}) USING {fmt} PARTITIONED BY ({folders}) LOCATION {_text(path)}")
        spark.sql(f"ALTER TABLE {_name(name)} RECOVER PARTITIONS")
    elif fmt == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} USING {fmt} LOCATION {_text(path)}")
    else:
        place = _text(current(spark, path))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} USING {fmt} LOCATION {place}")
        spark.sql(f"ALTER TABLE {_name(name)} SET LOCATION {place}")
    spark.catalog.refreshTable(name)


def add_part(spark: SparkSession, name: str, values: Mapping[str, str | int]) -> None:
    """Tell the catalog of one new folder of a table that :func:`register` knows by its parts; a known one is read anew."""
    part = ", ".join(f"{_name(c)} = {v if isinstance(v, int) else _text(v)}" for c, v in values.items())
    spark.sql(f"ALTER TABLE {_name(name)} ADD IF NOT EXISTS PARTITION ({part})")
    spark.catalog.refreshTable(name)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema; the session's temporary views are left out."""
    return spark.sql(f"SHOW TABLES IN {_name(schema)}").filter("NOT isTemporary")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at a path of any store that Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in any store that Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return sorted(f.getPath().toString() for f in found or ())


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
