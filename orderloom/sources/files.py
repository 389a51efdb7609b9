"""CSV folders: incremental and one-shot reads, tracked schemas, rescued records."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued_data"


def _csv_options(multiline: bool, rescue: bool) -> dict[str, str]:
    # enforceSchema=false checks the header of every file, inside the task that reads it, against the
    # expected columns: a renamed or reordered file stops the run instead of shifting its values.
    options = {"header": "true", "enforceSchema": "false", "mode": "PERMISSIVE"}
    if multiline:
        options |= {"multiLine": "true", "quote": '"', "escape": '"'}
    if rescue:
        options["columnNameOfCorruptRecord"] = RESCUED
    return options


def with_rescue(schema: StructType) -> StructType:
    """A schema plus the text column that keeps records which do not fit it."""
    return StructType([*schema.fields, StructField(RESCUED, StringType())])


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multiline: bool = False,
    rescue: bool = False,
    **options: str,
) -> DataFrame:
    """Stream a folder of CSV files with headers; the sink's checkpoint remembers the files already read.

    ``multiline`` is for quoted text with line breaks and doubled quotes; such a file is one task, so
    land it as many files. ``rescue`` keeps every record that does not fit the schema as text in
    ``_rescued_data``. Extra options, such as ``maxFilesPerTrigger``, go to the reader.
    """
    chosen = with_rescue(schema) if rescue else schema
    reader = spark.readStream.schema(chosen).options(**_csv_options(multiline, rescue))
    return reader.options(**options).csv(path)


def csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    multiline: bool = False,
    rescue: bool = False,
) -> DataFrame:
    """Read CSV once. Without a schema, types are inferred, which costs one more pass over the files."""
    if schema is None:
        options = _csv_options(multiline, False) | {"enforceSchema": "true", "inferSchema": "true"}
        return spark.read.options(**options).csv(path)
    chosen = with_rescue(schema) if rescue else schema
    return spark.read.schema(chosen).options(**_csv_options(multiline, rescue)).csv(path)


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Start a query that appends everything available now and then stops; await it to be sure.

    A table and its checkpoint belong together: the file sink skips batch numbers it has seen, so a
    table written under a second checkpoint would silently lose batches.
    """
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


class ResolvedSchema(NamedTuple):
    """``schema`` is the table's; ``file_schema`` is what the files at hand carry, in their order."""

    schema: StructType
    file_schema: StructType
    added: tuple[str, ...]
    missing: tuple[str, ...]


def _saved_schema(spark: SparkSession, schema_file: str) -> StructType | None:
    try:
        lines = spark.read.text(schema_file, wholetext=True).take(1)
    except AnalysisException:
        return None
    return StructType.fromJson(json.loads(lines[0].value)) if lines else None


def resolve_schema(
    spark: SparkSession,
    path: str,
    schema_file: str,
    infer_types: bool = True,
    multiline: bool = False,
    sampling_ratio: float = 1.0,
) -> ResolvedSchema:
    """The schema to read ``path`` with, remembered in ``schema_file`` across runs.

    The first run infers it. Later runs compare the files' header with the stored schema, append new
    columns and report both directions; a known column keeps its stored type, and one that has gone
    missing stays in the table as NULL. ``infer_types=False`` reads only a header and keeps every
    column text, which is the cheap choice for large folders because cleaning enforces types anyway;
    ``sampling_ratio`` bounds the rows parsed where types are inferred.
    """
    options = _csv_options(multiline, False) | {
        "enforceSchema": "true",
        "inferSchema": str(infer_types).lower(),
        "samplingRatio": str(sampling_ratio),
    }
    saved = _saved_schema(spark, schema_file)
    if saved is not None:
        options["inferSchema"] = "false"
    found = spark.read.options(**options).csv(path).schema
    if saved is None:
        resolved = ResolvedSchema(found, found, (), ())
    else:
        added = [f for f in found.fields if f.name not in saved.names]
        missing = tuple(n for n in saved.names if n not in found.names)
        schema = StructType([*saved.fields, *added])
        in_file_order = StructType([schema[name] for name in found.names])
        resolved = ResolvedSchema(schema, in_file_order, tuple(f.name for f in added), missing)
    if saved != resolved.schema:
        text = spark.createDataFrame([(resolved.schema.json(),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(schema_file)
    return resolved


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name; those the frame lacks are NULL."""
    return df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
