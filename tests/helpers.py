from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import raw_schema


def raw_rows(spark: SparkSession, table: str, base: dict, *changes: dict) -> DataFrame:
    """One raw row per change, each ``base`` with some columns replaced."""
    schema = raw_schema(table)
    rows = [tuple({**base, **change}[name] for name in schema.names) for change in changes]
    return spark.createDataFrame(rows, schema)


def plan(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution has run it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples; None sorts first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is not None, v) for v in t])
