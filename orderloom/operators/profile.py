"""Column and row profiles. Each is one pass with map-side aggregation, or no pass beside the write that it observes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.functions.text import is_untrimmed
from orderloom.operators.rules import Rule


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def nulls(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column, under the column's own name."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicates(df: DataFrame) -> DataFrame:
    """One row: how many rows a full-row deduplication would remove."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def untrimmed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which some text column has leading or trailing spaces."""
    return df.filter(reduce(or_, (is_untrimmed(F.col(c)) for c in columns)))


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per rule, zero included: ``(rule, violating_rows)``. All rules share one pass."""
    counted = df.agg(*[F.count_if(rule.violated).alias(f"n{i}") for i, rule in enumerate(rules)])
    lines = [
        F.struct(F.lit(rule.reason).alias("rule"), F.col(f"n{i}").alias("violating_rows"))
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


#: A line of a run's ledger.
LEDGER = "table_name string, side string, row_count long, null_counts map<string,long>"


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], tuple[int, dict[str, int]]]]:
    """``df`` that is counted while something else runs over it, and a function that gives rows and NULLs by column afterwards."""
    seen = Observation()
    names = {f"n{i}": c for i, c in enumerate(df.columns)}
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(n) for n, c in names.items()]

    def found() -> tuple[int, dict[str, int]]:
        got = seen.get
        return got["rows"], {c: got[n] for n, c in names.items()}

    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), found
