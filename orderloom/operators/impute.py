"""Imputation from group statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_one_per_key


def group_means(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """Rounded mean per group of each column over the rows where its validity predicate holds."""
    return df.groupBy(key).agg(
        *[F.round(F.avg(F.when(valid, F.col(name)))).alias(f"{name}__mean") for name, valid in columns.items()]
    )


def group_mean(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """Replace missing or invalid values by the rounded mean of valid values of the same group.

    ``columns`` maps each column to the predicate that makes a value valid. Values become double; a
    group without any valid value leaves NULL. ``key`` moves to the front of the result.

    The means are a partial aggregate of one row per group. :func:`join_one_per_key` spreads a hot group, so no
    task holds a whole one, as a window over the group would.
    """
    others = [c for c in df.columns if c != key]
    joined = join_one_per_key(df, group_means(df, key, columns), [key])

    def value(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        usable = F.coalesce(columns[name], F.lit(False))
        return F.when(usable, F.col(name).cast("double")).otherwise(F.col(f"{name}__mean")).alias(name)

    return joined.select(key, *[value(name) for name in others])
