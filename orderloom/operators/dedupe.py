"""Duplicate removal. All forms combine on the map side, so a hot key or a mass-copied row stays cheap."""

from __future__ import annotations

from collections.abc import Container, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.packing import ids, packed, unpacked


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row per set of identical rows."""
    return df.dropDuplicates()


def distinct_packed(df: DataFrame, never_null: Container[str] = ()) -> DataFrame:
    """:func:`distinct_rows` with ids at half their size in the shuffle; those in ``never_null`` hold no NULL.

    A filter on the result's ids moves below and packs them once more for each mention, so filter before.
    """
    names = ids(df)
    return unpacked(packed(df, names).dropDuplicates(), names, never_null)


def _survivor(df: DataFrame, keys: Sequence[str], pick, order: Sequence[tuple[str, Column]]) -> DataFrame:
    """The row per key whose ``order`` columns are extreme; other columns are taken from among them."""
    if not order:
        return df.select(*keys).distinct()
    packed = F.struct(*[column.alias(name) for name, column in order])
    kept = df.groupBy(*keys).agg(pick(packed).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns in order, NULLs last.

    An aggregate of the smallest row rather than a ranking window: each task reduces its own rows to
    one per key before the shuffle, and the survivor is the same however the rows are partitioned.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [pair for c in rest for pair in ((f"_null_{c}", F.col(c).isNull()), (c, F.col(c)))]
    return _survivor(df, keys, F.min, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``newest_by`` values, then the greatest remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    return _survivor(df, keys, F.max, [(c, F.col(c)) for c in (*newest_by, *rest)])
