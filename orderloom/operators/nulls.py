"""NULL policy of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def null_policy(
    df: DataFrame, fill: Mapping[str, object] | None = None, require: Sequence[str] | str | None = None
) -> DataFrame:
    """Fill constants, then drop rows with a NULL in a required column.

    ``require="all"`` demands every column. In floating-point columns NaN counts as missing too.
    """
    if fill:
        df = df.fillna(dict(fill))
    if require == "all":
        return df.dropna()
    if require:
        return df.dropna(subset=list(require))
    return df
