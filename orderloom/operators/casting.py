"""Type enforcement."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.rules import Rule


def cast_columns(df: DataFrame, types: Mapping[str, str], try_: bool = False) -> DataFrame:
    """Replace the listed columns by typed ones, keeping column order.

    The strict form fails the job on text that does not parse; ``try_`` turns such text into NULL.
    """
    return df.withColumns(
        {name: F.col(name).try_cast(kind) if try_ else F.col(name).cast(kind) for name, kind in types.items()}
    )


def unparsable(types: Mapping[str, str]) -> list[Rule]:
    """One rule per column: there is text, and it is not a value of the type. Never NULL."""
    return [
        Rule(f"{name} is not a valid {kind}", F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
        for name, kind in types.items()
    ]
