"""Joins that a hot key doesn't slow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt to.
SALTS = 16


def join_one_per_key(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join rows to a table of one row per key, such as an aggregate on that key.

    Such a side arrives at the join without an exchange of its own, and adaptive execution then can't split
    the partition of a hot key. So rows are dealt to ``salts`` parts by a hash of their other columns, and
    the side with one row per key is repeated for each part. A key that holds a third of all rows is
    spread over ``salts`` tasks; rows that are equal in every column stay together.

    The repeated side is never broadcast: adaptive execution measures it before it is repeated, so what seems to
    fit the driver is ``salts`` times as large there.
    """
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys] or keys
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
