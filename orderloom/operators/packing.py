"""Hexadecimal ids at half their size, for the way through a shuffle.

An id of 32 lower-case hexadecimal digits is 16 bytes. Any other text keeps its own bytes and one or two more, so that no two
texts are packed alike and each comes back as it was. NULL is a value of no bytes, or of another such value where it must meet none:
a column that may be NULL would have a join add filters that pack ids again.
"""

from __future__ import annotations

from collections.abc import Container, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SIZE = 16
#: Values of less than two bytes that no text is packed to: what stands for NULL, by side of a join.
MISSING, MISSING_TOO = b"", b"\x02"


def pack(c: Column, missing: bytes = MISSING) -> Column:
    """16 bytes of an id; else the text's bytes and a 0, or where these would be 16 bytes, two more that end in 1. Never NULL."""
    plain, digits = c.cast("binary"), F.unhex(c)
    other = F.concat(plain, F.when(F.octet_length(plain) == _SIZE - 1, F.lit(b"\x00\x01")).otherwise(F.lit(b"\x00")))
    is_id = (F.octet_length(plain) == 2 * _SIZE) & (F.lower(F.hex(digits)) == c)
    return F.coalesce(F.when(is_id, digits).otherwise(other), F.lit(missing))


def unpack(c: Column, nullable: bool = True) -> Column:
    """The text. Say where it is never NULL: what is joined on it is then not asked for NULLs below, where ids are packed."""
    size, last = F.octet_length(c), F.substring(c, -1, 1)
    other = F.substring(c, F.lit(1), size - F.when(last == F.lit(b"\x01"), 2).otherwise(1)).cast("string")
    if not nullable:
        return F.coalesce(F.when(size == _SIZE, F.lower(F.hex(c))).otherwise(other), F.lit(""))
    return F.when(size == _SIZE, F.lower(F.hex(c))).when(c.isin(MISSING, MISSING_TOO), F.lit(None)).otherwise(other)


def ids(df: DataFrame) -> list[str]:
    """Text columns that are named as ids."""
    return [f.name for f in df.schema.fields if f.name.endswith("_id") and isinstance(f.dataType, StringType)]


def packed(df: DataFrame, names: Iterable[str], missing: bytes = MISSING) -> DataFrame:
    return df.withColumns({name: pack(F.col(name), missing) for name in names})


def unpacked(df: DataFrame, names: Iterable[str], never_null: Container[str] = (), hold: bool = False) -> DataFrame:
    """With ``hold`` later filters stay above, as they pass no column that is numbered by row: below they would pack ids for each mention."""
    texts = {name: unpack(F.col(name), name not in never_null) for name in names}
    return df.withColumns({n: F.when(F.monotonically_increasing_id() >= 0, t) for n, t in texts.items()} if hold else texts)
