"""Calendar attributes of a timestamp or date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """yyyymmdd as an int. Arithmetic stays in generated code; formatting a string per fact row does not."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def is_weekend(c: Column) -> Column:
    """Saturday or Sunday; FALSE, not NULL, for a missing date."""
    return F.coalesce(F.dayofweek(c).isin(1, 7), F.lit(False))


def calendar_columns(c: Column) -> list[Column]:
    """The ten columns of the date dimension for a date column."""
    return [
        date_key(c).alias("date_key"),
        F.to_date(c).alias("full_date"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.weekofyear(c).alias("week"),
        F.dayofmonth(c).alias("day"),
        F.date_format(c, "EEEE").alias("day_name"),
        is_weekend(c).alias("is_weekend"),
    ]
