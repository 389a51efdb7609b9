"""Measures that can be partly aggregated before a join and finished after it.

A measure is three steps: ``partial`` columns over detail rows, ``merge`` columns over partial rows,
and a ``finish`` expression over merged columns. Every amount is taken apart into what decimal(18,6)
holds of it and the rest; both are summed, and the result is the sum of the two. Amounts of money have
no rest, so their sums are exact and don't depend on the order in which partitions arrive; nothing of
other amounts (further digits, large values, NaN, infinities) is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(18,6)"


@dataclass(frozen=True)
class Measure:
    name: str
    partial: Callable[[], list[Column]]
    merge: Callable[[], list[Column]]
    finish: Callable[[], Column]


def _sum_parts(name: str, value: Column) -> list[Column]:
    exact = value.try_cast(_EXACT)
    rest = value.cast("double") - F.coalesce(exact.cast("double"), F.lit(0.0))
    return [F.sum(exact).alias(f"{name}__exact"), F.sum(rest).alias(f"{name}__rest")]


def _merge_parts(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _rounded(value: Column, places: int | None) -> Column:
    return value if places is None else F.round(value, places)


def _finish(name: str, places: int | None, divisor: Column | None = None) -> Column:
    exact, rest = F.col(f"{name}__exact"), F.col(f"{name}__rest")
    exact = F.when(rest.isNotNull(), F.coalesce(exact, F.lit(0).cast("decimal(28,6)")))
    mixed = exact.cast("double") + rest
    if divisor is not None:
        # These precisions leave the quotient 16 decimals; the merged sum's own type would leave 6.
        exact, mixed = exact.cast("decimal(28,6)") / divisor.cast("decimal(18,0)"), mixed / divisor
    # Rounding the decimal, not its double, keeps half-way cases half-up.
    return F.when(rest == 0, _rounded(exact, places).cast("double")).otherwise(_rounded(mixed, places)).alias(name)


def total(name: str, column: str, places: int | None = None) -> Measure:
    """SUM of an amount, optionally rounded."""
    return Measure(
        name,
        lambda: _sum_parts(name, F.col(column)),
        lambda: _merge_parts(f"{name}__exact", f"{name}__rest"),
        lambda: _finish(name, places),
    )


def average(name: str, column: str, places: int | None = None) -> Measure:
    """AVG over non-NULL values, optionally rounded."""
    return Measure(
        name,
        lambda: [*_sum_parts(name, F.col(column)), F.count(column).alias(f"{name}__n")],
        lambda: _merge_parts(f"{name}__exact", f"{name}__rest", f"{name}__n"),
        lambda: _finish(name, places, F.nullif(F.col(f"{name}__n"), F.lit(0))),
    )


def row_count(name: str) -> Measure:
    """COUNT(*)."""
    return Measure(
        name,
        lambda: [F.count(F.lit(1)).alias(f"{name}__n")],
        lambda: _merge_parts(f"{name}__n"),
        lambda: F.coalesce(F.col(f"{name}__n"), F.lit(0)).alias(name),
    )


def summarise(rows: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Aggregate detail rows; ``by`` may be empty for one global row."""
    parts = [p for m in measures for p in m.partial()]
    return rows.groupBy(*by).agg(*parts).select(*by, *[m.finish() for m in measures])


def summarise_by_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, by: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Inner join facts to a dimension and aggregate by dimension attributes.

    Facts are first reduced to one row per join key, with map-side combining, and only that is joined.
    The join then never sees more than one fact row per key, so a seller, product or day that holds a
    third of all facts costs no more than any other, and neither side needs a broadcast hint. A key
    that occurs several times in the dimension still multiplies its facts, as a plain join would.
    """
    parts = [p for m in measures for p in m.partial()]
    merged = [p for m in measures for p in m.merge()]
    reduced = facts.groupBy(key).agg(*parts)
    joined = reduced.join(dimension.select(key, *[c for c in by if c != key]), key, "inner")
    return joined.groupBy(*by).agg(*merged).select(*by, *[m.finish() for m in measures])
