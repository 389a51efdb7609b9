"""Named row rules: tagging, the valid/rejected split, quarantine and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON_SEPARATOR = " | "
QUARANTINE_COLUMNS = ("error_reason", "quarantine_timestamp", "source_table")


@dataclass(frozen=True)
class Rule:
    """A violation: the text shown to people and the predicate that is TRUE on a bad row."""

    reason: str
    violated: Column


def any_violated(rules: Sequence[Rule]) -> Column:
    """TRUE if some rule is violated; NULL if none is but some cannot be decided."""
    return reduce(or_, (rule.violated for rule in rules))


def reasons(rules: Sequence[Rule]) -> Column:
    """Texts of all violated rules in declared order; the empty string if there are none."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(rule.violated, F.lit(rule.reason)) for rule in rules])


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("error_reason", reasons(rules))


def split(df: DataFrame, rules: Sequence[Rule], keep: Column) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``. ``keep`` is stated on its own and need not be the complement of the rules.

    Both sides are plain filters, so each sink's filter moves below the deduplication shuffle and the
    rejected pass only shuffles rejected rows. That is cheaper than caching the cleaned table.
    """
    return df.filter(keep), tag(df.filter(any_violated(rules)), rules)


def quarantine(rejected: DataFrame, source_table: str, as_of: Column | None = None) -> DataFrame:
    """Add when and from where a row was rejected."""
    return rejected.withColumns(
        {
            "quarantine_timestamp": F.current_timestamp() if as_of is None else as_of,
            "source_table": F.lit(source_table),
        }
    )


def reconcile(df: DataFrame, rules: Sequence[Rule], keep: Column) -> DataFrame:
    """One row of counts: kept, rejected, in both outputs, in neither. One pass."""
    kept = F.coalesce(keep, F.lit(False))
    rejected = F.coalesce(any_violated(rules), F.lit(False))
    return df.agg(
        F.count_if(kept).alias("kept_rows"),
        F.count_if(rejected).alias("rejected_rows"),
        F.count_if(kept & rejected).alias("both_rows"),
        F.count_if(~kept & ~rejected).alias("neither_rows"),
    )


def split_strict(df: DataFrame, rules: Sequence[Rule], undecided: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` as exact complements.

    A row on which no rule is violated but some rule is NULL is rejected with the ``undecided`` text.
    """
    bad = F.coalesce(any_violated(rules), F.lit(True))
    text = reasons(rules)
    reason = F.when(text == "", F.lit(undecided)).otherwise(text)
    return df.filter(~bad), df.filter(bad).withColumn("error_reason", reason)
