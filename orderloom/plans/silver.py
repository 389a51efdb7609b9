"""Runs cleaning contracts: raw table in, ``(valid, rejected)`` out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import average
from orderloom.operators import rules as dq
from orderloom.operators.casting import cast_columns, unparsable
from orderloom.operators.dedupe import distinct_packed, distinct_rows
from orderloom.operators.nulls import null_policy
from orderloom.plans.contracts import CONTRACTS, Contract
from orderloom.sources.files import RESCUED

UNDECIDED = "Undecided: a rule could not be evaluated"
UNDEFINED = "Discarded: value outside the accepted list"


class Cleaned(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def contract(table: str) -> Contract:
    return CONTRACTS[table]()


def _apply(df: DataFrame, functions) -> DataFrame:
    return df.withColumns({name: fn(F.col(name)) for name, fn in functions.items()}) if functions else df


def typed(raw: DataFrame, terms: Contract) -> DataFrame:
    """Repaired text and enforced types; the rescued-data column is gone."""
    df = _apply(raw.drop(RESCUED), terms.repair)
    return cast_columns(df, terms.casts, terms.try_casts) if terms.casts else df


def standardised(raw: DataFrame, terms: Contract) -> DataFrame:
    """Everything before the hard discard: typed, deduplicated, NULL policy, standard text."""
    df = null_policy(distinct_rows(typed(raw, terms)), terms.fill, terms.require)
    return _apply(df, terms.standardise)


def refined(raw: DataFrame, terms: Contract) -> DataFrame:
    """The table on which the rules are judged."""
    df = standardised(raw, terms)
    if terms.discard_unless is not None:
        df = df.filter(terms.discard_unless)
    return terms.enrich(df) if terms.enrich else df


def _accepted(raw: DataFrame, terms: Contract, wanted: Column) -> DataFrame:
    """The rows of :func:`refined` on which ``wanted`` is true, for contracts that judge each row by itself.

    Rows are judged before copies go, on columns that only the filters see; so the shuffle moves wanted rows alone, with packed ids.
    """
    rows = typed(raw, terms)
    changed = {c: f"_typed_{c}" for c in (*terms.fill, *terms.standardise)}
    require = rows.columns if terms.require == "all" else terms.require
    judged = null_policy(rows.withColumns({copy: F.col(c) for c, copy in changed.items()}), terms.fill, require)
    judged = _apply(judged, terms.standardise)
    if terms.discard_unless is not None:
        judged = judged.filter(terms.discard_unless)
    found = distinct_packed(judged.filter(wanted).select(*[F.col(changed.get(c, c)).alias(c) for c in rows.columns]), require or ())
    return _apply(null_policy(found, terms.fill), terms.standardise)


def clean(raw: DataFrame, table: str, as_of: Column | None = None, strict: bool = False) -> Cleaned:
    """Split a raw table by its contract.

    The default reproduces each contract's own keep predicate, including its gaps: a row can be in both
    outputs or in neither. ``strict`` makes the outputs complementary: undecided rows and rows
    outside an accepted list are quarantined with a reason of their own.
    """
    terms = contract(table)
    if strict:
        rules = list(terms.rules)
        if terms.discard_unless is not None:
            rules.append(dq.Rule(UNDEFINED, ~F.coalesce(terms.discard_unless, F.lit(False))))
        df = standardised(raw, terms)
        valid, rejected = dq.split_strict(terms.enrich(df) if terms.enrich else df, rules, UNDECIDED)
    elif terms.enrich:
        valid, rejected = dq.split(refined(raw, terms), terms.rules, terms.keep)
    else:
        valid = _accepted(raw, terms, terms.keep)
        rejected = dq.tag(_accepted(raw, terms, dq.any_violated(terms.rules)), terms.rules)
    if terms.stamped:
        rejected = dq.quarantine(rejected, terms.source_table, as_of)
    return Cleaned(valid, rejected)


def judged(raw: DataFrame, table: str, carry: list[str]) -> DataFrame:
    """Raw rows that carry a key of their own: ``kept`` says whether the contract keeps the row, judged without its copies.

    Text that doesn't parse is not kept.
    """
    terms = contract(table)
    readable = split_unparsable(raw, table).valid if terms.casts and not terms.try_casts else raw
    df = null_policy(typed(readable, terms), terms.fill, terms.require)
    df = _apply(df, terms.standardise)
    if terms.discard_unless is not None:
        df = df.filter(terms.discard_unless)
    df = terms.enrich(df) if terms.enrich else df
    return df.select(*carry, F.coalesce(terms.keep, F.lit(False)).alias("kept"))


def split_unparsable(raw: DataFrame, table: str, as_of: Column | None = None) -> Cleaned:
    """Raw rows that the contract's strict casts accept, and the others as they arrived, with reasons.

    Run before :func:`clean` where one unreadable value must not stop the whole run.
    """
    terms = contract(table)
    checks = unparsable(terms.casts)
    if not checks:
        return Cleaned(raw, dq.quarantine(raw.filter(F.lit(False)).withColumn("error_reason", F.lit("")), table, as_of))
    readable, unreadable = dq.split(raw, checks, ~dq.any_violated(checks))
    return Cleaned(readable, dq.quarantine(unreadable, terms.source_table, as_of))


def reconcile(raw: DataFrame, table: str) -> DataFrame:
    """Counts of kept, rejected, doubly routed and lost rows of a contract."""
    terms = contract(table)
    return dq.reconcile(refined(raw, terms), terms.rules, terms.keep)


def reprocess(quarantined: DataFrame, table: str, fix=None, as_of: Column | None = None) -> Cleaned:
    """Run corrected quarantine rows through the contract again.

    ``fix`` is a DataFrame-to-DataFrame correction; without one the rows are only judged again.
    """
    rows = quarantined.drop(*dq.QUARANTINE_COLUMNS, "run_id")
    return clean(fix(rows) if fix else rows, table, as_of)


def geolocation_by_zip(geolocation: DataFrame) -> DataFrame:
    """One representative row per zip prefix: mean coordinates, first city and state by name.

    No digit of a coordinate is dropped before the mean, which is rounded to ten places.
    """
    key, means = "geolocation_zip_code_prefix", [average(c, c, 10) for c in ("geolocation_lat", "geolocation_lng")]
    names = [F.min(c).alias(c) for c in ("geolocation_city", "geolocation_state")]
    grouped = geolocation.groupBy(key).agg(*[p for m in means for p in m.partial()], *names)
    return grouped.select(key, *[m.finish() for m in means], "geolocation_city", "geolocation_state")
