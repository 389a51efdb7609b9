"""Cleaning of parsed event batches: pure DataFrame functions, usable on batch frames as well."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.functions.text import lower_code
from orderloom.operators.dedupe import distinct_rows, one_per_key
from orderloom.operators.nulls import null_policy
from orderloom.operators.rules import Rule, reasons
from orderloom.schemas import EVENT_SCHEMAS

# Timestamp pattern of the payload and spellings of one payment type.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
CREDIT_CARD_SPELLINGS = ("credit card", "creditcard", "cc")


BODY = "Body"
LOST = "_lost"


def parse(bodies: DataFrame, schema: StructType, with_body: bool = False) -> DataFrame:
    """JSON text to columns. Unknown fields are ignored; text that is not JSON gives a row of NULLs.

    Filters on plain fields of the parsed text would move below the projection, with a parse of their own for every
    field that they name. They don't pass a generator, so each text is parsed once.
    """
    parsed = F.inline(F.array(F.from_json(BODY, schema)))
    return bodies.select(parsed, BODY) if with_body else bodies.select(parsed)


def _distinct(df: DataFrame) -> DataFrame:
    """Distinct rows; of copies that differ in their text alone the smallest text is kept."""
    if BODY not in df.columns:
        return distinct_rows(df)
    return df.groupBy(*[c for c in df.columns if c != BODY]).agg(F.min(BODY).alias(BODY))


def _keys(df: DataFrame, *keys: str) -> list[str]:
    """The key, and the number that :func:`tag_events` gives to rows without one."""
    return [*keys, *(c for c in (LOST,) if c in df.columns)]


@dataclass(frozen=True)
class EventContract:
    """How one event table is cleaned, in this order: prepare, deduplicate, require, standardise, keep."""

    schema: StructType
    prepare: Callable[[DataFrame], DataFrame]
    dedupe: Callable[[DataFrame], DataFrame]
    key: tuple[str, ...]
    require: tuple[str, ...]
    standardise: Callable[[DataFrame], DataFrame]
    keep: Callable[[], Column]
    rules: Callable[[], Sequence[Rule]]


def _same(df: DataFrame) -> DataFrame:
    return df


def _parse_purchase(df: DataFrame) -> DataFrame:
    parsed = F.try_to_timestamp("order_purchase_timestamp", F.lit(TIMESTAMP_PATTERN))
    return df.withColumn("order_purchase_timestamp", parsed)


def _unify_payment_type(df: DataFrame) -> DataFrame:
    kind = lower_code(F.col("payment_type"))
    unified = F.when(kind.isin(*CREDIT_CARD_SPELLINGS), F.lit("credit_card")).otherwise(kind)
    return df.withColumn("payment_type", unified)


def _missing(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is NULL", F.col(c).isNull()) for c in columns]


def _negative(column: str, required: bool = False) -> Rule:
    """NULL fails the numeric checks, so it is a reason as well; so is NaN where a value is required."""
    value = F.nanvl(F.col(column), F.lit(None).cast("double")) if required else F.col(column)
    return Rule(f"{column} is NULL or negative", ~F.coalesce(value >= 0, F.lit(False)))


CONTRACTS: dict[str, EventContract] = {
    "orders": EventContract(
        schema=EVENT_SCHEMAS["orders"],
        prepare=_parse_purchase,
        dedupe=lambda df: one_per_key(df, _keys(df, "order_id")),
        key=("order_id",),
        require=("order_id", "customer_id"),
        standardise=lambda df: df.withColumn("order_status", lower_code(F.col("order_status"))),
        keep=lambda: F.col("order_purchase_timestamp").isNotNull(),
        rules=lambda: _missing("order_id", "customer_id", "order_purchase_timestamp"),
    ),
    "items": EventContract(
        schema=EVENT_SCHEMAS["items"],
        prepare=_same,
        dedupe=lambda df: one_per_key(df, _keys(df, "order_id", "order_item_id")),
        key=("order_id", "order_item_id"),
        require=("order_id", "price"),
        standardise=_same,
        keep=lambda: (F.col("price") >= 0) & (F.col("freight_value") >= 0),
        rules=lambda: [*_missing("order_id"), _negative("price", required=True), _negative("freight_value")],
    ),
    "payments": EventContract(
        schema=EVENT_SCHEMAS["payments"],
        prepare=_same,
        dedupe=_distinct,
        key=("order_id", "payment_type", "payment_installments", "payment_value"),
        require=("order_id", "payment_value"),
        standardise=_unify_payment_type,
        keep=lambda: (F.col("payment_value") >= 0) & (F.col("payment_installments") >= 0),
        rules=lambda: [
            *_missing("order_id"),
            _negative("payment_value", required=True),
            _negative("payment_installments"),
        ],
    ),
}


def _deduplicated(bodies: DataFrame, table: str, schema: StructType | None) -> DataFrame:
    terms = CONTRACTS[table]
    return terms.dedupe(terms.prepare(parse(bodies, schema or terms.schema)))


def clean_events(bodies: DataFrame, table: str, schema: StructType | None = None) -> DataFrame:
    """Trusted rows of one batch of event bodies. ``schema`` may be wider than the default payload."""
    terms = CONTRACTS[table]
    kept = null_policy(_deduplicated(bodies, table, schema), require=terms.require)
    return terms.standardise(kept).filter(terms.keep())


MALFORMED = "Body is not valid JSON"


def tag_events(bodies: DataFrame, table: str, schema: StructType | None = None) -> DataFrame:
    """Every row of a batch with its text and its ``error_reason``, empty for a trusted row.

    Rows without an order id, those of malformed text among them, can't be compared by key: each is kept.
    The others are deduplicated as in :func:`clean_events`.
    """
    terms = CONTRACTS[table]
    parsed = terms.prepare(parse(bodies, schema or terms.schema, with_body=True))
    # A number of its own for each row without an order id: one pass over the batch for both kinds.
    numbered = parsed.withColumn(LOST, F.when(F.col("order_id").isNull(), F.monotonically_increasing_id()))
    rows = terms.standardise(terms.dedupe(numbered).drop(LOST))
    malformed = Rule(MALFORMED, F.col("order_id").isNull() & F.try_parse_json(BODY).isNull())
    return rows.withColumn("error_reason", reasons([malformed, *terms.rules()]))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: the rows :func:`clean_events` keeps, and all others with their reasons and text."""
    return tagged.filter("error_reason = ''").drop("error_reason", BODY), tagged.filter("error_reason <> ''")
