"""Thirty reports over the star schema.

Reports that join a dimension reduce the fact to one row per join key first (see
``summarise_by_dimension``). Reports sorted by a tied value break the tie by their other columns, so
that a repeated run returns the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import Measure, average, row_count, summarise, summarise_by_dimension, total

DATE_KEY = "date_key"


@dataclass(frozen=True)
class Report:
    """``inputs`` are gold tables; ``build`` takes them in that order."""

    title: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


def _figure(title: str, fact: str, measure: Measure) -> Report:
    """One number over a whole fact."""
    return Report(title, (fact,), lambda f: summarise(f, (), [measure]))


def _breakdown(title: str, fact: str, by: str, measure: Measure, sort: str | None) -> Report:
    """A measure per value of a fact column. ``sort`` is ``value``, ``measure`` (descending) or None."""

    def build(f: DataFrame) -> DataFrame:
        rows = summarise(f, (by,), [measure])
        if sort == "value":
            return rows.orderBy(by)
        return rows.orderBy(F.desc(measure.name), F.asc(by)) if sort else rows

    return Report(title, (fact,), build)


def _ranking(
    title: str, fact: str, dimension: str, key: str, by: str, measure: Measure, limit: int | None = None
) -> Report:
    """A measure per dimension attribute, largest first, optionally only the first ``limit``."""

    def build(f: DataFrame, d: DataFrame) -> DataFrame:
        rows = summarise_by_dimension(f, d, key, (by,), [measure])
        rows = rows.orderBy(F.desc(measure.name), F.asc_nulls_last(by))
        return rows.limit(limit) if limit else rows

    return Report(title, (fact, dimension), build)


def _weekend(title: str, fact: str, measure: Measure) -> Report:
    return Report(
        title,
        (fact, "dim_date"),
        lambda f, d: summarise_by_dimension(f, d, DATE_KEY, ("is_weekend",), [measure]),
    )


def _monthly(title: str, fact: str, measures: Sequence[Measure], shown: Sequence[str]) -> Report:
    """Measures per calendar month in time order; the month number sorts even where it is not shown."""

    def build(f: DataFrame, d: DataFrame) -> DataFrame:
        rows = summarise_by_dimension(f, d, DATE_KEY, ("year", "month", "month_name"), measures)
        return rows.orderBy("year", "month").select(*shown, *[m.name for m in measures])

    return Report(title, (fact, "dim_date"), build)


def _extremes(title: str, fact: str, columns: Sequence[str], by: str, descending: bool, limit: int = 10) -> Report:
    """The detail rows with the largest or smallest ``by``."""

    def build(f: DataFrame) -> DataFrame:
        first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
        ties = [F.asc_nulls_last(c) for c in columns if c != by]
        return f.select(*columns).orderBy(first, *ties).limit(limit)

    return Report(title, (fact,), build)


YEAR_MONTH = ("year", "month_name")
YEAR_MONTH_NUMBER = ("year", "month", "month_name")

SALES: dict[str, Report] = {
    "kpi_total_revenue": _figure("Total revenue", "fact_orders", total("total_revenue", "price")),
    "kpi_total_freight": _figure("Total freight", "fact_orders", total("total_freight", "freight_value")),
    "kpi_items_sold": _figure("Items sold", "fact_orders", row_count("total_items_sold")),
    "kpi_average_price": _figure("Average price", "fact_orders", average("average_price", "price", 2)),
    "kpi_revenue_by_month": _monthly("Revenue by month", "fact_orders", [total("revenue", "price")], YEAR_MONTH),
    "kpi_revenue_by_state": _ranking(
        "Revenue by state", "fact_orders", "dim_customers", "customer_id", "customer_state", total("revenue", "price")
    ),
    "kpi_top_categories": _ranking(
        "Best-selling categories",
        "fact_orders",
        "dim_products",
        "product_id",
        "product_category_name_english",
        total("revenue", "price"),
        10,
    ),
    "kpi_top_seller_cities": _ranking(
        "Best-selling cities", "fact_orders", "dim_sellers", "seller_id", "seller_city", total("revenue", "price"), 10
    ),
    "kpi_revenue_by_weekday": _ranking(
        "Revenue by weekday", "fact_orders", "dim_date", DATE_KEY, "day_name", total("revenue", "price")
    ),
    "kpi_revenue_weekend": _weekend("Weekend against weekday revenue", "fact_orders", total("revenue", "price")),
}

PAYMENTS: dict[str, Report] = {
    "kpi_payment_total": _figure(
        "Total payments", "fact_payments", total("total_payment_value", "payment_value", 2)
    ),
    "kpi_payment_by_type": _breakdown(
        "Payments by type", "fact_payments", "payment_type", total("total_revenue", "payment_value", 2), "measure"
    ),
    "kpi_payment_by_month": _monthly(
        "Payments by month", "fact_payments", [total("total_revenue", "payment_value", 2)], YEAR_MONTH_NUMBER
    ),
    "kpi_payment_average": _figure(
        "Average payment", "fact_payments", average("average_payment", "payment_value", 2)
    ),
    "kpi_installments_average": _figure(
        "Average installments", "fact_payments", average("average_installments", "payment_installments", 2)
    ),
    "kpi_installment_distribution": _breakdown(
        "Installment distribution", "fact_payments", "payment_installments", row_count("total_transactions"), "value"
    ),
    "kpi_top_payment_methods": _breakdown(
        "Payment methods by use", "fact_payments", "payment_type", row_count("total_transactions"), "measure"
    ),
    "kpi_highest_payments": _extremes(
        "Highest payments", "fact_payments", ("order_id", "payment_type", "payment_value"), "payment_value", True
    ),
    "kpi_payment_share": _breakdown(
        "Payment share", "fact_payments", "payment_type", total("revenue", "payment_value", 2), None
    ),
    "kpi_payment_weekend": _weekend(
        "Weekend against weekday payments", "fact_payments", total("total_revenue", "payment_value", 2)
    ),
}

REVIEWS: dict[str, Report] = {
    "kpi_review_average": _figure(
        "Average score", "fact_reviews", average("average_review_score", "review_score", 2)
    ),
    "kpi_review_distribution": _breakdown(
        "Score distribution", "fact_reviews", "review_score", row_count("total_reviews"), "value"
    ),
    "kpi_reviews_by_month": _monthly(
        "Reviews by month", "fact_reviews", [row_count("total_reviews")], YEAR_MONTH_NUMBER
    ),
    "kpi_review_average_by_month": _monthly(
        "Average score by month", "fact_reviews", [average("average_review", "review_score", 2)], YEAR_MONTH_NUMBER
    ),
    "kpi_reviews_weekend": _weekend("Weekend against weekday reviews", "fact_reviews", row_count("total_reviews")),
    "kpi_lowest_reviews": _extremes(
        "Lowest scores", "fact_reviews", ("order_id", "review_score"), "review_score", False
    ),
    "kpi_highest_reviews": _extremes(
        "Highest scores", "fact_reviews", ("order_id", "review_score"), "review_score", True
    ),
    "kpi_review_score_share": _breakdown(
        "Score share", "fact_reviews", "review_score", row_count("total_reviews"), "value"
    ),
    "kpi_reviews_by_weekday": _ranking(
        "Reviews by weekday", "fact_reviews", "dim_date", DATE_KEY, "day_name", row_count("total_reviews")
    ),
    "kpi_review_trend": _monthly(
        "Review trend",
        "fact_reviews",
        [average("average_score", "review_score", 2), row_count("total_reviews")],
        YEAR_MONTH,
    ),
}

REPORTS: dict[str, Report] = {**SALES, **PAYMENTS, **REVIEWS}


def run(name: str, gold: Callable[[str], DataFrame]) -> DataFrame:
    """One report, its gold tables fetched by name."""
    report = REPORTS[name]
    return report.build(*[gold(table) for table in report.inputs])
