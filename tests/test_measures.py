"""Measures: exactness, rounding, special values, and the aggregate-before-join form."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.functions.measures import average, row_count, summarise, summarise_by_dimension, total
from tests.helpers import plan, rows


def _sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return summarise(df, (), [total("s", "x")]).first().s


def test_sum_is_exact_where_doubles_are_not(spark):
    assert _sum(spark, [0.1] * 10) == 1.0


@pytest.mark.parametrize("count", [1, 3, 8])
def test_sum_does_not_depend_on_partitions(spark, count):
    df = spark.range(1000).select((F.col("id") * 0.01 + 0.07).alias("x")).repartition(count)
    assert summarise(df, (), [total("s", "x")]).first().s == 5065.0


def test_special_amounts(spark):
    assert _sum(spark, []) is None
    assert _sum(spark, [None, 2.5]) == 2.5
    assert math.isnan(_sum(spark, [1.0, float("nan")]))
    assert _sum(spark, [1.0, float("inf")]) == float("inf")
    assert _sum(spark, [1.5, 1e15]) == 1e15 + 1.5


@pytest.mark.parametrize(("values", "expected"), [([1.0, 1.01], 1.01), ([2.0, 3.0], 2.5), ([1.0, 1.0, 2.0], 1.33)])
def test_average_rounds_half_up(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert summarise(df, (), [average("a", "x", 2)]).first().a == expected


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert summarise(df, (), [average("a", "x", 2), row_count("n")]).first() == (None, 1)


def test_rounded_sum_is_half_up_in_decimal(spark):
    df = spark.createDataFrame([(1.005,)], "x double")
    assert summarise(df, (), [total("s", "x", 2)]).first().s == 1.01


def test_no_digit_is_dropped(spark):
    df = spark.range(1_000_000)
    tiny = summarise(df.select(F.lit(4e-7).alias("x")), (), [total("s", "x"), average("a", "x")]).first()
    assert math.isclose(tiny.s, 0.4, rel_tol=1e-10) and math.isclose(tiny.a, 4e-7, rel_tol=1e-10)
    assert math.isclose(summarise(df.select(F.lit(1.00000049).alias("x")), (), [total("s", "x")]).first().s, 1000000.49, rel_tol=1e-12)
    assert math.isclose(_sum(spark, [1e12, 0.1, -1e12]), 0.1)
    assert _sum(spark, [1e12, -1e12]) == 0.0


cents = st.integers(0, 10_000).map(lambda c: c / 100)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    facts=st.lists(st.tuples(st.integers(0, 4), cents), max_size=30),
    dimension=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), max_size=8),
)
def test_aggregate_before_join_equals_plain_join(spark, facts, dimension):
    """Also with keys repeated in the dimension, keys without facts, and facts without a key."""
    f = spark.createDataFrame(facts, "k int, x double")
    d = spark.createDataFrame(dimension, "k int, label string")
    measures = [total("s", "x"), row_count("n"), average("a", "x", 2)]
    reduced = summarise_by_dimension(f, d, "k", ["label"], measures)
    plain = summarise(f.join(d, "k"), ["label"], measures)
    assert rows(reduced) == rows(plain)


def test_facts_are_aggregated_below_the_join(spark):
    f = spark.range(100).selectExpr("id % 7 AS k", "CAST(id AS double) AS x")
    d = spark.range(7).selectExpr("id AS k", "id % 2 AS label")
    text = plan(summarise_by_dimension(f, d, "k", ["label"], [total("s", "x")]))
    join = text.index("Join")
    assert "partial_sum(" in text[join:]
    assert "Window" not in text
