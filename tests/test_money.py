"""Exact money totals in whole units and millionths."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from paygrain.functions.money import dollars, finer_than_money, money_sums


def summed(spark, amounts):
    frame = spark.createDataFrame([(a,) for a in amounts], "x double")
    totals = frame.agg(*(c.alias(n) for n, c in money_sums("x", "t").items()))
    return totals.select(dollars("t").alias("d")).first().d


@given(st.lists(st.decimals(-5_000_000, 5_000_000, places=6), min_size=1, max_size=12))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_sums_are_the_nearest_doubles(spark, amounts):
    assert summed(spark, map(float, amounts)) == float(sum(amounts))


def test_tenths_add_up_in_any_partitioning(spark):
    frame = spark.range(100_000).select(F.lit(0.1).alias("x"))
    for parts in (1, 7):
        totals = frame.repartition(parts).agg(*(c.alias(n) for n, c in money_sums("x", "t").items()))
        assert totals.select(dollars("t")).first()[0] == 10_000.0


def test_totals_beyond_exact_doubles_and_signs(spark):
    big = [8_589_934_591.99, 8_589_934_591.99, 0.01]
    assert summed(spark, big * 3) == float(sum(Decimal(str(x)) for x in big) * 3)
    assert summed(spark, [-0.5, 0.25, -1.75]) == -2.0
    assert summed(spark, [-8e9, -8e9, -0.75]) == -16000000000.75


def test_nulls(spark):
    assert summed(spark, [None, None]) is None and summed(spark, []) is None and summed(spark, [None, 1.5]) == 1.5


@pytest.mark.parametrize("amounts", [[float("nan")], [1e30], [9e18, 9e18]])
def test_what_cannot_be_summed_raises(spark, amounts):
    with pytest.raises(ArithmeticException):
        summed(spark, amounts)


def test_finer_amounts(spark):
    rows = [(0.000001, False), (0.0000004, True), (12.3456789, True), (12.345678, False), (-0.0000004, True), (4e9 + 0.01, False)]
    found = spark.createDataFrame([(x,) for x, _ in rows], "x double").select(finer_than_money("x")).collect()
    assert [r[0] for r in found] == [fine for _, fine in rows]
