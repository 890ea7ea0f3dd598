"""Scorecards, ratings, currency and keys against values worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from paygrain.functions.dates import event_time
from paygrain.functions.money import ratio, round_half_even
from paygrain.operators import enrich


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def fraud(spark, **changes):
    inputs = {
        "category": "Retail", "customer_risk": "Low", "merchant_risk": "Low", "hour": 12, "is_cross_border": False,
        "channel": "card_present", "amount_usd": 10.0, **changes,
    }
    return value(spark, enrich.fraud_scorecard(**{k: F.lit(v) for k, v in inputs.items()}))


def test_fraud_scorecard(spark):
    assert fraud(spark) == pytest.approx(0.0018 * 0.75 * 0.80 * 0.72)
    assert fraud(spark, hour=23, channel="web", amount_usd=300.0) == pytest.approx(
        0.0018 * 0.75 * 0.80 * 1.45 * 1.28 * 1.25
    )
    assert fraud(spark, category="Grocery", amount_usd=1.0) == pytest.approx(0.0018 * 0.70 * 0.75 * 0.80 * 0.72)
    extreme = {
        "category": "Digital Goods", "customer_risk": "High", "merchant_risk": "High", "hour": 2,
        "is_cross_border": True, "channel": "web", "amount_usd": 750.0,
    }
    assert fraud(spark, **extreme) == 0.08
    assert fraud(spark, category="Unknown") is None


def test_fraud_scorecard_floor(spark):
    low = enrich.fraud_scorecard(
        F.lit("x"), F.lit("Low"), F.lit("Low"), F.lit(12), F.lit(False), F.lit("card_present"), F.lit(1.0), {"x": 0.01}
    )
    assert value(spark, low) == 0.00015


def test_approval_scorecard(spark):
    def approval(**changes):
        inputs = {
            "category": "Retail", "channel": "web", "is_cross_border": False, "customer_risk": "Low",
            "merchant_risk": "Low", "amount_usd": 10.0, "is_fraud": False, **changes,
        }
        return value(spark, enrich.approval_scorecard(**{k: F.lit(v) for k, v in inputs.items()}))

    assert approval() == pytest.approx(0.941)
    assert approval(is_cross_border=True, customer_risk="High") == pytest.approx(0.861)
    worst = approval(
        category="Digital Goods", is_cross_border=True, customer_risk="High", merchant_risk="High", amount_usd=750.0,
        is_fraud=True,
    )
    assert worst == pytest.approx(0.945 - 0.025 - 0.004 - 0.03 - 0.05 - 0.035 - 0.025 - 0.3)
    capped = enrich.approval_scorecard(
        F.lit("x"), F.lit("card_present"), F.lit(False), F.lit("Low"), F.lit("Low"), F.lit(1.0), F.lit(False), {"x": 0.5}
    )
    assert value(spark, capped) == 0.995
    floored = enrich.approval_scorecard(
        F.lit("x"), F.lit("web"), F.lit(False), F.lit("Low"), F.lit("Low"), F.lit(1.0), F.lit(False), {"x": -0.9}
    )
    assert value(spark, floored) == 0.45


def test_propensity_and_processing_time(spark):
    assert value(spark, enrich.cross_border_propensity(F.lit("Mass"), F.lit("card_present"))) == 0.08
    assert value(spark, enrich.cross_border_propensity(F.lit("Mass"), F.lit("web"))) == pytest.approx(0.105)
    high = enrich.cross_border_propensity(F.lit("x"), F.lit("web"), {"x": 0.59})
    assert value(spark, high) == 0.60
    assert value(spark, enrich.expected_processing_time(F.lit(False), F.lit("credit_card"), F.lit("in_app"))) == 420
    slow = enrich.expected_processing_time(F.lit(True), F.lit("bank_transfer"), F.lit("web"))
    assert value(spark, slow) == round(420 * 1.2 * 1.45 * 1.08)


def test_fraud_loss_only_of_approved_fraud(spark):
    def loss(fraud, status):
        return value(spark, enrich.fraud_loss(F.lit(10.0), F.lit(0.555), F.lit(fraud), F.lit(status)))

    assert (loss(True, "approved"), loss(True, "declined"), loss(False, "approved")) == (5.55, 0.0, 0.0)


def test_ratings_tiers_tenure_and_keys(spark):
    def rating(category, multiplier, noise=None):
        return value(spark, enrich.merchant_risk_rating(F.lit(category), F.lit(multiplier), noise))

    assert [rating("Travel", 1.0), rating("Retail", 1.1), rating("Retail", 1.0)] == ["High", "Medium", "Low"]
    assert rating("Retail", 1.0, F.lit(1.45)) == "High"
    assert value(spark, enrich.merchant_tier(F.lit("Enterprise"))) == "Strategic"
    assert value(spark, enrich.merchant_tier(F.lit("Huge"))) is None
    reference = F.lit(date(2025, 12, 31))
    assert value(spark, enrich.customer_tenure(F.lit(date(2025, 12, 1)), reference)) == 0
    assert value(spark, enrich.customer_tenure(F.lit(date(2024, 12, 31)), reference)) == 11
    assert value(spark, enrich.customer_tenure(F.lit(date(2026, 5, 1)), reference)) == 0
    assert value(spark, enrich.surrogate_key(F.lit(42), "M", 6)) == "M000042"


def test_event_time(spark):
    made = event_time(F.lit(date(2025, 2, 3)), F.lit(4), F.lit(5), F.lit(6))
    assert value(spark, made) == datetime(2025, 2, 3, 4, 5, 6)


def test_currency(spark, payments):
    rates = enrich.usd_rates(spark)
    fact = payments({"transaction_amount_usd": 11.0}, {"currency": "JPY", "transaction_amount_usd": 0.00001})
    amounts = {r.currency: r.transaction_amount for r in enrich.fx_convert(fact, rates).collect()}
    assert amounts == {"EUR": 10.0, "JPY": 0.01}
    enrich.require_fx(fact, rates)
    odd = payments({"currency": "XAU"}, {"currency": "XAU"}, {"currency": "ABC"}, {})
    with pytest.raises(ValueError, match=r"\['ABC', 'XAU'\]"):
        enrich.require_fx(odd, rates)


def test_rounding_and_division(spark):
    assert [value(spark, round_half_even(F.lit(v))) for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None


def test_calibration(payments, dimensions):
    fact = payments({}, {"channel": "card_present", "is_fraud": True})
    rows = enrich.score_calibration(
        enrich.with_expectations(fact, dimensions["dim_customer"], dimensions["dim_merchant"]), ["channel"]
    )
    found = {r.channel: r for r in rows.collect()}
    assert found["card_present"].actual_fraud_rate == 1.0
    assert found["card_present"].expected_fraud_rate == pytest.approx(0.0018 * 0.75 * 0.80 * 0.72)
    assert found["web"].expected_processing_time_ms == round(420 * 1.08)
