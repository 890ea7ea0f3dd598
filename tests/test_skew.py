"""One key with most of the rows: results stay whole and the plan spreads the work."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paygrain.operators import enrich
from paygrain.plans import views

SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL_LIMITS}
    for key, value in SMALL_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_fact(spark, payments, dimensions):
    """Two thirds of 30,000 payments belong to one customer and one merchant."""
    number = F.col("id")
    hot = number % 3 != 0
    template = payments({}).drop("transaction_id", "transaction_timestamp", "customer_id", "merchant_id")
    keys = spark.range(0, 30_000, 1, 12).select(
        number.alias("transaction_id"),
        F.timestamp_add("SECOND", number * 37, F.lit("2025-03-01").cast("timestamp_ntz")).alias("transaction_timestamp"),
        F.when(hot, "C1").otherwise(F.concat(F.lit("C"), number % 990 + 2)).alias("customer_id"),
        F.when(hot, "M1").otherwise(F.concat(F.lit("M"), number % 99 + 2)).alias("merchant_id"),
    )
    first = template.first().asDict()
    kinds = dict(template.dtypes)
    return keys.select("*", *[F.lit(v).cast(kinds[n]).alias(n) for n, v in first.items()]).select(
        *payments({}).columns
    )


@pytest.fixture
def many(spark):
    customers = spark.range(997).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.lit("Mass").alias("customer_segment"),
        F.lit("IRL").alias("home_country"), F.lit(3).alias("account_tenure_months"), F.lit("Low").alias("risk_segment"),
    )
    merchants = spark.range(101).select(
        F.concat(F.lit("M"), "id").alias("merchant_id"), F.lit("Shop").alias("merchant_name"),
        F.lit("Retail").alias("merchant_category"), F.lit("IRL").alias("merchant_country"),
        F.lit("Small").alias("merchant_size"), F.lit("Standard").alias("merchant_tier"),
        F.lit("Low").alias("merchant_risk_rating"),
    )
    return customers, merchants


def final_plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_feature_join_splits_the_hot_customer(small_limits, hot_fact, many, dimensions):
    features = views.fraud_model_features(
        hot_fact, *many, dimensions["dim_device"], dimensions["dim_country"]
    )
    rows = features.collect()
    assert len(rows) == 30_000 and all(r.customer_segment == "Mass" for r in rows)
    assert "skew=true" in final_plan(features)


def test_scorecard_join_splits_the_hot_customer(small_limits, hot_fact, many):
    expected = enrich.with_expectations(hot_fact, *many)
    assert len(expected.collect()) == 30_000
    assert "skew=true" in final_plan(expected)


def test_velocity_of_a_hot_customer(small_limits, hot_fact):
    rows = {r.transaction_id: r for r in views.transaction_velocity(hot_fact).collect()}
    assert len(rows) == 30_000
    # One payment every 37 seconds, two of three by the hot customer.
    late = rows[29_999]
    reach = 3600 // 37
    assert late.customer_transactions_1h == sum(i % 3 != 0 for i in range(29_999 - reach, 30_000))
    assert late.customer_transactions_24h == sum(i % 3 != 0 for i in range(29_999 - 86400 // 37, 30_000))


def test_reports_of_a_hot_customer(small_limits, hot_fact, many, monkeypatch):
    customers, merchants = many
    risk = views.fraud_risk_segments(hot_fact, merchants, customers)
    assert risk.agg(F.sum("transaction_count")).first()[0] == 30_000
    by_customer = views.customer_analytics(hot_fact, customers, ranges=20)
    assert by_customer.agg(F.sum("transaction_count")).first()[0] == 30_000
    assert by_customer.where("customer_id = 'C1' AND spend_quintile = 1 AND activity_quintile = 1").count() == 1
    by_merchant = views.merchant_intelligence(hot_fact, merchants, ranges=10)
    assert by_merchant.where("merchant_id = 'M1' AND value_percentile = 1.0").count() == 1
