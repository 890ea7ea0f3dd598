"""Dimension attributes, currency conversion and the scorecards, as columns over real rows.

Random draws of a simulation have no place here: where one was involved, the caller passes a
column for it or leaves it out.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain import schema as fixed
from paygrain.functions.dates import months_of_tenure
from paygrain.functions.money import clip, lookup, ratio, round_half_even
from paygrain.operators.ordering import share_of_few, share_of_total
from paygrain.schema import (
    APPROVED,
    CATEGORY_APPROVAL_DELTA,
    CATEGORY_FRAUD_FACTOR,
    MONTH_FACTOR,
    SEGMENT_CROSS_BORDER_RATE,
    USD_PER_UNIT,
    WEEKEND_FACTOR,
)

# --- calendar ------------------------------------------------------------------------------


def _with_date_parts(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day,
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar over the days from ``first_day`` to ``last_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return _with_date_parts(days)


def calendar_dim(spark: SparkSession, first_day: str | date, last_day: str | date) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(str(first_day)).cast("date").alias("first_day"), F.lit(str(last_day)).cast("date").alias("last_day")
    )
    return season_weights(calendar_between(bounds))


def season_weights(
    calendar: DataFrame, month_factor: dict[int, float] = MONTH_FACTOR, weekend: float = WEEKEND_FACTOR
) -> DataFrame:
    """Share of the year's activity expected on each day."""
    weight = lookup("month", month_factor) * F.when(F.col("is_weekend"), weekend).otherwise(1.0)
    return share_of_few(calendar, weight, "transaction_weight")


# --- dimension attributes ------------------------------------------------------------------


def market_share(table: DataFrame, weight: str, name: str = "market_weight") -> DataFrame:
    return share_of_total(table, weight, name)


def customer_tenure(signup: str | Column, reference: Column) -> Column:
    return months_of_tenure(F.col(signup) if isinstance(signup, str) else signup, reference)


def merchant_risk_rating(category: Column, country_multiplier: Column, noise: Column | None = None,
                         category_factor: dict[str, float] = CATEGORY_FRAUD_FACTOR) -> Column:
    score = lookup(category, category_factor) * country_multiplier
    if noise is not None:
        score = score * noise
    cuts = fixed.RISK_RATING_FROM
    return F.when(score >= cuts["High"], "High").when(score >= cuts["Medium"], "Medium").otherwise("Low")


def merchant_tier(size: Column) -> Column:
    return lookup(size, fixed.TIER_BY_SIZE)


def surrogate_key(number: Column, prefix: str, width: int) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


# --- currency ------------------------------------------------------------------------------


def usd_rates(spark: SparkSession, rates: dict[str, float] = USD_PER_UNIT) -> DataFrame:
    """The fixed conversion factors as a (currency, usd_rate) table."""
    return spark.createDataFrame(list(rates.items()), "currency string, usd_rate double")


def fx_missing(table: DataFrame, rates: DataFrame) -> DataFrame:
    """Currencies in use that have no rate."""
    return table.select("currency").distinct().join(rates.select("currency"), "currency", "left_anti")


def require_fx(table: DataFrame, rates: DataFrame) -> None:
    missing = sorted(str(row["currency"]) for row in fx_missing(table, rates).collect())
    if missing:
        raise ValueError(f"Missing USD rate for currencies: {missing}")


def fx_convert(table: DataFrame, rates: DataFrame) -> DataFrame:
    """Local-currency amount from the USD amount: two decimals, at least 0.01."""
    local = F.greatest(round_half_even(F.col("transaction_amount_usd") / F.col("usd_rate"), 2), F.lit(fixed.SMALLEST_LOCAL_AMOUNT))
    converted = table.join(rates.select("currency", "usd_rate"), "currency", "left")
    return converted.withColumn("transaction_amount", local).drop("usd_rate")


# --- scorecards ----------------------------------------------------------------------------


def cross_border_flag(merchant_country: Column, home_country: Column) -> Column:
    return merchant_country != home_country


def _within(probability: Column, bounds: tuple[float, float]) -> Column:
    """Clip a probability; one that misses a factor stays null."""
    return F.when(probability.isNotNull(), clip(probability, *bounds))


def fraud_scorecard(
    category: Column,
    customer_risk: Column,
    merchant_risk: Column,
    hour: Column,
    is_cross_border: Column,
    channel: Column,
    amount_usd: Column,
    category_factor: dict[str, float] = CATEGORY_FRAUD_FACTOR,
) -> Column:
    """Expected probability of fraud: a product of factors, kept within plausible bounds."""
    at_night = (hour <= fixed.NIGHT_HOURS_UNTIL) | (hour >= fixed.NIGHT_HOURS_FROM)
    factors = [
        lookup(category, category_factor),
        lookup(customer_risk, fixed.CUSTOMER_RISK_FACTOR),
        lookup(merchant_risk, fixed.MERCHANT_RISK_FACTOR),
        F.when(at_night, fixed.NIGHT_FRAUD_FACTOR).otherwise(1.0),
        F.when(is_cross_border, fixed.CROSS_BORDER_FRAUD_FACTOR).otherwise(1.0),
        F.when(channel == "card_present", fixed.CARD_PRESENT_FRAUD_FACTOR).otherwise(fixed.REMOTE_FRAUD_FACTOR),
        F.when(amount_usd >= fixed.LARGE_AMOUNT_USD, fixed.LARGE_AMOUNT_FRAUD_FACTOR)
        .when(amount_usd >= fixed.MEDIUM_AMOUNT_USD, fixed.MEDIUM_AMOUNT_FRAUD_FACTOR)
        .otherwise(1.0),
    ]
    probability = reduce(lambda product, factor: product * factor, factors, F.lit(fixed.BASE_FRAUD_RATE))
    return _within(probability, fixed.FRAUD_PROBABILITY_RANGE)


def approval_scorecard(
    category: Column,
    channel: Column,
    is_cross_border: Column,
    customer_risk: Column,
    merchant_risk: Column,
    amount_usd: Column,
    is_fraud: Column,
    category_delta: dict[str, float] = CATEGORY_APPROVAL_DELTA,
) -> Column:
    """Expected probability of approval: a base rate and a sum of deltas, within bounds."""
    def when(condition: Column, delta: float, otherwise: float = 0.0) -> Column:
        return F.when(condition, delta).otherwise(otherwise)

    deltas = [
        lookup(category, category_delta),
        when(channel == "card_present", fixed.CARD_PRESENT_APPROVAL_DELTA, fixed.REMOTE_APPROVAL_DELTA),
        when(is_cross_border, fixed.CROSS_BORDER_APPROVAL_DELTA),
        when(customer_risk == "High", fixed.HIGH_RISK_CUSTOMER_APPROVAL_DELTA),
        when(merchant_risk == "High", fixed.HIGH_RISK_MERCHANT_APPROVAL_DELTA),
        when(amount_usd >= fixed.LARGE_AMOUNT_USD, fixed.LARGE_AMOUNT_APPROVAL_DELTA),
        when(is_fraud, fixed.FRAUD_APPROVAL_DELTA),
    ]
    probability = reduce(lambda total, delta: total + delta, deltas, F.lit(fixed.BASE_APPROVAL_RATE))
    return _within(probability, fixed.APPROVAL_PROBABILITY_RANGE)


def cross_border_propensity(
    customer_segment: Column, channel: Column, segment_rate: dict[str, float] = SEGMENT_CROSS_BORDER_RATE
) -> Column:
    uplift = F.when(channel.isin(fixed.DIGITAL_CHANNELS), fixed.DIGITAL_CROSS_BORDER_UPLIFT).otherwise(0.0)
    return _within(lookup(customer_segment, segment_rate) + uplift, fixed.CROSS_BORDER_PROBABILITY_RANGE)


def expected_processing_time(is_cross_border: Column, payment_method: Column, channel: Column) -> Column:
    time = (
        F.lit(fixed.TYPICAL_PROCESSING_MS)
        * F.when(is_cross_border, fixed.CROSS_BORDER_TIME_FACTOR).otherwise(1.0)
        * F.when(payment_method == "bank_transfer", fixed.BANK_TRANSFER_TIME_FACTOR).otherwise(1.0)
        * F.when(channel == "web", fixed.WEB_TIME_FACTOR).otherwise(1.0)
    )
    return F.rint(clip(time, *fixed.PROCESSING_TIME_RANGE_MS)).cast("int")


def fraud_loss(amount_usd: Column, loss_fraction: Column, is_fraud: Column, status: Column) -> Column:
    """Loss of approved fraud, zero for everything else."""
    return F.when(is_fraud & (status == APPROVED), round_half_even(amount_usd * loss_fraction, 2)).otherwise(0.0)


def with_expectations(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_merchant: DataFrame,
    category_factor: dict[str, float] = CATEGORY_FRAUD_FACTOR,
    category_delta: dict[str, float] = CATEGORY_APPROVAL_DELTA,
    segment_rate: dict[str, float] = SEGMENT_CROSS_BORDER_RATE,
) -> DataFrame:
    """The fact table with the attributes the scorecards need and their expected values."""
    customers = dim_customer.select("customer_id", "customer_segment", "risk_segment")
    merchants = dim_merchant.select("merchant_id", "merchant_category", "merchant_risk_rating")
    c = F.col
    return (
        fact.join(merchants, "merchant_id")
        .join(customers, "customer_id")
        .withColumns(
            {
                "expected_fraud": fraud_scorecard(
                    c("merchant_category"), c("risk_segment"), c("merchant_risk_rating"),
                    F.hour("transaction_timestamp"), c("is_cross_border"), c("channel"),
                    c("transaction_amount_usd"), category_factor,
                ),
                "expected_approval": approval_scorecard(
                    c("merchant_category"), c("channel"), c("is_cross_border"), c("risk_segment"),
                    c("merchant_risk_rating"), c("transaction_amount_usd"), c("is_fraud"), category_delta,
                ),
                "expected_cross_border": cross_border_propensity(c("customer_segment"), c("channel"), segment_rate),
                "expected_processing_ms": expected_processing_time(
                    c("is_cross_border"), c("payment_method"), c("channel")
                ),
            }
        )
    )


def score_calibration(expectations: DataFrame, segment: list[str]) -> DataFrame:
    """Expected against actual rates and processing time per segment."""
    actual = {
        "fraud": F.col("is_fraud"),
        "approval": F.col("transaction_status") == APPROVED,
        "cross_border": F.col("is_cross_border"),
    }
    pairs = []
    for name, event in actual.items():
        pairs.append(F.avg(f"expected_{name}").alias(f"expected_{name}_rate"))
        pairs.append(ratio(F.count_if(event), F.count(F.lit(1))).alias(f"actual_{name}_rate"))
    return expectations.groupBy(*segment).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        *pairs,
        F.avg("expected_processing_ms").alias("expected_processing_time_ms"),
        F.avg("processing_time_ms").alias("actual_processing_time_ms"),
    )
