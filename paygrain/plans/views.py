"""The nine report views.

Each view is a function from star-schema tables to a DataFrame. Where a view groups by
dimension attributes, the fact is first aggregated by the dimension's key and the attributes
are attached to that much smaller result: the join then carries one row per key, so no key is
hot in it. Dimension primary keys are unique, as the data-quality checks require.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paygrain.functions.dates import month_bit, month_word, transaction_date, transaction_month
from paygrain.functions.measures import measure, report, reported, roll_up, with_distinct_members
from paygrain.functions.money import as_double, limbs, ratio
from paygrain.operators.ordering import ntile, percent_rank, with_global_ranks, with_positions
from paygrain.operators.velocity import with_trailing_totals
from paygrain.schema import DECLINED
from paygrain.sources.tables import register_views


def payment_performance_daily(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    daily = measure(fact, transaction_date(fact), "country_id", "channel", "payment_method")
    named = daily.join(dim_country.select("country_id", "country_name", "region"), "country_id", "left")
    return report(
        named,
        ["transaction_date", "country_id", "country_name", "region", "channel", "payment_method"],
        [
            "transaction_count", "transaction_value_usd", "average_transaction_value_usd",
            "approved_transactions", "declined_transactions", "fraud_transactions", "fraud_loss_usd",
            "cross_border_transactions", "average_processing_time_ms",
            "approval_rate", "decline_rate", "fraud_rate", "cross_border_rate",
        ],
    )


def decline_analysis_monthly(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Reason totals beside their segment totals, from one scan.

    The two totals meet on all six segment columns, and null never equals null there: a
    segment whose country or other key is unknown has no row.
    """
    segment = ["month", "country_id", "channel", "payment_method"]
    declined = F.coalesce(F.col("transaction_status") == DECLINED, F.lit(False))
    counts = fact.groupBy(
        transaction_month(fact), "country_id", "channel", "payment_method",
        declined.alias("is_declined"), F.when(declined, F.col("decline_reason")).alias("decline_reason"),
    ).agg(F.count(F.lit(1)).alias("n"))
    of_segment = Window.partitionBy(*segment)
    totals = counts.dropna(subset=segment).withColumns(
        {
            "transaction_count": F.sum("n").over(of_segment),
            "declined_transactions": F.sum(F.when(F.col("is_declined"), F.col("n")).otherwise(0)).over(of_segment),
        }
    )
    country = dim_country.select("country_id", "country_name", "region").dropna()
    return totals.where("is_declined").join(country, "country_id").select(
        "month", "country_id", "country_name", "region", "channel", "payment_method", "decline_reason",
        "transaction_count", "declined_transactions", F.col("n").alias("decline_reason_count"),
        ratio("declined_transactions", "transaction_count").alias("decline_rate"),
        ratio(F.col("n"), F.col("declined_transactions")).alias("share_of_declines"),
    )


MERCHANT_ATTRIBUTES = [
    "merchant_name", "merchant_category", "merchant_country", "merchant_size", "merchant_tier",
    "merchant_risk_rating",
]


def merchant_intelligence(
    fact: DataFrame, dim_merchant: DataFrame, cut: float = 0.75, ranges: int | None = None
) -> DataFrame:
    merchants = measure(fact, "merchant_id").join(
        dim_merchant.select("merchant_id", *MERCHANT_ATTRIBUTES), "merchant_id"
    )
    merchants = report(
        merchants,
        ["merchant_id", *MERCHANT_ATTRIBUTES],
        [
            "transaction_count", "transaction_value_usd", "average_transaction_value_usd", "approval_rate",
            "decline_rate", "fraud_rate", "fraud_loss_usd", "cross_border_rate", "average_processing_time_ms",
        ],
    )
    ranked, n = with_global_ranks(
        merchants,
        {
            "value_percentile": [F.col("transaction_value_usd")],
            "fraud_loss_percentile": [F.col("fraud_loss_usd")],
            "decline_percentile": [F.col("decline_rate")],
        },
        ranges,
    )
    percentiles = ["value_percentile", "fraud_loss_percentile", "decline_percentile"]
    ranked = ranked.withColumns({name: percent_rank(name, n) for name in percentiles})
    valuable = F.col("value_percentile") >= cut
    risky = (
        (F.col("merchant_risk_rating") == "High")
        | (F.col("fraud_loss_percentile") >= cut)
        | (F.col("decline_percentile") >= cut)
    )
    segment = (
        F.when(valuable & risky, "High Value / Elevated Risk")
        .when(valuable, "High Value")
        .when(risky, "Elevated Risk")
        .otherwise("Core Portfolio")
    )
    return ranked.withColumn("merchant_priority_segment", segment)


CUSTOMER_ATTRIBUTES = ["customer_segment", "home_country", "account_tenure_months", "risk_segment"]


def customer_analytics(
    fact: DataFrame,
    dim_customer: DataFrame,
    tiles: int = 5,
    low_months: int = 3,
    ranges: int | None = None,
) -> DataFrame:
    """Equal spend or activity is ordered by customer id.

    Active months are counted without a distinct aggregate: a customer's months are bits of
    64-month words, so that the first grouping leaves a row or two per customer.
    """
    day = transaction_date(fact)
    per_word = measure(
        fact, "customer_id", month_word(day).alias("word"),
        extra=[F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.bit_or(month_bit(day)).alias("months")],
    )
    customers = roll_up(
        per_word, "customer_id",
        extra=[
            F.min("first_day").alias("first_transaction_date"),
            F.max("last_day").alias("last_transaction_date"),
            F.coalesce(F.sum(F.bit_count("months").cast("bigint")), F.lit(0).cast("bigint")).alias("active_months"),
        ],
    )
    customers = report(
        customers.join(dim_customer.select("customer_id", *CUSTOMER_ATTRIBUTES), "customer_id"),
        [
            "customer_id", *CUSTOMER_ATTRIBUTES,
            "first_transaction_date", "last_transaction_date", "active_months",
        ],
        [
            "transaction_count", "transaction_value_usd", "average_transaction_value_usd",
            "approval_rate", "cross_border_rate", "fraud_rate", "fraud_loss_usd",
        ],
    )
    value, count = F.col("transaction_value_usd"), F.col("transaction_count")
    # Descending with nulls last, then by customer: no two rows are equal.
    orders = {
        "spend_quintile": [value.isNull(), -value, F.col("customer_id")],
        "activity_quintile": [-count, F.col("customer_id")],
    }
    ranked, n = customers, 0
    for name, order in orders.items():
        ranked, n = with_positions(ranked, order, name, ranges)
    ranked = ranked.withColumns({name: ntile(name, n, tiles) for name in ("spend_quintile", "activity_quintile")})
    top_spend, top_activity = F.col("spend_quintile") == 1, F.col("activity_quintile") == 1
    segment = (
        F.when(top_spend & top_activity, "High Value / High Activity")
        .when(top_spend, "High Value")
        .when(top_activity, "High Activity")
        .when(F.col("active_months") <= low_months, "Low Engagement")
        .otherwise("Core Customer")
    )
    return ranked.withColumn("behavioural_segment", segment)


RISK_SEGMENT = [
    "merchant_category", "merchant_risk_rating", "customer_risk_segment", "channel", "payment_method",
    "is_cross_border",
]


def risk_measures(fact: DataFrame, dim_merchant: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Additive measures per fraud-risk segment.

    Three narrow attributes are joined to the payments, then one grouping by columns of few values
    combines them in the tasks. Spark broadcasts the dimensions that it measures as small; of a
    shuffled join AQE splits the partitions of hot keys.
    """
    merchants = dim_merchant.select("merchant_id", "merchant_category", "merchant_risk_rating")
    customers = dim_customer.select("customer_id", F.col("risk_segment").alias("customer_risk_segment"))
    return measure(fact.join(merchants, "merchant_id").join(customers, "customer_id"), *RISK_SEGMENT)


def fraud_risk_segments(fact: DataFrame, dim_merchant: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return report(
        risk_measures(fact, dim_merchant, dim_customer),
        RISK_SEGMENT,
        [
            "transaction_count", "transaction_value_usd", "fraud_transactions", "fraud_rate",
            "fraud_loss_usd", "fraud_loss_rate", "decline_rate", "average_processing_time_ms",
        ],
    )


def transaction_velocity(
    fact: DataFrame,
    short: int = 3600,
    long: int = 86400,
    high: tuple[int, float] = (8, 1500),
    elevated: tuple[int, float] = (5, 750),
) -> DataFrame:
    rolling = with_trailing_totals(fact, {"1h": short, "24h": long})

    def reaches(limits: tuple[int, float]) -> Column:
        return (F.col("customer_transactions_1h") >= limits[0]) | (F.col("customer_value_usd_1h") >= limits[1])

    band = (
        F.when(reaches(high), "High Velocity").when(reaches(elevated), "Elevated Velocity").otherwise("Normal Velocity")
    )
    return rolling.withColumns({"velocity_band": band, "velocity_alert": reaches(high)})


FLAT = 1e-9  # a deviation below this is rounding noise of a constant baseline


def merchant_daily_anomalies(
    fact: DataFrame,
    window: int = 14,
    min_obs: int = 7,
    z: float = 3.0,
    min_signals: int = 1,
    min_value: float = 0.0,
    flat: float = FLAT,
) -> DataFrame:
    """Merchant days against the merchant's previous ``window`` observed days.

    A deviation below ``flat`` is that of a constant baseline and gives no z-score.
    ``min_signals`` and ``min_value`` narrow the alerts to days with several signals or a
    material value.
    """
    days = report(
        measure(fact, "merchant_id", transaction_date(fact)),
        ["merchant_id", "transaction_date", *limbs("value")],
        [
            "transaction_count", "transaction_value_usd", "approval_rate", "fraud_rate", "fraud_loss_usd",
            "average_processing_time_ms",
        ],
    )
    before = Window.partitionBy("merchant_id").orderBy("transaction_date").rowsBetween(-window, -1)
    whole, millionths = limbs("value")
    value_sum = as_double(F.sum(whole).over(before), F.sum(millionths).over(before))
    value_mean = ratio(value_sum, F.count(whole).over(before))
    days = days.withColumns(
        {
            "baseline_observations": F.count(F.lit(1)).over(before),
            "baseline_transaction_count": F.avg("transaction_count").over(before),
            "baseline_transaction_count_sd": F.stddev_samp("transaction_count").over(before),
            "baseline_transaction_value_usd": value_mean,
            "baseline_transaction_value_sd": F.stddev_samp("transaction_value_usd").over(before),
            "baseline_approval_rate": F.avg("approval_rate").over(before),
            "baseline_approval_rate_sd": F.stddev_samp("approval_rate").over(before),
        }
    ).drop(whole, millionths)

    def score(measured: str, mean: str, deviation: str) -> Column:
        return F.when(F.col(deviation) >= flat, (F.col(measured) - F.col(mean)) / F.col(deviation))

    days = days.withColumns(
        {
            "transaction_count_zscore": score(
                "transaction_count", "baseline_transaction_count", "baseline_transaction_count_sd"
            ),
            "transaction_value_zscore": score(
                "transaction_value_usd", "baseline_transaction_value_usd", "baseline_transaction_value_sd"
            ),
            "approval_rate_zscore": score("approval_rate", "baseline_approval_rate", "baseline_approval_rate_sd"),
        }
    )
    zero = F.lit(0.0)
    signals = (
        (F.abs(F.coalesce("transaction_count_zscore", zero)) >= z).cast("int")
        + (F.abs(F.coalesce("transaction_value_zscore", zero)) >= z).cast("int")
        + (F.coalesce("approval_rate_zscore", zero) <= -z).cast("int")
    )
    flag = (F.col("baseline_observations") >= min_obs) & (signals >= min_signals)
    if min_value > 0:
        flag = flag & (F.coalesce("transaction_value_usd", zero) >= min_value)
    return days.withColumn("anomaly_flag", flag)


def executive_kpis_monthly(fact: DataFrame) -> DataFrame:
    """One row per month; the month-on-month window sees only those few rows."""
    by_month = fact.withColumn("month", transaction_month(fact))
    monthly = with_distinct_members(
        measure(by_month, "month"), by_month, ["month"],
        {"active_customers": "customer_id", "active_merchants": "merchant_id"},
    )
    monthly = monthly.select(
        "month",
        *[
            reported(name)
            for name in (
                "transaction_count", "transaction_value_usd", "average_transaction_value_usd", "approval_rate",
                "decline_rate", "fraud_rate", "fraud_loss_usd", "cross_border_rate",
            )
        ],
        "active_customers", "active_merchants", reported("average_processing_time_ms"),
    )
    in_order = Window.orderBy("month")
    lagged = monthly.withColumns(
        {
            f"prior_{name}": F.lag(name).over(in_order)
            for name in ("transaction_count", "transaction_value_usd", "approval_rate", "fraud_loss_usd")
        }
    )

    def change(name: str) -> Column:
        return ratio(F.col(name) - F.col(f"prior_{name}"), F.col(f"prior_{name}"))

    return lagged.withColumns(
        {
            "transaction_count_mom_change": change("transaction_count"),
            "transaction_value_mom_change": change("transaction_value_usd"),
            "approval_rate_mom_point_change": F.col("approval_rate") - F.col("prior_approval_rate"),
            "fraud_loss_mom_change": change("fraud_loss_usd"),
        }
    )


def fraud_model_features(
    fact: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame, dim_device: DataFrame, dim_country: DataFrame
) -> DataFrame:
    """One row per payment with the attributes known before its outcome.

    The dimensions are left-joined on unique keys. Spark broadcasts those it measures below
    the broadcast threshold; a larger one is shuffled, and AQE splits the partitions of hot
    keys on the fact side.
    """
    joined = (
        fact.join(
            dim_customer.select(
                "customer_id", "customer_segment", "account_tenure_months",
                F.col("risk_segment").alias("customer_risk_segment"),
            ),
            "customer_id", "left",
        )
        .join(
            dim_merchant.select(
                "merchant_id", "merchant_category", "merchant_size", "merchant_tier", "merchant_risk_rating"
            ),
            "merchant_id", "left",
        )
        .join(dim_device.select("device_id", "device_type", "operating_system"), "device_id", "left")
        .join(dim_country.select("country_id", F.col("region").alias("transaction_region")), "country_id", "left")
    )
    stamp = F.col("transaction_timestamp")
    return joined.select(
        "transaction_id", "transaction_timestamp", transaction_date(fact),
        F.hour(stamp).alias("transaction_hour"),
        F.dayofweek(stamp).alias("day_of_week_num"),
        F.month(stamp).alias("transaction_month"),
        "transaction_amount_usd", "payment_method", "channel", "is_cross_border", "processing_time_ms",
        "customer_segment", "account_tenure_months", "customer_risk_segment",
        "merchant_category", "merchant_size", "merchant_tier", "merchant_risk_rating",
        "device_type", "operating_system", "transaction_region", "is_fraud",
    )


def register_report_views(
    spark: SparkSession, fact: DataFrame, dim_merchant: DataFrame, dim_customer: DataFrame,
    dim_device: DataFrame, dim_country: DataFrame,
) -> list[str]:
    """Register the nine reports as temporary views and return their names.

    ``merchant_intelligence`` and ``customer_analytics`` rank all rows, which is done once, when
    they are registered: they are snapshots. The other seven are computed when they are read.
    """
    reports = {
        "payment_performance_daily": payment_performance_daily(fact, dim_country),
        "decline_analysis_monthly": decline_analysis_monthly(fact, dim_country),
        "merchant_intelligence": merchant_intelligence(fact, dim_merchant),
        "customer_analytics": customer_analytics(fact, dim_customer),
        "fraud_risk_segments": fraud_risk_segments(fact, dim_merchant, dim_customer),
        "transaction_velocity": transaction_velocity(fact),
        "merchant_daily_anomalies": merchant_daily_anomalies(fact),
        "executive_kpis_monthly": executive_kpis_monthly(fact),
        "fraud_model_features": fraud_model_features(fact, dim_customer, dim_merchant, dim_device, dim_country),
    }
    register_views(spark, reports)
    return list(reports)
