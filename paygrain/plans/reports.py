"""Summary reports read from the views and the risk measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.functions.measures import measure, report, roll_up
from paygrain.functions.money import MONEY_DIGITS, ratio
from paygrain.operators.ordering import share_of_few

HEADLINE = [
    "transaction_count", "transaction_value_usd", "approval_rate", "fraud_rate", "fraud_loss_usd",
    "cross_border_rate",
]


def portfolio_kpis(fact: DataFrame) -> DataFrame:
    return report(measure(fact), [], HEADLINE)


def monthly_trend(kpis: DataFrame) -> DataFrame:
    return kpis.select("month", "transaction_value_usd", "transaction_count", "approval_rate", "fraud_rate")


def channel_performance(fact: DataFrame) -> DataFrame:
    return report(measure(fact, "channel"), ["channel"], ["transaction_value_usd", "transaction_count", "approval_rate"])


def top_countries_by_value(fact: DataFrame, dim_country: DataFrame, n: int = 10) -> DataFrame:
    countries = measure(fact, "country_id").join(dim_country.select("country_id", "country_name"), "country_id", "left")
    return report(countries, ["country_id", "country_name"], ["transaction_value_usd", "transaction_count"]).orderBy(
        F.desc("transaction_value_usd"), "country_id"
    ).limit(n)


def _top_merchants(fact: DataFrame, dim_merchant: DataFrame, by: str, n: int) -> DataFrame:
    merchants = measure(fact, "merchant_id").join(dim_merchant.select("merchant_id", "merchant_name"), "merchant_id")
    return report(merchants, ["merchant_id", "merchant_name"], ["transaction_value_usd", "fraud_loss_usd"]).orderBy(
        F.desc(by), "merchant_id"
    ).limit(n)


def top_merchants_by_value(fact: DataFrame, dim_merchant: DataFrame, n: int = 10) -> DataFrame:
    return _top_merchants(fact, dim_merchant, "transaction_value_usd", n)


def top_merchants_by_fraud_loss(fact: DataFrame, dim_merchant: DataFrame, n: int = 10) -> DataFrame:
    return _top_merchants(fact, dim_merchant, "fraud_loss_usd", n)


def merchant_segment_summary(merchants: DataFrame) -> DataFrame:
    """Size, value, loss and approval of each merchant segment, with shares of the portfolio."""
    # A rate times its own count is a whole number again.
    approved = F.round(F.col("approval_rate") * F.col("transaction_count")).cast("bigint")
    segments = merchants.groupBy("merchant_priority_segment").agg(
        F.count(F.lit(1)).alias("merchants"),
        _exact_sum("transaction_value_usd").alias("transaction_value_usd"),
        _exact_sum("fraud_loss_usd").alias("fraud_loss_usd"),
        F.avg("approval_rate").alias("average_approval_rate"),
        ratio(F.sum(approved), F.sum("transaction_count")).alias("weighted_approval_rate"),
    )
    for column in ("merchants", "transaction_value_usd", "fraud_loss_usd"):
        segments = share_of_few(segments, column, f"share_of_{column.removesuffix('_usd').removeprefix('transaction_')}")
    return segments


def _exact_sum(dollars: str) -> Column:
    """Sum of amounts through decimals."""
    return F.sum(F.col(dollars).cast(f"decimal(28,{MONEY_DIGITS})")).cast("double")


def merchant_detail(merchants: DataFrame) -> DataFrame:
    """The merchant investigation table."""
    return merchants.select(
        "merchant_id", "merchant_name", "merchant_category", "merchant_country", "merchant_tier",
        "merchant_risk_rating", "merchant_priority_segment", "transaction_count", "transaction_value_usd",
        "approval_rate", "fraud_rate", "fraud_loss_usd",
    )


FRAUD_EXPOSURE = ["transaction_count", "fraud_transactions", "fraud_rate", "fraud_loss_usd", "fraud_loss_rate"]


def fraud_by_risk(risk: DataFrame) -> DataFrame:
    keys = ["merchant_risk_rating", "customer_risk_segment"]
    return report(roll_up(risk, *keys), keys, FRAUD_EXPOSURE)


def fraud_domestic_vs_cross(risk: DataFrame) -> DataFrame:
    """Domestic and cross-border fraud rates per risk pair, and how many times higher the latter is."""
    keys = ["merchant_risk_rating", "customer_risk_segment"]
    pairs = (
        risk.groupBy(*keys)
        .pivot("is_cross_border", [False, True])
        .agg(F.sum("fraud_n").alias("fraud"), F.sum("n").alias("n"))
    )
    return pairs.select(
        *keys,
        ratio("false_fraud", "false_n").alias("domestic_fraud_rate"),
        ratio("true_fraud", "true_n").alias("cross_border_fraud_rate"),
    ).withColumn("cross_to_domestic_ratio", ratio("cross_border_fraud_rate", "domestic_fraud_rate"))


def fraud_loss_by_merchant_risk(risk: DataFrame) -> DataFrame:
    return report(roll_up(risk, "merchant_risk_rating"), ["merchant_risk_rating"], ["fraud_loss_usd"])


def fraud_by_channel(risk: DataFrame) -> DataFrame:
    return report(roll_up(risk, "channel"), ["channel"], ["fraud_rate", "fraud_loss_usd"])


def customer_segment_summary(customers: DataFrame) -> DataFrame:
    def weighted(rate: str) -> Column:
        hits = F.round(F.col(rate) * F.col("transaction_count")).cast("bigint")
        return ratio(F.sum(hits), F.sum("transaction_count"))

    return customers.groupBy("behavioural_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("cross_border_rate").alias("average_cross_border_rate"),
        F.avg("fraud_rate").alias("average_fraud_rate"),
        weighted("cross_border_rate").alias("weighted_cross_border_rate"),
        weighted("fraud_rate").alias("weighted_fraud_rate"),
    )


def fraud_concentration(risk: DataFrame) -> DataFrame:
    """Each merchant-risk, customer-risk, cross-border cell against the portfolio's fraud rate."""
    keys = ["merchant_risk_rating", "customer_risk_segment", "is_cross_border"]
    cells = report(roll_up(risk, *keys), keys, FRAUD_EXPOSURE)
    all_cells = Window.partitionBy()  # a few risk combinations
    portfolio = ratio(F.sum("fraud_transactions").over(all_cells), F.sum("transaction_count").over(all_cells))
    return cells.withColumn("multiple_of_portfolio_rate", ratio(F.col("fraud_rate"), portfolio))


def velocity_band_summary(velocity: DataFrame) -> DataFrame:
    bands = report(
        measure(velocity, "velocity_band"), ["velocity_band"],
        ["transaction_count", "fraud_transactions", "fraud_rate", "fraud_loss_usd", "transaction_value_usd"],
    )
    all_bands = Window.partitionBy()  # three rows
    normal = F.max(F.when(F.col("velocity_band") == "Normal Velocity", F.col("fraud_rate"))).over(all_bands)
    summary = bands.withColumn("ratio_to_normal", ratio(F.col("fraud_rate"), normal))
    shares = {
        "share_of_transactions": "transaction_count",
        "share_of_fraud": "fraud_transactions",
        "share_of_fraud_loss": "fraud_loss_usd",
        "share_of_value": "transaction_value_usd",
    }
    for name, column in shares.items():
        summary = share_of_few(summary, column, name)
    return summary


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    flagged = F.col("anomaly_flag")
    per_merchant = anomalies.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(flagged).alias("flagged"),
        *[F.sum(F.when(flagged, value)).alias(f"{name}_sum") for name, value in _flag_scores().items()],
        *[F.count(F.when(flagged, value)).alias(f"{name}_n") for name, value in _flag_scores().items()],
    )
    return per_merchant.agg(
        F.coalesce(F.sum("days"), F.lit(0)).alias("merchant_days"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged_days"),
        ratio(F.sum("flagged"), F.sum("days")).alias("alert_rate"),
        F.count_if(F.col("flagged") > 0).alias("merchants_flagged"),
        *[ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in _flag_scores()],
    )


def _flag_scores() -> dict[str, Column]:
    return {
        "mean_abs_count_zscore": F.abs("transaction_count_zscore"),
        "mean_abs_value_zscore": F.abs("transaction_value_zscore"),
        "mean_approval_zscore": F.col("approval_rate_zscore"),
    }


def executive_summary(kpis: DataFrame) -> DataFrame:
    """Growth from the first to the last month, the range of the rates and the extreme months."""
    first = {c: F.min_by(c, "month") for c in ("transaction_count", "transaction_value_usd")}
    last = {c: F.max_by(c, "month") for c in ("transaction_count", "transaction_value_usd")}
    return kpis.agg(
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        ratio(last["transaction_count"] - first["transaction_count"], first["transaction_count"]).alias("volume_growth"),
        ratio(
            last["transaction_value_usd"] - first["transaction_value_usd"], first["transaction_value_usd"]
        ).alias("value_growth"),
        *[
            expression.alias(name)
            for rate in ("approval_rate", "fraud_rate")
            for name, expression in {
                f"min_{rate}": F.min(rate),
                f"max_{rate}": F.max(rate),
                f"{rate}_spread": F.max(rate) - F.min(rate),
            }.items()
        ],
        *[
            F.max_by("month", F.struct(F.col(c), -F.unix_date("month"))).alias(f"highest_{name}_month")
            for name, c in {"volume": "transaction_count", "value": "transaction_value_usd"}.items()
        ],
        F.min_by("month", F.struct(F.col("fraud_loss_usd"), F.unix_date("month"))).alias("lowest_fraud_loss_month"),
    )
