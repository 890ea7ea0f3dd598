"""The documented metric layer: every metric by name, grouped by any keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.functions.measures import measure, meet, reported, with_distinct_members
from paygrain.functions.money import dollars, ratio
from paygrain.operators.quantiles import exact_quantiles
from paygrain.schema import DECLINED

# Metric name -> report column computed from additive measures.
SIMPLE = {
    "transaction_volume": "transaction_count",
    "transaction_value": "transaction_value_usd",
    "approved_transactions": "approved_transactions",
    "declined_transactions": "declined_transactions",
    "approval_rate": "approval_rate",
    "decline_rate": "decline_rate",
    "approved_payment_value": "approved_payment_value_usd",
    "average_transaction_value": "average_transaction_value_usd",
    "fraud_transactions": "fraud_transactions",
    "fraud_transaction_rate": "fraud_rate",
    "fraud_loss": "fraud_loss_usd",
    "fraud_loss_rate": "fraud_loss_rate_approved",
    "cross_border_transactions": "cross_border_transactions",
    "cross_border_transaction_rate": "cross_border_rate",
    "average_processing_time": "average_processing_time_ms",
}
MERCHANT_METRICS = ["transaction_volume", "approved_payment_value", "approval_rate", "fraud_transaction_rate"]


def metric(name: str) -> Column:
    """A metric as a column over measures and active counts."""
    if name in SIMPLE:
        return reported(SIMPLE[name]).alias(name)
    others = {
        "active_customers": F.col("active_customers"),
        "transactions_per_customer": ratio(F.col("n"), F.col("active_customers")),
        "payment_value_per_customer": ratio(dollars("value"), F.col("active_customers")),
        "approved_value_per_customer": ratio(dollars("approved"), F.col("active_customers")),
        "active_merchants": F.col("active_merchants"),
        "p95_processing_time": F.col("p95_processing_time"),
    }
    return others[name].alias(name)


ALL_METRICS = [
    *SIMPLE, "active_customers", "transactions_per_customer", "payment_value_per_customer",
    "approved_value_per_customer", "active_merchants", "p95_processing_time",
]


def p95_processing_time(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Interpolated 95th percentile, exact, whatever the number of distinct times."""
    found = exact_quantiles(fact, ["processing_time_ms"], [0.95], keys)
    return found.select(*keys, F.col("value").alias("p95_processing_time"))


def metric_catalogue(fact: DataFrame, keys: list[str], names: list[str] | None = None) -> DataFrame:
    """The named metrics (all by default), one row per combination of ``keys``."""
    names = names or ALL_METRICS
    members = {}
    if any("customer" in name for name in names):
        members["active_customers"] = "customer_id"
    if "active_merchants" in names:
        members["active_merchants"] = "merchant_id"
    groups = measure(fact, *keys)
    if members:
        groups = with_distinct_members(groups, fact, keys, members)
    if "p95_processing_time" in names:
        groups = meet(groups, p95_processing_time(fact, keys), keys)
    return groups.select(*keys, *[metric(name) for name in names])


def merchant_metrics(fact: DataFrame) -> DataFrame:
    return metric_catalogue(fact, ["merchant_id"], MERCHANT_METRICS)


def decline_reason_share(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Share of each decline reason in the declined payments of its group."""
    declined = fact.where(F.col("transaction_status") == DECLINED)
    counts = declined.groupBy(*keys, "decline_reason").agg(F.count(F.lit(1)).alias("decline_reason_count"))
    total = F.sum("decline_reason_count").over(Window.partitionBy(*keys))
    return counts.withColumn("decline_reason_share", ratio(F.col("decline_reason_count"), total))
