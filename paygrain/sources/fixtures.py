"""The star schema over the TPC-H-like test tables.

The expressions are plain SQL that Spark and other engines read alike, so that a check query
can state the same mapping.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

DIM_COUNTRY = [
    "n_nationkey AS country_id",
    "n_name AS country_name",
    "r_name AS region",
    "CASE r_regionkey WHEN 0 THEN 'ZAR' WHEN 1 THEN 'USD' WHEN 2 THEN 'INR' WHEN 3 THEN 'EUR' "
    "WHEN 4 THEN 'AED' END AS currency",
]
DIM_CUSTOMER = [
    "c_custkey AS customer_id",
    "c_mktsegment AS customer_segment",
    "c_nationkey AS home_country",
    "CAST(c_custkey % 84 AS INT) AS account_tenure_months",
    "CASE WHEN c_acctbal >= 9800 THEN 'High' WHEN c_acctbal >= 7800 THEN 'Medium' ELSE 'Low' END AS risk_segment",
]
DIM_MERCHANT = [
    "p_partkey AS merchant_id",
    "p_name AS merchant_name",
    "p_type AS merchant_category",
    "CAST(p_partkey % 25 AS INT) AS merchant_country",
    "CASE WHEN p_size <= 30 THEN 'Small' WHEN p_size <= 43 THEN 'Medium' WHEN p_size <= 48 THEN 'Large' "
    "ELSE 'Enterprise' END AS merchant_size",
    "CASE WHEN p_size <= 30 THEN 'Standard' WHEN p_size <= 43 THEN 'Growth' ELSE 'Strategic' END AS merchant_tier",
    "CASE WHEN p_partkey % 10 = 0 THEN 'High' WHEN p_partkey % 10 <= 3 THEN 'Medium' ELSE 'Low' END "
    "AS merchant_risk_rating",
]
DIM_DEVICE = [
    "s_suppkey AS device_id",
    "CASE s_suppkey % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' "
    "ELSE 'point_of_sale' END AS device_type",
    "CASE s_suppkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Windows' END AS operating_system",
]


def _method(key: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'digital_wallet' "
        "ELSE 'bank_transfer' END AS payment_method"
    )


def _channel(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'card_present' WHEN 1 THEN 'web' ELSE 'in_app' END AS channel"


# Two steps each: the raw columns of a payment, then what follows from them.
EVENT_KEY = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k"
EVENT_PAYMENT = [
    "event_id AS transaction_id",
    "ts AS transaction_timestamp",
    "user_id AS customer_id",
    "k AS merchant_id",
    "event_id % 10 AS device_id",
    "CAST(k % 25 AS INT) AS country_id",
    _method("user_id"),
    _channel("k"),
    "round(value * 10, 1) AS transaction_amount",
    "round(value * 10, 1) AS transaction_amount_usd",
    "CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS transaction_status",
    "CASE WHEN event_type = 'error' THEN CASE k % 6 WHEN 0 THEN 'insufficient_funds' WHEN 1 THEN 'do_not_honor' "
    "WHEN 2 THEN 'suspected_fraud' WHEN 3 THEN 'expired_card' WHEN 4 THEN 'issuer_unavailable' "
    "ELSE 'limit_exceeded' END END AS decline_reason",
    "CAST(k % 25 AS INT) <> c_nationkey AS is_cross_border",
    "(event_id % 37 = 0 OR (value >= 150 AND event_id % 4 = 0)) AS is_fraud",
    "90 + (event_id * 37) % 4911 AS processing_time_ms",
]
LINEITEM_PAYMENT = [
    "l_orderkey * 10 + l_linenumber AS transaction_id",
    "l_shipdate AS transaction_timestamp",
    "o_custkey AS customer_id",
    "l_partkey AS merchant_id",
    "l_suppkey AS device_id",
    "CAST(l_partkey % 25 AS INT) AS country_id",
    _method("l_linenumber"),
    _channel("l_linenumber"),
    "l_extendedprice AS transaction_amount",
    "l_extendedprice AS transaction_amount_usd",
    "CASE WHEN l_returnflag = 'R' THEN 'declined' ELSE 'approved' END AS transaction_status",
    "CASE WHEN l_returnflag = 'R' THEN o_orderpriority END AS decline_reason",
    "CAST(l_partkey % 25 AS INT) <> c_nationkey AS is_cross_border",
    "(l_linestatus = 'F' AND l_quantity >= 49) AS is_fraud",
    "CAST(l_quantity * 100 AS BIGINT) AS processing_time_ms",
]
FRAUD_LOSS = (
    "CASE WHEN is_fraud AND transaction_status = 'approved' THEN transaction_amount_usd ELSE 0.0e0 END "
    "AS fraud_loss_amount_usd"
)
FACT_ORDER = [
    "transaction_id", "transaction_timestamp", "customer_id", "merchant_id", "device_id", "country_id",
    "payment_method", "channel", "currency", "transaction_amount", "transaction_amount_usd",
    "transaction_status", "decline_reason", "is_cross_border", "is_fraud", "fraud_loss_amount_usd",
    "processing_time_ms",
]
CATEGORY_FRAUD_FACTOR = {
    "ECONOMY": 0.70, "STANDARD": 1.00, "MEDIUM": 0.90, "SMALL": 1.10, "LARGE": 1.45, "PROMO": 1.75,
}
CATEGORY_APPROVAL_DELTA = {
    "ECONOMY": 0.010, "STANDARD": 0.000, "MEDIUM": 0.005, "SMALL": -0.005, "LARGE": -0.020, "PROMO": -0.025,
}
SEGMENT_CROSS_BORDER_RATE = {
    "AUTOMOBILE": 0.08, "BUILDING": 0.18, "FURNITURE": 0.14, "HOUSEHOLD": 0.42, "MACHINERY": 0.60,
}
# A regression that is given, not fitted.
STATED_INTERCEPT = -2.5
STATED_COEFFICIENTS = [
    ("transaction_hour", -0.01), ("transaction_amount_usd", 0.0004), ("account_tenure_months", -0.003),
    ("channel_web", 0.4), ("channel_in_app", 0.25), ("customer_risk_segment_High", 0.9),
    ("customer_risk_segment_Low", -0.3), ("merchant_risk_rating_High", 0.7), ("is_cross_border_true", 0.5),
    ("payment_method_bank_transfer", -0.2),
]
VALIDATION_FROM, TEST_FROM = "2024-01-21", "2024-01-26"


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@dataclass
class Star:
    """Star-schema tables read from one directory of test data.

    Schemas are given, so that no job is run to infer them. The two facts come without their
    currency, which costs a join here; ``with_currency`` completes them.
    """

    spark: SparkSession
    directory: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def country(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(*DIM_COUNTRY)

    @cached_property
    def customer(self) -> DataFrame:
        return self.raw("customer").selectExpr(*DIM_CUSTOMER)

    @cached_property
    def merchant(self) -> DataFrame:
        return self.raw("part").selectExpr(*DIM_MERCHANT)

    @cached_property
    def device(self) -> DataFrame:
        return self.raw("supplier").selectExpr(*DIM_DEVICE)

    @cached_property
    def events(self) -> DataFrame:
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        events = self.raw("events").selectExpr("*", EVENT_KEY)
        joined = events.join(customer, events.user_id == customer.c_custkey)
        return joined.selectExpr(*EVENT_PAYMENT).selectExpr("*", FRAUD_LOSS)

    @cached_property
    def lineitem(self) -> DataFrame:
        customer = self.raw("customer").select("c_custkey", "c_nationkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        lines = self.raw("lineitem")
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
            customer, orders.o_custkey == customer.c_custkey
        )
        return joined.selectExpr(*LINEITEM_PAYMENT).selectExpr("*", FRAUD_LOSS)

    def with_currency(self, fact: DataFrame) -> DataFrame:
        return fact.join(self.country.select("country_id", "currency"), "country_id", "left").select(*FACT_ORDER)


def mapping_ctes() -> str:
    """The same mapping as WITH clauses for a check query."""

    def pick(expressions: list[str]) -> str:
        return ",\n    ".join(expressions)

    def fact(name: str, payment: list[str], source: str) -> str:
        return f"""{name}_raw AS (
  SELECT {pick(payment)}
  FROM {source}
),
{name} AS (
  SELECT p.*, {FRAUD_LOSS}, c.currency
  FROM {name}_raw p LEFT JOIN dim_country c USING (country_id)
)"""

    return f"""dim_country AS (
  SELECT {pick(DIM_COUNTRY)} FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_customer AS (SELECT {pick(DIM_CUSTOMER)} FROM customer),
dim_merchant AS (SELECT {pick(DIM_MERCHANT)} FROM part),
dim_device AS (SELECT {pick(DIM_DEVICE)} FROM supplier),
{fact("fact_events", EVENT_PAYMENT, f"(SELECT *, {EVENT_KEY} FROM events) e JOIN customer ON user_id = c_custkey")},
{fact("fact_lineitem", LINEITEM_PAYMENT,
      "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")}"""
