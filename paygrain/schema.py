"""Table schemas, category values and fixed parameters of the payments star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names must equal the published tables.
FACT_COLUMNS = {
    "transaction_id": "bigint",
    "transaction_timestamp": "timestamp",
    "customer_id": "string",
    "merchant_id": "string",
    "device_id": "string",
    "country_id": "string",
    "payment_method": "string",
    "channel": "string",
    "currency": "string",
    "transaction_amount": "double",
    "transaction_amount_usd": "double",
    "transaction_status": "string",
    "decline_reason": "string",
    "is_cross_border": "boolean",
    "is_fraud": "boolean",
    "fraud_loss_amount_usd": "double",
    "processing_time_ms": "bigint",
}

DIM_CUSTOMER_COLUMNS = {
    "customer_id": "string",
    "customer_segment": "string",
    "signup_date": "date",
    "home_country": "string",
    "account_tenure_months": "int",
    "risk_segment": "string",
    "transaction_propensity": "double",
}

DIM_MERCHANT_COLUMNS = {
    "merchant_id": "string",
    "merchant_name": "string",
    "merchant_category": "string",
    "merchant_country": "string",
    "merchant_size": "string",
    "merchant_tier": "string",
    "onboarding_date": "date",
    "merchant_risk_rating": "string",
    "transaction_propensity": "double",
}

DIM_DEVICE_COLUMNS = {
    "device_id": "string",
    "device_type": "string",
    "operating_system": "string",
    "browser": "string",
}

DIM_COUNTRY_COLUMNS = {
    "country_id": "string",
    "country_name": "string",
    "region": "string",
    "currency": "string",
    "market_weight": "double",
    "risk_multiplier": "double",
}

DIM_DATE_COLUMNS = {
    "date_id": "int",
    "date": "date",
    "day": "int",
    "week": "int",
    "month": "int",
    "month_name": "string",
    "quarter": "string",
    "year": "int",
    "day_of_week": "string",
    "is_weekend": "boolean",
    "transaction_weight": "double",
}

TABLE_COLUMNS = {
    "fact_transactions": FACT_COLUMNS,
    "dim_customer": DIM_CUSTOMER_COLUMNS,
    "dim_merchant": DIM_MERCHANT_COLUMNS,
    "dim_device": DIM_DEVICE_COLUMNS,
    "dim_country": DIM_COUNTRY_COLUMNS,
    "dim_date": DIM_DATE_COLUMNS,
}

PRIMARY_KEYS = {
    "dim_customer": "customer_id",
    "dim_merchant": "merchant_id",
    "dim_device": "device_id",
    "dim_country": "country_id",
    "dim_date": "date_id",
}

FOREIGN_KEYS = {
    "customer": ("dim_customer", "customer_id"),
    "merchant": ("dim_merchant", "merchant_id"),
    "device": ("dim_device", "device_id"),
    "country": ("dim_country", "country_id"),
}

REQUIRED_COLUMNS = list(FACT_COLUMNS)
NULLABLE_COLUMNS = ["decline_reason"]
FORBIDDEN_CUSTOMER_COLUMNS = ["age_band"]


def table_schema(name: str) -> T.StructType:
    return T.StructType(
        [T.StructField(column, T.DataType.fromDDL(kind)) for column, kind in TABLE_COLUMNS[name].items()]
    )


# These must equal the published definitions for results to agree.
APPROVED = "approved"
DECLINED = "declined"
STATUSES = [APPROVED, DECLINED]
PROCESSING_TIME_RANGE_MS = (90, 5000)
PLAUSIBLE_RATES = {
    "approval rate": ("approval_rate", 0.80, 0.99),
    "fraud rate": ("fraud_rate", 0.0002, 0.03),
    "cross-border rate": ("cross_border_rate", 0.03, 0.45),
}
BASE_APPROVAL_RATE = 0.945
BASE_FRAUD_RATE = 0.0018
CATEGORY_FRAUD_FACTOR = {
    "Grocery": 0.70,
    "Restaurants": 0.75,
    "Retail": 1.00,
    "Travel": 1.45,
    "Hotels": 1.25,
    "Digital Goods": 1.75,
    "Electronics": 1.55,
    "Subscription Services": 0.90,
    "Fuel": 0.80,
    "Healthcare": 0.65,
    "Entertainment": 1.10,
    "Professional Services": 1.00,
}
CATEGORY_APPROVAL_DELTA = {
    "Grocery": 0.010,
    "Restaurants": 0.005,
    "Retail": 0.000,
    "Travel": -0.020,
    "Hotels": -0.010,
    "Digital Goods": -0.025,
    "Electronics": -0.020,
    "Subscription Services": 0.005,
    "Fuel": 0.010,
    "Healthcare": 0.010,
    "Entertainment": -0.005,
    "Professional Services": -0.005,
}
SEGMENT_CROSS_BORDER_RATE = {
    "Mass": 0.08,
    "Affluent": 0.18,
    "Digital Native": 0.14,
    "Frequent Traveller": 0.42,
}
CUSTOMER_RISK_FACTOR = {"Low": 0.75, "Medium": 1.45, "High": 3.00}
MERCHANT_RISK_FACTOR = {"Low": 0.80, "Medium": 1.25, "High": 1.90}
TIER_BY_SIZE = {"Small": "Standard", "Medium": "Growth", "Large": "Strategic", "Enterprise": "Strategic"}
RISK_RATING_FROM = {"High": 1.45, "Medium": 1.10}
NIGHT_HOURS_UNTIL, NIGHT_HOURS_FROM = 5, 23
LARGE_AMOUNT_USD, MEDIUM_AMOUNT_USD = 750, 300
NIGHT_FRAUD_FACTOR = 1.45
CROSS_BORDER_FRAUD_FACTOR = 1.75
CARD_PRESENT_FRAUD_FACTOR, REMOTE_FRAUD_FACTOR = 0.72, 1.28
LARGE_AMOUNT_FRAUD_FACTOR, MEDIUM_AMOUNT_FRAUD_FACTOR = 1.65, 1.25
FRAUD_PROBABILITY_RANGE = (0.00015, 0.08)
CARD_PRESENT_APPROVAL_DELTA, REMOTE_APPROVAL_DELTA = 0.012, -0.004
CROSS_BORDER_APPROVAL_DELTA = -0.030
HIGH_RISK_CUSTOMER_APPROVAL_DELTA = -0.050
HIGH_RISK_MERCHANT_APPROVAL_DELTA = -0.035
LARGE_AMOUNT_APPROVAL_DELTA = -0.025
FRAUD_APPROVAL_DELTA = -0.30
APPROVAL_PROBABILITY_RANGE = (0.45, 0.995)
DIGITAL_CHANNELS = ["web", "in_app"]
DIGITAL_CROSS_BORDER_UPLIFT = 0.025
CROSS_BORDER_PROBABILITY_RANGE = (0.02, 0.60)
TYPICAL_PROCESSING_MS = 420.0
CROSS_BORDER_TIME_FACTOR = 1.20
BANK_TRANSFER_TIME_FACTOR = 1.45
WEB_TIME_FACTOR = 1.08
SMALLEST_LOCAL_AMOUNT = 0.01
MONTH_FACTOR = {
    1: 0.90, 2: 0.92, 3: 0.98, 4: 1.00, 5: 1.02, 6: 1.05,
    7: 1.08, 8: 1.07, 9: 1.00, 10: 1.06, 11: 1.18, 12: 1.28,
}
WEEKEND_FACTOR = 1.08
USD_PER_UNIT = {
    "USD": 1.0000,
    "EUR": 1.1000,
    "GBP": 1.2700,
    "CAD": 0.7400,
    "SEK": 0.0950,
    "PLN": 0.2500,
    "AUD": 0.6600,
    "NZD": 0.6100,
    "JPY": 0.0067,
    "SGD": 0.7400,
    "INR": 0.0120,
    "AED": 0.2723,
    "SAR": 0.2667,
    "BRL": 0.2000,
    "MXN": 0.0580,
    "ZAR": 0.0550,
    "KES": 0.0077,
    "NGN": 0.00065,
    "CHF": 1.1300,
    "NOK": 0.0940,
}
