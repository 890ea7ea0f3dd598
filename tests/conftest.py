from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paygrain.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "paygrain-tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


FACT_DDL = (
    "transaction_id bigint, transaction_timestamp timestamp_ntz, customer_id string, merchant_id string, "
    "device_id string, country_id string, payment_method string, channel string, currency string, "
    "transaction_amount double, transaction_amount_usd double, transaction_status string, decline_reason string, "
    "is_cross_border boolean, is_fraud boolean, fraud_loss_amount_usd double, processing_time_ms bigint"
)


def payment(number: int = 1, **changes) -> dict:
    """A valid payment; keyword arguments replace single fields."""
    from datetime import datetime

    row = {
        "transaction_id": number,
        "transaction_timestamp": datetime(2025, 3, 1, 12, 0, 0),
        "customer_id": "C1", "merchant_id": "M1", "device_id": "D1", "country_id": "IRL",
        "payment_method": "credit_card", "channel": "web", "currency": "EUR",
        "transaction_amount": 10.0, "transaction_amount_usd": 11.0, "transaction_status": "approved",
        "decline_reason": None, "is_cross_border": False, "is_fraud": False, "fraud_loss_amount_usd": 0.0,
        "processing_time_ms": 400,
    }
    return {**row, **changes}


@pytest.fixture
def payments(spark):
    """Build a fact table from dicts of changed fields."""
    names = [part.split(" ")[0] for part in FACT_DDL.split(", ")]

    def build(*rows: dict):
        made = [payment(**{"number": i, **row}) for i, row in enumerate(rows, start=1)]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in made], FACT_DDL)

    return build


@pytest.fixture
def dimensions(spark):
    """One customer, merchant, device and country that the default payment refers to."""
    return {
        "dim_customer": spark.createDataFrame(
            [("C1", "Mass", "IRL", 12, "Low")],
            "customer_id string, customer_segment string, home_country string, account_tenure_months int, "
            "risk_segment string",
        ),
        "dim_merchant": spark.createDataFrame(
            [("M1", "Shop", "Retail", "IRL", "Small", "Standard", "Low")],
            "merchant_id string, merchant_name string, merchant_category string, merchant_country string, "
            "merchant_size string, merchant_tier string, merchant_risk_rating string",
        ),
        "dim_device": spark.createDataFrame(
            [("D1", "mobile", "iOS")], "device_id string, device_type string, operating_system string"
        ),
        "dim_country": spark.createDataFrame(
            [("IRL", "Ireland", "Europe", "EUR")],
            "country_id string, country_name string, region string, currency string",
        ),
    }
