"""Edge cases of the report views on hand-made frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paygrain.plans import reports, views

NOON = datetime(2025, 3, 1, 12, 0, 0)


def at(seconds: int) -> datetime:
    return NOON + timedelta(seconds=seconds)


def test_velocity_window_is_inclusive_and_sees_same_second_peers(payments):
    fact = payments(
        *[
            {"transaction_timestamp": at(s), "transaction_amount_usd": v}
            for s, v in [(0, 1.0), (3600, 2.0), (3601, 4.0), (3601, 8.0)]
        ]
    )
    rows = views.transaction_velocity(fact).orderBy("transaction_id").collect()
    assert [r.customer_value_usd_1h for r in rows] == [1.0, 3.0, 14.0, 14.0]
    assert [r.customer_transactions_1h for r in rows] == [1, 2, 3, 3]
    assert [r.customer_value_usd_24h for r in rows] == [1.0, 3.0, 15.0, 15.0]


def test_velocity_does_not_depend_on_the_zone_of_the_session(spark, payments):
    """Half past one and half past three on the night New York skips an hour."""
    fact = payments(
        {"transaction_timestamp": datetime(2025, 3, 9, 1, 30)}, {"transaction_timestamp": datetime(2025, 3, 9, 3, 0)}
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = views.transaction_velocity(fact).orderBy("transaction_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.customer_transactions_1h for r in rows] == [1, 1]
    zoned = fact.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))
    assert [r.customer_transactions_24h for r in views.transaction_velocity(zoned).collect()] in ([1, 2], [2, 1])


@pytest.mark.parametrize(
    ("count", "band"), [(4, "Normal Velocity"), (5, "Elevated Velocity"), (7, "Elevated Velocity"), (8, "High Velocity")]
)
def test_velocity_bands_by_count(payments, count, band):
    fact = payments(*[{"transaction_timestamp": at(60 * i), "transaction_amount_usd": 1.0} for i in range(count)])
    last = views.transaction_velocity(fact).orderBy(F.desc("transaction_timestamp")).first()
    assert last.velocity_band == band
    assert last.velocity_alert == (band == "High Velocity")


@pytest.mark.parametrize(
    ("value", "band"),
    [
        (749.99, "Normal Velocity"), (750.0, "Elevated Velocity"),
        (1499.99, "Elevated Velocity"), (1500.0, "High Velocity"),
    ],
)
def test_velocity_bands_by_value(payments, value, band):
    fact = payments({"transaction_amount_usd": 100.0}, {"transaction_amount_usd": round(value - 100.0, 2)})
    assert {r.velocity_band for r in views.transaction_velocity(fact).collect()} == {band}


def test_velocity_across_slices_nulls_and_long_histories(spark, payments):
    """The sliced windows equal plain windows over the whole history."""
    rows = [
        {
            "customer_id": [None, "A", "B"][i % 3],
            "transaction_timestamp": None if i % 97 == 0 else NOON + timedelta(seconds=i * i * 13 % 900_000),
            "transaction_amount_usd": float(i % 50) + 0.25,
        }
        for i in range(600)
    ]
    fact = payments(*rows)
    got = views.transaction_velocity(fact)
    fact.createOrReplaceTempView("velocity_input")
    over = "OVER (PARTITION BY customer_id ORDER BY unix_timestamp(transaction_timestamp) RANGE BETWEEN {} PRECEDING AND CURRENT ROW)"
    plain = spark.sql(
        f"""SELECT transaction_id, count(*) {over.format(3600)} a,
        CAST(sum(CAST(transaction_amount_usd AS DECIMAL(18,2))) {over.format(3600)} AS DOUBLE) b,
        count(*) {over.format(86400)} c,
        CAST(sum(CAST(transaction_amount_usd AS DECIMAL(18,2))) {over.format(86400)} AS DOUBLE) d
        FROM velocity_input"""
    )
    names = ["transaction_id", *[c for c in got.columns if c.startswith("customer_") and c != "customer_id"]]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, plain.collect()))
    assert got.count() == 600


def test_velocity_of_one_hot_customer_is_spread_over_slices(payments):
    rows = [
        {"transaction_id": i, "transaction_timestamp": NOON + timedelta(hours=i), "transaction_amount_usd": 1.0}
        for i in range(24 * 30)
    ]
    from paygrain.operators.velocity import trailing_totals

    totals = trailing_totals(payments(*rows), {"1h": 3600, "24h": 86400})
    assert totals.where("customer_transactions_24h = 25").count() == 24 * 30 - 24
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" in plan and "windowspecdefinition(customer_id" in plan


def day_rows(counts: list[int], start: date = date(2025, 1, 1), days: list[int] | None = None, value: float = 10.0):
    rows = []
    for offset, count in zip(days or range(len(counts)), counts, strict=True):
        stamp = datetime.combine(start + timedelta(days=offset), datetime.min.time())
        rows += [{"transaction_timestamp": stamp, "transaction_amount_usd": value}] * count
    return rows


def anomaly_days(payments, rows, **options):
    fact = payments(*rows)
    return views.merchant_daily_anomalies(fact, **options).orderBy("transaction_date").collect()


def test_anomaly_needs_seven_earlier_days(payments):
    flagged = anomaly_days(payments, day_rows([4, 5, 6, 5, 4, 6, 5, 50]))
    assert [r.anomaly_flag for r in flagged] == [False] * 7 + [True]
    short = anomaly_days(payments, day_rows([4, 5, 6, 5, 4, 6, 50]))
    assert not any(r.anomaly_flag for r in short)
    assert short[0].baseline_observations == 0 and short[0].baseline_transaction_count is None


def test_constant_baseline_has_no_score_and_no_flag(payments):
    days = anomaly_days(payments, day_rows([5] * 9 + [60]))
    assert days[-1].transaction_count_zscore is None and days[-1].approval_rate_zscore is None
    assert not days[-1].anomaly_flag


def test_baseline_counts_observed_days_not_calendar_days(payments):
    days = anomaly_days(payments, day_rows([4, 5, 6, 5, 4, 6, 5, 4, 5], days=[*range(8), 19]))
    assert days[-1].baseline_observations == 8


def test_anomaly_confirmation_by_signals_and_value(payments):
    rows = day_rows([4, 5, 6, 5, 4, 6, 5, 50])
    assert anomaly_days(payments, rows, min_signals=2)[-1].anomaly_flag
    assert not anomaly_days(payments, rows, min_signals=3)[-1].anomaly_flag
    assert not anomaly_days(payments, rows, min_value=501.0)[-1].anomaly_flag


def test_unknown_country_is_in_the_daily_view_but_not_in_the_decline_view(payments, dimensions):
    declined = {"transaction_status": "declined", "decline_reason": "do_not_honor"}
    fact = payments({}, declined, {**declined, "country_id": "XXX"})
    daily = views.payment_performance_daily(fact, dimensions["dim_country"])
    assert {(r.country_id, r.country_name) for r in daily.collect()} == {("IRL", "Ireland"), ("XXX", None)}
    declines = views.decline_analysis_monthly(fact, dimensions["dim_country"]).collect()
    assert [(r.country_id, r.transaction_count, r.decline_reason_count) for r in declines] == [("IRL", 2, 1)]
    assert declines[0].decline_rate == 0.5 and declines[0].share_of_declines == 1.0


def test_decline_reason_of_approved_rows_does_not_count_and_null_reason_stays(payments, dimensions):
    fact = payments(
        {"decline_reason": "odd"}, {"transaction_status": "declined"},
        {"transaction_status": "declined", "decline_reason": "expired_card"}, {"transaction_status": None},
    )
    rows = views.decline_analysis_monthly(fact, dimensions["dim_country"]).collect()
    found = {r.decline_reason: (r.transaction_count, r.declined_transactions, r.decline_reason_count) for r in rows}
    assert found == {None: (4, 2, 1), "expired_card": (4, 2, 1)}


def test_segment_without_declines_has_no_decline_row(payments, dimensions):
    assert views.decline_analysis_monthly(payments({}), dimensions["dim_country"]).count() == 0


def test_movement_from_a_zero_month_is_null(payments):
    fact = payments(
        {"transaction_timestamp": datetime(2025, 1, 5), "transaction_amount_usd": 0.0},
        {"transaction_timestamp": datetime(2025, 2, 5)},
    )
    january, february = views.executive_kpis_monthly(fact).orderBy("month").collect()
    assert january.prior_transaction_count is None and january.transaction_count_mom_change is None
    assert february.transaction_count_mom_change == 0.0
    assert february.transaction_value_mom_change is None and february.fraud_loss_mom_change is None


def test_orphan_facts_are_dropped_by_inner_views_and_kept_by_features(payments, dimensions):
    fact = payments({}, {"merchant_id": "M9"}, {"customer_id": None})
    assert views.merchant_intelligence(fact, dimensions["dim_merchant"]).count() == 1
    assert views.customer_analytics(fact, dimensions["dim_customer"]).count() == 1
    features = views.fraud_model_features(fact, *[dimensions[f"dim_{d}"] for d in ("customer", "merchant", "device", "country")])
    assert features.count() == 3
    assert features.where("merchant_category IS NULL").count() == 1


def test_single_merchant_has_percentile_zero(payments, dimensions):
    row = views.merchant_intelligence(payments({}), dimensions["dim_merchant"]).first()
    assert (row.value_percentile, row.fraud_loss_percentile, row.decline_percentile) == (0.0, 0.0, 0.0)
    assert row.merchant_priority_segment == "Core Portfolio"


def test_equal_customers_are_tiled_by_id(spark, payments, dimensions):
    ids = [f"C{i}" for i in range(7)]
    fact = payments(*[{"customer_id": c} for c in reversed(ids)])
    customers = spark.createDataFrame(
        [(c, "Mass", "IRL", 1, "Low") for c in ids], dimensions["dim_customer"].schema
    )
    rows = views.customer_analytics(fact, customers).orderBy("customer_id").collect()
    assert [r.spend_quintile for r in rows] == [1, 1, 2, 2, 3, 4, 5]
    assert [r.activity_quintile for r in rows] == [1, 1, 2, 2, 3, 4, 5]
    assert rows[0].behavioural_segment == "High Value / High Activity"
    assert rows[6].behavioural_segment == "Low Engagement"


def test_risk_measures_agree_with_and_without_a_broadcast_customer(payments, dimensions, monkeypatch):
    fact = payments({}, {"is_fraud": True, "fraud_loss_amount_usd": 5.0}, {"channel": "in_app"}, {"customer_id": "C9"})
    tables = dimensions["dim_merchant"], dimensions["dim_customer"]
    few = views.fraud_risk_segments(fact, *tables)
    many = views.fraud_risk_segments(fact, *tables)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert few.agg(F.sum("transaction_count")).first()[0] == 3


def test_reports_add_up_to_the_fact(payments, dimensions):
    fact = payments(
        {}, {"is_fraud": True, "fraud_loss_amount_usd": 5.0}, {"is_cross_border": True},
        {"transaction_status": "declined", "decline_reason": "do_not_honor"},
    )
    kpis = reports.portfolio_kpis(fact).first()
    daily = views.payment_performance_daily(fact, dimensions["dim_country"])
    totals = daily.agg(F.sum("transaction_count"), F.sum("transaction_value_usd"), F.sum("fraud_loss_usd")).first()
    assert tuple(totals) == (kpis.transaction_count, kpis.transaction_value_usd, kpis.fraud_loss_usd)
    risk = views.risk_measures(fact, dimensions["dim_merchant"], dimensions["dim_customer"])
    concentration = reports.fraud_concentration(risk).collect()
    assert sum(r.transaction_count for r in concentration) == 4
    assert {r.is_cross_border: r.multiple_of_portfolio_rate for r in concentration} == {
        False: pytest.approx(4 / 3), True: 0.0,
    }
    pair = reports.fraud_domestic_vs_cross(risk).first()
    assert pair.domestic_fraud_rate == pytest.approx(1 / 3) and pair.cross_to_domestic_ratio == 0.0


def test_first_and_last_month_of_the_executive_summary(payments):
    fact = payments(
        {"transaction_timestamp": datetime(2025, 1, 5)}, {"transaction_timestamp": datetime(2025, 2, 5)},
        {"transaction_timestamp": datetime(2025, 2, 6)},
    )
    row = reports.executive_summary(views.executive_kpis_monthly(fact)).first()
    assert (row.first_month, row.last_month) == (date(2025, 1, 1), date(2025, 2, 1))
    assert row.volume_growth == 1.0 and row.highest_volume_month == date(2025, 2, 1)
    assert row.lowest_fraud_loss_month == date(2025, 1, 1)
