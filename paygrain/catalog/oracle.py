"""Check SQL of the named queries, written for DuckDB over the same test tables.

The mapping to the star schema is shared text (it is input, not result); every report is
stated again in plain SQL. Money is summed as DECIMAL(18,6), rates are doubles.
"""

from __future__ import annotations

from paygrain import schema
from paygrain.functions import fingerprint
from paygrain.operators.modeling import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from paygrain.sources import fixtures
from paygrain.sources.fixtures import STATED_COEFFICIENTS, STATED_INTERCEPT, mapping_ctes

ORACLE: dict[str, str] = {}


def check(name: str, body: str, ctes: str = "") -> None:
    """Register ``body`` behind the mapping; ``ctes`` are further WITH clauses."""
    more = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    ORACLE[name] = f"WITH {mapping_ctes()}{more}\n{body.strip()}"


def plain(name: str, body: str) -> None:
    ORACLE[name] = body.strip()


def usd(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,6))) AS DOUBLE)"


def rate(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) / count(*)"


def case(column: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}e0" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


VALUE = usd("transaction_amount_usd")
LOSS = usd("fraud_loss_amount_usd")
AVG_VALUE = f"{VALUE} / count(transaction_amount_usd)"
APPROVED_VALUE = (
    "CAST(sum(CAST(transaction_amount_usd AS DECIMAL(18,6))) FILTER (WHERE transaction_status = 'approved') AS DOUBLE)"
)
APPROVED, DECLINED = "transaction_status = 'approved'", "transaction_status = 'declined'"
DAY = "CAST(transaction_timestamp AS DATE)"
MONTH = f"CAST(date_trunc('month', {DAY}) AS DATE)"

# --- report views --------------------------------------------------------------------------

check("payment_performance_daily", f"""
SELECT {DAY} AS transaction_date, f.country_id, country_name, region, channel, payment_method,
  count(*) AS transaction_count, {VALUE} AS transaction_value_usd, {AVG_VALUE} AS average_transaction_value_usd,
  count(*) FILTER (WHERE {APPROVED}) AS approved_transactions,
  count(*) FILTER (WHERE {DECLINED}) AS declined_transactions,
  count(*) FILTER (WHERE is_fraud) AS fraud_transactions, {LOSS} AS fraud_loss_usd,
  count(*) FILTER (WHERE is_cross_border) AS cross_border_transactions,
  avg(processing_time_ms) AS average_processing_time_ms,
  {rate(APPROVED)} AS approval_rate, {rate(DECLINED)} AS decline_rate, {rate("is_fraud")} AS fraud_rate,
  {rate("is_cross_border")} AS cross_border_rate
FROM fact_lineitem f LEFT JOIN dim_country c ON f.country_id = c.country_id
GROUP BY 1, 2, 3, 4, 5, 6
""")

check("decline_analysis_monthly", """
SELECT month, country_id, country_name, region, channel, payment_method, decline_reason,
  transaction_count, declined_transactions, decline_reason_count,
  declined_transactions / nullif(transaction_count, 0) AS decline_rate,
  decline_reason_count / nullif(declined_transactions, 0) AS share_of_declines
FROM reasons JOIN segments USING (month, country_id, country_name, region, channel, payment_method)
""", f"""
base AS (
  SELECT {MONTH} AS month, f.country_id, country_name, region, channel, payment_method,
    transaction_status, decline_reason
  FROM fact_lineitem f LEFT JOIN dim_country c ON f.country_id = c.country_id
),
segments AS (
  SELECT month, country_id, country_name, region, channel, payment_method, count(*) AS transaction_count,
    count(*) FILTER (WHERE {DECLINED}) AS declined_transactions
  FROM base GROUP BY ALL
),
reasons AS (
  SELECT month, country_id, country_name, region, channel, payment_method, decline_reason,
    count(*) AS decline_reason_count
  FROM base WHERE {DECLINED} GROUP BY ALL
)
""")

MERCHANTS = f"""
merchant_totals AS (
  SELECT f.merchant_id, merchant_name, merchant_category, merchant_country, merchant_size, merchant_tier,
    merchant_risk_rating, count(*) AS transaction_count, {VALUE} AS transaction_value_usd,
    {AVG_VALUE} AS average_transaction_value_usd, {rate(APPROVED)} AS approval_rate,
    {rate(DECLINED)} AS decline_rate, {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd,
    {rate("is_cross_border")} AS cross_border_rate, avg(processing_time_ms) AS average_processing_time_ms
  FROM fact_lineitem f JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  GROUP BY 1, 2, 3, 4, 5, 6, 7
),
merchant_ranks AS (
  SELECT *, percent_rank() OVER (ORDER BY transaction_value_usd NULLS FIRST) AS value_percentile,
    percent_rank() OVER (ORDER BY fraud_loss_usd NULLS FIRST) AS fraud_loss_percentile,
    percent_rank() OVER (ORDER BY decline_rate NULLS FIRST) AS decline_percentile
  FROM merchant_totals
),
merchant_view AS (
  SELECT *, CASE
    WHEN value_percentile >= 0.75 AND (merchant_risk_rating = 'High' OR fraud_loss_percentile >= 0.75
      OR decline_percentile >= 0.75) THEN 'High Value / Elevated Risk'
    WHEN value_percentile >= 0.75 THEN 'High Value'
    WHEN merchant_risk_rating = 'High' OR fraud_loss_percentile >= 0.75 OR decline_percentile >= 0.75
      THEN 'Elevated Risk'
    ELSE 'Core Portfolio' END AS merchant_priority_segment
  FROM merchant_ranks
)
"""
check("merchant_intelligence", "SELECT * FROM merchant_view", MERCHANTS)

CUSTOMERS = f"""
customer_totals AS (
  SELECT f.customer_id, customer_segment, home_country, account_tenure_months, risk_segment,
    min({DAY}) AS first_transaction_date, max({DAY}) AS last_transaction_date,
    count(DISTINCT {MONTH}) AS active_months, count(*) AS transaction_count, {VALUE} AS transaction_value_usd,
    {AVG_VALUE} AS average_transaction_value_usd, {rate(APPROVED)} AS approval_rate,
    {rate("is_cross_border")} AS cross_border_rate, {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd
  FROM fact_lineitem f JOIN dim_customer c ON f.customer_id = c.customer_id
  GROUP BY 1, 2, 3, 4, 5
),
customer_tiles AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY transaction_value_usd DESC NULLS LAST, customer_id) AS INT) AS spend_quintile,
    CAST(ntile(5) OVER (ORDER BY transaction_count DESC, customer_id) AS INT) AS activity_quintile
  FROM customer_totals
),
customer_view AS (
  SELECT *, CASE
    WHEN spend_quintile = 1 AND activity_quintile = 1 THEN 'High Value / High Activity'
    WHEN spend_quintile = 1 THEN 'High Value'
    WHEN activity_quintile = 1 THEN 'High Activity'
    WHEN active_months <= 3 THEN 'Low Engagement'
    ELSE 'Core Customer' END AS behavioural_segment
  FROM customer_tiles
)
"""
check("customer_analytics", "SELECT * FROM customer_view", CUSTOMERS)

RISK = """
risk_rows AS (
  SELECT f.*, merchant_category, merchant_risk_rating, c.risk_segment AS customer_risk_segment
  FROM fact_lineitem f JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  JOIN dim_customer c ON f.customer_id = c.customer_id
)
"""
check("fraud_risk_segments", f"""
SELECT merchant_category, merchant_risk_rating, customer_risk_segment, channel, payment_method, is_cross_border,
  count(*) AS transaction_count, {VALUE} AS transaction_value_usd,
  count(*) FILTER (WHERE is_fraud) AS fraud_transactions, {rate("is_fraud")} AS fraud_rate,
  {LOSS} AS fraud_loss_usd, {LOSS} / nullif({VALUE}, 0) AS fraud_loss_rate, {rate(DECLINED)} AS decline_rate,
  avg(processing_time_ms) AS average_processing_time_ms
FROM risk_rows GROUP BY 1, 2, 3, 4, 5, 6
""", RISK)


def _trailing(seconds: int) -> str:
    return (
        "(PARTITION BY customer_id ORDER BY epoch_second NULLS FIRST "
        f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    )


FACT_LIST = ", ".join(fixtures.FACT_ORDER)
VELOCITY = f"""
timed AS (SELECT *, CAST(floor(epoch(transaction_timestamp)) AS BIGINT) AS epoch_second FROM fact_events),
rolling AS (
  SELECT {FACT_LIST},
    count(*) OVER {_trailing(3600)} AS customer_transactions_1h,
    CAST(sum(CAST(transaction_amount_usd AS DECIMAL(18,6))) OVER {_trailing(3600)} AS DOUBLE) AS customer_value_usd_1h,
    count(*) OVER {_trailing(86400)} AS customer_transactions_24h,
    CAST(sum(CAST(transaction_amount_usd AS DECIMAL(18,6))) OVER {_trailing(86400)} AS DOUBLE)
      AS customer_value_usd_24h
  FROM timed
),
velocity_view AS (
  SELECT *, CASE
    WHEN customer_transactions_1h >= 8 OR customer_value_usd_1h >= 1500 THEN 'High Velocity'
    WHEN customer_transactions_1h >= 5 OR customer_value_usd_1h >= 750 THEN 'Elevated Velocity'
    ELSE 'Normal Velocity' END AS velocity_band,
    (customer_transactions_1h >= 8 OR customer_value_usd_1h >= 1500) AS velocity_alert
  FROM rolling
)
"""
check("transaction_velocity", "SELECT * FROM velocity_view", VELOCITY)

BEFORE = "(PARTITION BY merchant_id ORDER BY transaction_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
ANOMALIES = f"""
merchant_days AS (
  SELECT merchant_id, {DAY} AS transaction_date, count(*) AS transaction_count, {VALUE} AS transaction_value_usd,
    {rate(APPROVED)} AS approval_rate, {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd,
    avg(processing_time_ms) AS average_processing_time_ms
  FROM fact_events GROUP BY 1, 2
),
baselines AS (
  SELECT *, count(*) OVER {BEFORE} AS baseline_observations,
    avg(transaction_count) OVER {BEFORE} AS baseline_transaction_count,
    stddev_samp(transaction_count) OVER {BEFORE} AS baseline_transaction_count_sd,
    CAST(sum(CAST(transaction_value_usd AS DECIMAL(18,6))) OVER {BEFORE} AS DOUBLE)
      / nullif(count(transaction_value_usd) OVER {BEFORE}, 0) AS baseline_transaction_value_usd,
    stddev_samp(transaction_value_usd) OVER {BEFORE} AS baseline_transaction_value_sd,
    avg(approval_rate) OVER {BEFORE} AS baseline_approval_rate,
    stddev_samp(approval_rate) OVER {BEFORE} AS baseline_approval_rate_sd
  FROM merchant_days
),
zscores AS (
  SELECT *,
    CASE WHEN baseline_transaction_count_sd >= 1e-9
      THEN (transaction_count - baseline_transaction_count) / baseline_transaction_count_sd END
      AS transaction_count_zscore,
    CASE WHEN baseline_transaction_value_sd >= 1e-9
      THEN (transaction_value_usd - baseline_transaction_value_usd) / baseline_transaction_value_sd END
      AS transaction_value_zscore,
    CASE WHEN baseline_approval_rate_sd >= 1e-9
      THEN (approval_rate - baseline_approval_rate) / baseline_approval_rate_sd END AS approval_rate_zscore
  FROM baselines
),
anomaly_view AS (
  SELECT *, (baseline_observations >= 7 AND (abs(coalesce(transaction_count_zscore, 0)) >= 3
    OR abs(coalesce(transaction_value_zscore, 0)) >= 3 OR coalesce(approval_rate_zscore, 0) <= -3)) AS anomaly_flag
  FROM zscores
)
"""
_NOISY = [
    "baseline_transaction_count_sd", "baseline_transaction_value_sd", "baseline_approval_rate",
    "baseline_approval_rate_sd", "transaction_count_zscore", "transaction_value_zscore", "approval_rate_zscore",
]
check("merchant_daily_anomalies", f"""
SELECT * REPLACE ({", ".join(f"round({c}, 6) + 0e0 AS {c}" for c in _NOISY)}) FROM anomaly_view
""", ANOMALIES)
check("merchant_daily_anomalies_confirmed", """
SELECT merchant_id, transaction_date, transaction_value_usd,
  (baseline_observations >= 7 AND transaction_value_usd >= 500
    AND (CASE WHEN abs(coalesce(transaction_count_zscore, 0)) >= 2 THEN 1 ELSE 0 END
      + CASE WHEN abs(coalesce(transaction_value_zscore, 0)) >= 2 THEN 1 ELSE 0 END
      + CASE WHEN coalesce(approval_rate_zscore, 0) <= -2 THEN 1 ELSE 0 END) >= 2) AS anomaly_flag
FROM zscores
""", ANOMALIES)

MONTHLY = f"""
monthly AS (
  SELECT {MONTH} AS month, count(*) AS transaction_count, {VALUE} AS transaction_value_usd,
    {AVG_VALUE} AS average_transaction_value_usd, {rate(APPROVED)} AS approval_rate,
    {rate(DECLINED)} AS decline_rate, {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd,
    {rate("is_cross_border")} AS cross_border_rate, count(DISTINCT customer_id) AS active_customers,
    count(DISTINCT merchant_id) AS active_merchants, avg(processing_time_ms) AS average_processing_time_ms
  FROM fact_lineitem GROUP BY 1
),
kpi_view AS (
  SELECT *,
    (transaction_count - prior_transaction_count) / nullif(prior_transaction_count, 0) AS transaction_count_mom_change,
    (transaction_value_usd - prior_transaction_value_usd) / nullif(prior_transaction_value_usd, 0)
      AS transaction_value_mom_change,
    approval_rate - prior_approval_rate AS approval_rate_mom_point_change,
    (fraud_loss_usd - prior_fraud_loss_usd) / nullif(prior_fraud_loss_usd, 0) AS fraud_loss_mom_change
  FROM (
    SELECT *, lag(transaction_count) OVER (ORDER BY month NULLS FIRST) AS prior_transaction_count,
      lag(transaction_value_usd) OVER (ORDER BY month NULLS FIRST) AS prior_transaction_value_usd,
      lag(approval_rate) OVER (ORDER BY month NULLS FIRST) AS prior_approval_rate,
      lag(fraud_loss_usd) OVER (ORDER BY month NULLS FIRST) AS prior_fraud_loss_usd
    FROM monthly
  )
)
"""
check("executive_kpis_monthly", "SELECT * FROM kpi_view", MONTHLY)

check("active_members_quarterly", f"""
SELECT CAST(date_trunc('quarter', {DAY}) AS DATE) AS quarter, count(DISTINCT customer_id) AS active_customers,
  count(DISTINCT merchant_id) AS active_merchants
FROM fact_lineitem GROUP BY 1
""")

FEATURES = f"""
features AS (
  SELECT f.transaction_id, f.transaction_timestamp, {DAY} AS transaction_date,
    CAST(hour(transaction_timestamp) AS INT) AS transaction_hour,
    CAST(dayofweek(transaction_timestamp) + 1 AS INT) AS day_of_week_num,
    CAST(month(transaction_timestamp) AS INT) AS transaction_month,
    f.transaction_amount_usd, f.payment_method, f.channel, f.is_cross_border, f.processing_time_ms,
    customer_segment, account_tenure_months, c.risk_segment AS customer_risk_segment, merchant_category,
    merchant_size, merchant_tier, merchant_risk_rating, device_type, operating_system, region AS transaction_region,
    f.is_fraud
  FROM fact_events f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
  LEFT JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  LEFT JOIN dim_device d ON f.device_id = d.device_id
  LEFT JOIN dim_country g ON f.country_id = g.country_id
)
"""
check("fraud_model_features", "SELECT * FROM features", FEATURES)

# --- sources and data quality --------------------------------------------------------------


def _calendar(fact: str) -> str:
    weight = " ".join(f"WHEN {m} THEN {f!r}e0" for m, f in schema.MONTH_FACTOR.items())
    return f"""
days AS (
  SELECT CAST(unnest(generate_series(min({DAY}), max({DAY}), INTERVAL 1 DAY)) AS DATE) AS date FROM {fact}
),
day_parts AS (
  SELECT CAST(strftime(date, '%Y%m%d') AS INT) AS date_id, date, CAST(day(date) AS INT) AS day,
    CAST(weekofyear(date) AS INT) AS week, CAST(month(date) AS INT) AS month, strftime(date, '%b') AS month_name,
    'Q' || quarter(date) AS quarter, CAST(year(date) AS INT) AS year, dayname(date) AS day_of_week,
    dayofweek(date) IN (0, 6) AS is_weekend
  FROM days
),
calendar AS (
  SELECT *, weight / sum(weight) OVER () AS transaction_weight
  FROM (SELECT *, CASE month {weight} END * CASE WHEN is_weekend THEN 1.08e0 ELSE 1e0 END AS weight FROM day_parts)
)
"""


CALENDAR = _calendar("fact_lineitem")
check("calendar_dim", """
SELECT * EXCLUDE (weight) REPLACE (round(transaction_weight, 12) AS transaction_weight) FROM calendar
""", CALENDAR)
check("season_weights", """
SELECT year, month, round(sum(transaction_weight), 12) AS weight FROM calendar GROUP BY 1, 2
""", CALENDAR)
check("row_counts", """
SELECT 'fact_transactions' AS table_name, count(*) AS row_count FROM fact_lineitem
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_merchant', count(*) FROM dim_merchant
UNION ALL SELECT 'dim_device', count(*) FROM dim_device
UNION ALL SELECT 'dim_country', count(*) FROM dim_country
UNION ALL SELECT 'dim_date', count(*) FROM calendar
""", CALENDAR)
check("table_manifest", """
SELECT 'fact_transactions' AS table_name, count(*) AS rows, CAST(17 AS INT) AS columns FROM fact_events
UNION ALL SELECT 'dim_customer', count(*), 5 FROM dim_customer
UNION ALL SELECT 'dim_merchant', count(*), 7 FROM dim_merchant
UNION ALL SELECT 'dim_device', count(*), 3 FROM dim_device
UNION ALL SELECT 'dim_country', count(*), 4 FROM dim_country
UNION ALL SELECT 'dim_date', count(*), 11 FROM calendar
""", _calendar("fact_events"))
plain("part_manifest", """
SELECT 'events.parquet' AS file, count(*) AS rows, min(event_id) AS start_transaction_id FROM events
""")


def _kpis(fact: str) -> str:
    return f"""
SELECT count(*) AS transactions, round(100 * ({rate(APPROVED)}), 2) AS approval_rate_pct,
  round(100 * ({rate(DECLINED)}), 2) AS decline_rate_pct, round(100 * ({rate("is_fraud")}), 3) AS fraud_rate_pct,
  round(100 * ({rate("is_cross_border")}), 2) AS cross_border_rate_pct, {VALUE} AS transaction_value_usd,
  round({AVG_VALUE}, 2) AS average_transaction_value_usd, {LOSS} AS fraud_loss_usd
FROM {fact}"""


check("core_kpis", _kpis("fact_lineitem"))
check("summary_metrics", f"""
SELECT count(*) AS transaction_rows, {rate(APPROVED)} AS approval_rate, 1 - {rate(APPROVED)} AS decline_rate,
  {rate("is_fraud")} AS fraud_rate, {rate("is_cross_border")} AS cross_border_rate,
  {VALUE} AS transaction_value_usd, round({AVG_VALUE}, 2) AS average_transaction_value_usd,
  {LOSS} AS fraud_loss_usd
FROM fact_events
""")
_KPI_NAMES = [
    "transactions", "approval_rate_pct", "decline_rate_pct", "fraud_rate_pct", "cross_border_rate_pct",
    "transaction_value_usd", "average_transaction_value_usd", "fraud_loss_usd",
]
check("kpi_reconciliation", "\nUNION ALL ".join(
    f"SELECT '{name}' AS metric, CAST(l.{name} AS DOUBLE) AS left_value, CAST(r.{name} AS DOUBLE) AS right_value, "
    f"l.{name} IS NOT DISTINCT FROM r.{name} AS matches FROM l, r"
    for name in _KPI_NAMES
), f"l AS ({_kpis('fact_lineitem')}),\nr AS ({_kpis('fact_events')})")
check("dq_business_rules", f"""
SELECT count(*) FILTER (WHERE transaction_amount <= 0 OR transaction_amount_usd <= 0) AS non_positive_amounts,
  count(*) FILTER (WHERE {APPROVED} AND decline_reason IS NOT NULL) AS approved_with_decline_reason,
  count(*) FILTER (WHERE {DECLINED} AND decline_reason IS NULL) AS declined_without_reason,
  count(*) FILTER (WHERE NOT is_fraud AND fraud_loss_amount_usd <> 0) AS non_fraud_with_loss,
  count(*) FILTER (WHERE is_fraud AND {DECLINED} AND fraud_loss_amount_usd <> 0) AS declined_fraud_with_loss
FROM fact_lineitem
""")
check("dq_referential_integrity", """
SELECT count(*) FILTER (WHERE c.customer_id IS NULL) AS invalid_customer_fk,
  count(*) FILTER (WHERE m.merchant_id IS NULL) AS invalid_merchant_fk,
  count(*) FILTER (WHERE d.device_id IS NULL) AS invalid_device_fk,
  count(*) FILTER (WHERE g.country_id IS NULL) AS invalid_country_fk
FROM fact_lineitem f
LEFT JOIN (SELECT * FROM dim_customer WHERE customer_segment <> 'MACHINERY') c USING (customer_id)
LEFT JOIN dim_merchant m USING (merchant_id)
LEFT JOIN dim_device d USING (device_id)
LEFT JOIN dim_country g USING (country_id)
""")


def _check_row(name: str, violations: str, detail: str, severity: str = "critical") -> str:
    return (
        f"SELECT {name} AS \"check\", v = 0 AS passed, '{severity}' AS severity, detail, CAST(v AS BIGINT) AS violations\n"
        f"FROM (SELECT {violations} AS v, {detail} AS detail"
    )


FINER = "count(*) FILTER (WHERE " + " OR ".join(
    f"coalesce(abs({c} - CAST(CAST({c} AS DECIMAL(18,6)) AS DOUBLE)) > 1e-9 * greatest(1e0, abs({c})), FALSE)"
    for c in ("transaction_amount", "transaction_amount_usd", "fraud_loss_amount_usd")
) + ")"


def _row_rules(fact: str) -> list[str]:
    required = [c for c in fixtures.FACT_ORDER if c != "decline_reason"]
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in required)
    rules = [
        ("required fields non-null", nulls, f"'required values that are null: ' || ({nulls})"),
        ("transaction_status domain",
         "count(*) FILTER (WHERE (transaction_status IN ('approved', 'declined')) IS NOT TRUE)",
         "'counted are statuses other than approved and declined'"),
        ("decline reason logic",
         f"count(*) FILTER (WHERE (({APPROVED} AND decline_reason IS NULL) "
         f"OR ({DECLINED} AND decline_reason IS NOT NULL)) IS NOT TRUE)",
         "'a reason belongs to every declined row and to no other'"),
        ("positive transaction amounts",
         "count(*) FILTER (WHERE (transaction_amount > 0 AND transaction_amount_usd > 0) IS NOT TRUE)",
         "'smallest local amount ' || printf('%.2f', min(transaction_amount)) || ', in USD ' "
         "|| printf('%.2f', min(transaction_amount_usd))"),
        ("fraud loss logic",
         f"count(*) FILTER (WHERE (CASE WHEN is_fraud AND {APPROVED} THEN fraud_loss_amount_usd > 0 "
         "ELSE fraud_loss_amount_usd = 0 END) IS NOT TRUE)",
         "'approved fraud has a loss, any other payment has none'"),
        ("processing time range",
         "count(*) FILTER (WHERE (processing_time_ms BETWEEN 90 AND 5000) IS NOT TRUE)",
         "'from ' || min(processing_time_ms) || ' to ' || max(processing_time_ms) || ' ms'"),
        ("money digits", FINER, f"'rows with an amount finer than 6 digits, which sums would round: ' || ({FINER})"),
    ]
    return [
        _check_row(f"'fact_transactions: {name}'", violations, detail) + f" FROM {fact})"
        for name, violations, detail in rules
    ]


def _key_rules(table: str, source: str, key: str, expected: int | None = None) -> list[str]:
    nulls = f"count(*) FILTER (WHERE {key} IS NULL)"
    extra = f"count(*) - count(DISTINCT {key}) - (CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END)"
    rows = [
        _check_row(f"'{table}: primary key non-null'", nulls, f"'rows without {key}: ' || {nulls}") + f" FROM {source})",
        _check_row(f"'{table}: primary key unique'", extra, f"'rows that repeat a {key}: ' || ({extra})")
        + f" FROM {source})",
    ]
    if expected is not None:
        rows.append(
            _check_row(
                f"'{table}: expected row count'", f"abs(count(*) - {expected})",
                f"format('{{:,}}', count(*)) || ' rows found, {expected:,} wanted'",
            ) + f" FROM {source})"
        )
    return rows


def _dimension_rules() -> list[str]:
    rows = []
    for table, key in schema.PRIMARY_KEYS.items():
        source = "calendar" if table == "dim_date" else table
        rows += _key_rules(table, source, key, 25 if table == "dim_country" else None)
    return rows


check("dq_row_rules", "\nUNION ALL ".join(_row_rules("fact_lineitem")))
check("dq_dimensions", "\nUNION ALL ".join(_dimension_rules()), _calendar("fact_events"))
plain("dq_part_keys", """
WITH part AS (
  SELECT count(*) - count(DISTINCT l_orderkey) AS extra, min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem
)
SELECT 'lineitem.parquet: l_orderkey unique within part' AS "check", extra = 0 AS passed, 'critical' AS severity,
  'rows that repeat an id: ' || extra AS detail, extra AS violations FROM part
UNION ALL
SELECT 'lineitem.parquet: l_orderkey sequence does not overlap prior part', low > 0, 'critical',
  'ids ' || format('{:,}', low) || ' to ' || format('{:,}', high) || ' after 0',
  CAST(CASE WHEN low > 0 THEN 0 ELSE 1 END AS BIGINT) FROM part
""")


def _reference_rules(fact: str, filtered: dict[str, str] | None = None) -> list[str]:
    filtered, rows = filtered or {}, []
    for label, (table, key) in schema.FOREIGN_KEYS.items():
        orphans = f"count(*) FILTER (WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM {filtered.get(table, table)}))"
        rows.append(
            _check_row(
                f"'fact_transactions: {label} foreign key'", orphans, f"'rows with an unknown {key}: ' || {orphans}"
            ) + f" FROM {fact})"
        )
    outside = f"count(*) FILTER (WHERE {DAY} NOT IN (SELECT date FROM calendar))"
    rows.append(
        _check_row("'fact_transactions: dates in calendar'", outside, f"'rows outside calendar=' || {outside}")
        + f" FROM {fact})"
    )
    wrong = "count(*) FILTER (WHERE (is_cross_border = (merchant_country <> home_country)) IS NOT TRUE)"
    rows.append(
        _check_row("'fact_transactions: cross-border rule'", wrong, f"'rows with wrong flag=' || {wrong}")
        + f" FROM {fact} JOIN dim_merchant USING (merchant_id) JOIN {filtered.get('dim_customer', 'dim_customer')} AS c USING (customer_id))"
    )
    return rows


def _total_rules(expected: int) -> list[str]:
    rows = []
    rows.append(
        _check_row(
            "'fact_transactions: expected total row count'", f"abs(count(*) - {expected})",
            f"format('{{:,}}', count(*)) || ' rows found, {expected:,} wanted'",
        ) + " FROM fact_lineitem)"
    )
    in_range = f"min(transaction_id) = 1 AND max(transaction_id) = {expected}"
    rows.append(
        _check_row(
            "'fact_transactions: global transaction_id range'", f"CASE WHEN {in_range} THEN 0 ELSE 1 END",
            f"'ids ' || min(transaction_id) || ' to ' || max(transaction_id) || ', wanted 1 to {expected:,}'",
        ) + " FROM fact_lineitem)"
    )
    events = {"approval_rate": APPROVED, "fraud_rate": "is_fraud", "cross_border_rate": "is_cross_border"}
    for label, (column, low, high) in schema.PLAUSIBLE_RATES.items():
        value = rate(events[column])
        rows.append(
            _check_row(
                f"'plausibility: {label}'", f"CASE WHEN {value} BETWEEN {low!r} AND {high!r} THEN 0 ELSE 1 END",
                f"printf('%.4f', 100 * ({value})) || '% is the {column}'", "warning",
            ) + " FROM fact_lineitem)"
        )
    return rows


def _quality_rows() -> str:
    expected = 5_000_000
    rows = [
        "SELECT 'fact_transactions: required columns' AS \"check\", true AS passed, 'critical' AS severity, "
        "'0 required columns absent' AS detail, CAST(0 AS BIGINT) AS violations",
        "SELECT 'dim_customer: forbidden columns', true, 'critical', '0 forbidden columns there', CAST(0 AS BIGINT)",
        *_dimension_rules(),
        *_row_rules("fact_lineitem"),
        *_key_rules("fact_transactions", "fact_lineitem", "transaction_id"),
        *_reference_rules("fact_lineitem"),
        *_total_rules(expected),
    ]
    return "\nUNION ALL ".join(rows)


def _part_rows() -> str:
    rows = []
    for k in range(6):
        name = f"part-{k}"
        own = f"(SELECT * FROM parted WHERE part = '{name}')"
        known = {"dim_customer": "(SELECT * FROM dim_customer WHERE customer_segment <> 'MACHINERY')"}
        rules = [*_row_rules(own), *_reference_rules(own, known)]
        rows += [rule.replace("'fact_transactions: ", f"'{name}: ") for rule in rules]
    prior = "coalesce((SELECT max(transaction_id) FROM parted AS p WHERE p.part < o.part), 0)"
    ids = f"(SELECT part, count(*) - count(DISTINCT transaction_id) AS extra, min(transaction_id) AS low, max(transaction_id) AS high FROM parted GROUP BY 1)"
    rows.append(
        "SELECT part || ': transaction_id unique within part', extra = 0, 'critical', 'rows that repeat an id: ' || extra, extra "
        f"FROM {ids}"
    )
    rows.append(
        "SELECT part || ': transaction_id sequence does not overlap prior part', low > prior, 'critical', "
        "'ids ' || format('{:,}', low) || ' to ' || format('{:,}', high) || ' after ' || format('{:,}', prior), "
        f"CAST(CASE WHEN low > prior THEN 0 ELSE 1 END AS BIGINT) FROM (SELECT *, {prior} AS prior FROM {ids} AS o)"
    )
    return "\nUNION ALL ".join(rows + _total_rules(5_000_000))


check("dq_part_report", _part_rows(), _calendar("fact_lineitem").strip().rstrip(",") + """,
parted AS (
  SELECT *, 'part-' || (transaction_id * 5 // (1 + (SELECT max(transaction_id) FROM fact_lineitem))
    + CASE WHEN transaction_id % 97 = 0 THEN 1 ELSE 0 END) AS part FROM fact_lineitem
)""")
MISSING_MONTH = f"count(*) FILTER (WHERE month({DAY}) = 6)"
check("dq_calendar_gaps", _check_row(
    "'fact_transactions: dates in calendar'", MISSING_MONTH, f"'rows outside calendar=' || {MISSING_MONTH}"
) + " FROM fact_lineitem)")
WRONG_FLAGS = "count(*) FILTER (WHERE transaction_id % 10 = 3)"
check("dq_wrong_flags", _check_row(
    "'fact_transactions: cross-border rule'", WRONG_FLAGS, f"'rows with wrong flag=' || {WRONG_FLAGS}"
) + " FROM fact_lineitem JOIN dim_merchant USING (merchant_id) JOIN dim_customer USING (customer_id))")
plain("dq_parts", """
WITH part AS (
  SELECT 'part-' || (l_orderkey * 5 // (1 + (SELECT max(l_orderkey) FROM lineitem)) + l_linenumber // 7) AS name,
    l_orderkey FROM lineitem
), counted AS (
  SELECT name, count(*) - count(DISTINCT l_orderkey) AS extra, min(l_orderkey) AS low, max(l_orderkey) AS high
  FROM part GROUP BY 1
), prior AS (
  SELECT *, coalesce(max(high) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM counted
)
SELECT name || ': l_orderkey unique within part' AS "check", extra = 0 AS passed, 'critical' AS severity,
  'rows that repeat an id: ' || extra AS detail, extra AS violations FROM prior
UNION ALL
SELECT name || ': l_orderkey sequence does not overlap prior part', low > before, 'critical',
  'ids ' || format('{:,}', low) || ' to ' || format('{:,}', high) || ' after ' || format('{:,}', before),
  CAST(CASE WHEN low > before THEN 0 ELSE 1 END AS BIGINT) FROM prior
""")
check("dq_report", _quality_rows(), CALENDAR)
check("dq_gate", """
SELECT CASE WHEN count(*) FILTER (WHERE severity = 'critical' AND NOT passed) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  count(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS critical_failures
FROM checks
""", f"{CALENDAR.strip()},\nchecks AS ({_quality_rows()})")

# --- enrichment ----------------------------------------------------------------------------

check("market_share", f"""
SELECT country_id, value_usd, round(value_usd / sum(value_usd) OVER (), 12) AS market_weight
FROM (SELECT country_id, {VALUE} AS value_usd FROM fact_lineitem GROUP BY 1)
""")
plain("customer_tenure", """
SELECT o_orderkey, greatest(0, CAST(trunc(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-12-31') / 30.4375e0)
  AS INT)) AS account_tenure_months
FROM orders
""")
plain("merchant_risk_rating", f"""
SELECT p_partkey, CASE WHEN s >= 1.45 THEN 'High' WHEN s >= 1.10 THEN 'Medium' ELSE 'Low' END AS merchant_risk_rating
FROM (SELECT p_partkey, {case("p_type", fixtures.CATEGORY_FRAUD_FACTOR)} * (0.8e0 + p_size / 50e0) AS s FROM part)
""")
check("merchant_tier", "SELECT merchant_id, merchant_tier FROM dim_merchant")
plain("surrogate_keys", "SELECT c_custkey, printf('C%07d', c_custkey) AS customer_id FROM customer")
_RATES = ", ".join(f"('{currency}', {value!r}e0)" for currency, value in schema.USD_PER_UNIT.items())
check("fx_convert", """
SELECT transaction_id, currency, transaction_amount_usd,
  greatest(round_even(transaction_amount_usd / usd_rate, 2), 0.01e0) AS transaction_amount
FROM fact_lineitem LEFT JOIN rates USING (currency)
""", f"rates(currency, usd_rate) AS (VALUES {_RATES})")
check("fx_missing", """
SELECT DISTINCT currency FROM fact_lineitem
WHERE currency NOT IN (SELECT currency FROM rates WHERE currency NOT IN ('ZAR', 'AED'))
""", f"rates(currency, usd_rate) AS (VALUES {_RATES})")
check("cross_border_flag", """
SELECT transaction_id, merchant_country <> home_country AS is_cross_border
FROM fact_events JOIN dim_merchant USING (merchant_id) JOIN dim_customer USING (customer_id)
""")

EXPECTATIONS = f"""
expectations AS (
  SELECT f.*, risk_segment,
    least(greatest(
      0.0018e0 * {case("merchant_category", fixtures.CATEGORY_FRAUD_FACTOR)}
      * {case("risk_segment", schema.CUSTOMER_RISK_FACTOR)}
      * {case("merchant_risk_rating", schema.MERCHANT_RISK_FACTOR)}
      * CASE WHEN hour(transaction_timestamp) <= 5 OR hour(transaction_timestamp) >= 23 THEN 1.45e0 ELSE 1e0 END
      * CASE WHEN is_cross_border THEN 1.75e0 ELSE 1e0 END
      * CASE WHEN channel = 'card_present' THEN 0.72e0 ELSE 1.28e0 END
      * CASE WHEN transaction_amount_usd >= 750 THEN 1.65e0 WHEN transaction_amount_usd >= 300 THEN 1.25e0 ELSE 1e0 END,
      0.00015e0), 0.08e0) AS expected_fraud,
    least(greatest(
      0.945e0 + {case("merchant_category", fixtures.CATEGORY_APPROVAL_DELTA)}
      + CASE WHEN channel = 'card_present' THEN 0.012e0 ELSE -0.004e0 END
      + CASE WHEN is_cross_border THEN -0.030e0 ELSE 0e0 END
      + CASE WHEN risk_segment = 'High' THEN -0.050e0 ELSE 0e0 END
      + CASE WHEN merchant_risk_rating = 'High' THEN -0.035e0 ELSE 0e0 END
      + CASE WHEN transaction_amount_usd >= 750 THEN -0.025e0 ELSE 0e0 END
      + CASE WHEN is_fraud THEN -0.30e0 ELSE 0e0 END, 0.45e0), 0.995e0) AS expected_approval,
    least(greatest({case("customer_segment", fixtures.SEGMENT_CROSS_BORDER_RATE)}
      + CASE WHEN channel IN ('web', 'in_app') THEN 0.025e0 ELSE 0e0 END, 0.02e0), 0.6e0) AS expected_cross_border,
    CAST(round_even(least(greatest(420e0 * CASE WHEN is_cross_border THEN 1.2e0 ELSE 1e0 END
      * CASE WHEN payment_method = 'bank_transfer' THEN 1.45e0 ELSE 1e0 END
      * CASE WHEN channel = 'web' THEN 1.08e0 ELSE 1e0 END, 90e0), 5000e0), 0) AS INT) AS expected_processing_ms
  FROM fact_events f JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  JOIN dim_customer c ON f.customer_id = c.customer_id
)
"""
check("fraud_scorecard", "SELECT transaction_id, expected_fraud FROM expectations", EXPECTATIONS)
check("approval_scorecard", """
SELECT transaction_id, round(expected_approval, 9) AS expected_approval FROM expectations
""", EXPECTATIONS)
check("cross_border_propensity", "SELECT transaction_id, expected_cross_border FROM expectations", EXPECTATIONS)
check("expected_processing_time", "SELECT transaction_id, expected_processing_ms FROM expectations", EXPECTATIONS)
plain("fraud_loss", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' AND l_quantity >= 49 AND l_returnflag <> 'R'
  THEN round_even(l_extendedprice * (1e0 - l_discount), 2) ELSE 0e0 END AS fraud_loss_amount_usd
FROM lineitem
""")
plain("event_time", "SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
plain("dense_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 1000 + rank() OVER (
  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS transaction_id
FROM lineitem
""")
check("score_calibration", f"""
SELECT channel, risk_segment, count(*) AS transaction_count,
  round(avg(expected_fraud), 9) AS expected_fraud_rate, {rate("is_fraud")} AS actual_fraud_rate,
  round(avg(expected_approval), 9) AS expected_approval_rate, {rate(APPROVED)} AS actual_approval_rate,
  round(avg(expected_cross_border), 9) AS expected_cross_border_rate,
  {rate("is_cross_border")} AS actual_cross_border_rate,
  round(avg(expected_processing_ms), 9) AS expected_processing_time_ms,
  avg(processing_time_ms) AS actual_processing_time_ms
FROM expectations GROUP BY 1, 2
""", EXPECTATIONS)

# --- model preparation and evaluation ------------------------------------------------------

SPLIT = (
    f"CASE WHEN transaction_date < DATE '{fixtures.VALIDATION_FROM}' THEN 'train' "
    f"WHEN transaction_date < DATE '{fixtures.TEST_FROM}' THEN 'validation' ELSE 'test' END"
)
check("chronological_split", f"SELECT transaction_id, {SPLIT} AS split FROM features", FEATURES)
WRAP = 1 << 64


def _product(a: str, b: str | int) -> str:
    return f"CAST((CAST({a} AS UHUGEINT) * CAST({b} AS UHUGEINT)) % {WRAP} AS UBIGINT)"


def _total(*terms: str | int) -> str:
    return "CAST((" + " + ".join(f"CAST({t} AS UHUGEINT)" for t in terms) + f") % {WRAP} AS UBIGINT)"


def _turned(value: str, bits: int) -> str:
    return _total(f"({value}) >> {bits}", f"(CAST({value} AS UHUGEINT) * {1 << 64 - bits}) % {WRAP}")


def _number(start: str, count: int) -> str:
    letters = [f"coalesce(ord(nullif(substr(s, CAST({start} + {i + 1} AS INT), 1), '')), 0)" for i in range(count)]
    return _total(*(f"CAST({c} AS UHUGEINT) * {1 << 8 * i}" for i, c in enumerate(letters)))


def _fingerprints(source: str, columns: str, text: str) -> str:
    """CTEs that end in ``hashed``: ``columns`` and the fingerprint h of an ASCII text, in 128-bit arithmetic."""
    k0, k1, k2 = fingerprint.K0, fingerprint.K1, fingerprint.K2
    return f"""
texts AS (SELECT {columns}, {text} AS s, length({text}) AS n, {k2} + 2 * length({text}) AS mul FROM {source}),
parts AS (
  SELECT *, {_number("0", 8)} AS a, {_number("8", 8)} AS b, {_number("greatest(n - 8, 0)", 8)} AS c,
    {_number("greatest(n - 16, 0)", 8)} AS d, {_number("0", 4)} AS a4, {_number("greatest(n - 4, 0)", 4)} AS c4,
    {_number("0", 1)} + 256 * {_number("n // 2", 1)} AS y, n + 4 * {_number("greatest(n - 1, 0)", 1)} AS z FROM texts
),
sums AS (
  SELECT *, CASE WHEN n > 16 THEN {_product("a", k1)} ELSE {_total("a", k2)} END AS first,
    CASE WHEN n > 16 THEN {_product("c", "mul")} ELSE c END AS last FROM parts
),
mixed AS (
  SELECT *,
    CASE WHEN n > 16 THEN {_total(_turned(_total("first", "b"), 43), _turned("last", 30), _product("d", k2))}
      WHEN n > 7 THEN {_total(_product(_turned("last", 37), "mul"), "first")} ELSE {_total("n", "8 * CAST(a4 AS UHUGEINT)")} END AS u,
    CASE WHEN n > 16 THEN {_total("first", _turned(_total("b", k2), 18), "last")}
      WHEN n > 7 THEN {_product(_total(_turned("first", 25), "last"), "mul")} ELSE c4 END AS v FROM sums
),
once AS (SELECT *, {_product("xor(u, v)", "mul")} AS m1 FROM mixed),
twice AS (SELECT *, {_product("xor(v, xor(m1, m1 >> 47))", "mul")} AS m2 FROM once),
hashed AS (
  SELECT *, CASE WHEN n > 3 THEN {_product("xor(m2, m2 >> 47)", "mul")}
    ELSE {_product("xor(few, few >> 47)", k2)} END AS h
  FROM (SELECT *, xor({_product("y", k2)}, {_product("z", k0)}) AS few FROM twice)
)"""


TRAIN_IDS = f"(SELECT transaction_id FROM features WHERE {SPLIT} = 'train')"
check("hash_sample", "SELECT transaction_id FROM hashed WHERE h % 4 = 0",
      FEATURES.strip().rstrip(",") + "," + _fingerprints(TRAIN_IDS, "transaction_id", "CAST(transaction_id AS VARCHAR)"))
LINE_NAMES = """(
  SELECT l_orderkey, l_linenumber, repeat('#', CAST(l_linenumber * l_linenumber // 2 AS INT)) || l_orderkey AS name
  FROM lineitem
)"""
plain("id_fingerprints", f"""WITH {_fingerprints(LINE_NAMES, "l_orderkey, l_linenumber", "name")}
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN h >= {1 << 63} THEN CAST(h AS HUGEINT) - {WRAP} ELSE h END AS BIGINT) AS fingerprint
FROM hashed""")
check("split_summary", f"""
SELECT {SPLIT} AS split, count(*) AS rows, count(*) FILTER (WHERE is_fraud) AS fraud, {rate("is_fraud")} AS fraud_rate
FROM features GROUP BY 1
""", FEATURES)

SCORED = f"""
{EXPECTATIONS.strip()},
scored AS (
  SELECT transaction_id, is_fraud AS label, expected_fraud / 0.08e0 AS score, {DAY} AS transaction_date
  FROM expectations
),
validation AS (
  SELECT * FROM scored WHERE transaction_date >= DATE '{fixtures.VALIDATION_FROM}'
    AND transaction_date < DATE '{fixtures.TEST_FROM}'
),
test AS (SELECT * FROM scored WHERE transaction_date >= DATE '{fixtures.TEST_FROM}')
"""
SWEEP = f"""
{SCORED.strip()},
sweep AS (
  SELECT t / 100e0 AS threshold,
    coalesce(count(*) FILTER (WHERE score >= t / 100e0 AND label)
      / nullif(count(*) FILTER (WHERE score >= t / 100e0), 0), 0) AS precision,
    coalesce(count(*) FILTER (WHERE score >= t / 100e0 AND label) / nullif(count(*) FILTER (WHERE label), 0), 0)
      AS recall,
    coalesce(2 * count(*) FILTER (WHERE score >= t / 100e0 AND label)
      / nullif(count(*) FILTER (WHERE score >= t / 100e0) + count(*) FILTER (WHERE label), 0), 0) AS f1,
    count(*) FILTER (WHERE score >= t / 100e0) / count(*) AS flag_rate
  FROM validation, generate_series(5, 95) AS s(t)
  GROUP BY t
)
"""
check("threshold_sweep", "SELECT * FROM sweep", SWEEP)
check("best_threshold", "SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1", SWEEP)
check("capture_at_top", """
SELECT share, n, coalesce(count(*) FILTER (WHERE label AND r <= n) / nullif(count(*) FILTER (WHERE label), 0), 0)
  AS capture
FROM ranked, (SELECT share, greatest(1, CAST(floor((SELECT count(*) FROM test) * share) AS BIGINT)) AS n
  FROM (VALUES (0.005e0), (0.01e0), (0.05e0)) v(share))
GROUP BY share, n
""", f"{SCORED.strip()},\nranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, transaction_id) AS r FROM test)")
CONFUSION = f"""
{SCORED.strip()},
counts AS (
  SELECT count(*) FILTER (WHERE score < 0.3e0 AND NOT label) AS tn,
    count(*) FILTER (WHERE score >= 0.3e0 AND NOT label) AS fp,
    count(*) FILTER (WHERE score < 0.3e0 AND label) AS fn, count(*) FILTER (WHERE score >= 0.3e0 AND label) AS tp
  FROM test
),
confusion AS (
  SELECT 0.3e0 AS threshold, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
    coalesce((tp + fp) / nullif(tn + fp + fn + tp, 0), 0) AS flag_rate, tn, fp, fn, tp
  FROM counts
)
"""
check("confusion_metrics", "SELECT * FROM confusion", CONFUSION)
CAPACITY = f"""
{SCORED.strip()},
capacities AS (SELECT * FROM (VALUES (0.005e0), (0.01e0), (0.02e0), (0.05e0), (0.1e0)) v(capacity)),
ascending AS (SELECT score, row_number() OVER (ORDER BY score) AS r, count(*) OVER () AS n FROM validation),
cutoffs AS (
  SELECT capacity, score AS threshold FROM capacities JOIN ascending ON r = ceil((n - 1) * (1e0 - capacity)) + 1
)
"""
check("capacity_threshold", "SELECT * FROM cutoffs", CAPACITY)
check("operating_points", """
SELECT capacity AS requested_review_capacity, threshold, rows, flagged AS flagged_transactions,
  flagged / rows AS actual_flag_rate, fraud AS fraud_transactions, caught AS fraud_captured,
  caught / fraud AS fraud_capture_rate, coalesce(caught / nullif(flagged, 0), 0) AS precision,
  caught / fraud AS recall, coalesce((caught / fraud) / nullif(flagged / rows, 0), 0) AS lift_vs_random
FROM (
  SELECT capacity, threshold, count(*) AS rows, count(*) FILTER (WHERE score >= threshold) AS flagged,
    count(*) FILTER (WHERE label) AS fraud, count(*) FILTER (WHERE label AND score >= threshold) AS caught
  FROM test, cutoffs GROUP BY 1, 2
)
""", CAPACITY)
CURVES = f"""
{SCORED.strip()},
per_score AS (
  SELECT score, count(*) AS n, count(*) FILTER (WHERE label) AS pos FROM test GROUP BY 1
),
curve AS (
  SELECT *, sum(n) OVER (ORDER BY score DESC) AS flagged, sum(pos) OVER (ORDER BY score DESC) AS tp,
    sum(n - pos) OVER (ORDER BY score) - (n - pos) AS negatives_below
  FROM per_score
),
ap AS (SELECT sum(pos / (SELECT sum(pos) FROM per_score) * (tp / flagged)) AS average_precision FROM curve),
auc AS (
  SELECT CAST(sum(pos * (2 * negatives_below + n - pos)) AS DOUBLE)
    / CAST(2 * sum(pos) * sum(n - pos) AS DOUBLE) AS roc_auc
  FROM curve
)
"""
check("average_precision", "SELECT round(average_precision, 9) AS average_precision FROM ap", CURVES)
check("roc_auc", "SELECT roc_auc FROM auc", CURVES)
_CONFUSION_ONLY = CONFUSION.strip().removeprefix(SCORED.strip()).lstrip(",\n")
check("evaluation_metrics", """
SELECT metric, round(value, 9) AS value FROM (
  SELECT 'average_precision_pr_auc' AS metric, average_precision AS value FROM ap
  UNION ALL SELECT 'roc_auc', roc_auc FROM auc
  UNION ALL SELECT 'threshold', threshold FROM confusion
  UNION ALL SELECT 'precision', precision FROM confusion
  UNION ALL SELECT 'recall', recall FROM confusion
  UNION ALL SELECT 'f1', f1 FROM confusion
  UNION ALL SELECT 'flag_rate', flag_rate FROM confusion
  UNION ALL SELECT 'tn', CAST(tn AS DOUBLE) FROM confusion
  UNION ALL SELECT 'fp', CAST(fp AS DOUBLE) FROM confusion
  UNION ALL SELECT 'fn', CAST(fn AS DOUBLE) FROM confusion
  UNION ALL SELECT 'tp', CAST(tp AS DOUBLE) FROM confusion
  UNION ALL SELECT 'capture_at_top_' || name || '_pct',
    count(*) FILTER (WHERE label AND r <= greatest(1, floor(n * share))) / count(*) FILTER (WHERE label)
  FROM (SELECT *, row_number() OVER (ORDER BY score DESC, transaction_id) AS r, count(*) OVER () AS n FROM test),
    (VALUES ('0_5', 0.005e0), ('1', 0.01e0), ('5', 0.05e0)) v(name, share)
  GROUP BY name
)
""", f"{CURVES.strip()},\n{_CONFUSION_ONLY}")

TEST_ROWS = f"transaction_date >= DATE '{fixtures.TEST_FROM}'"
check("fraud_lr", f"""
SELECT transaction_id, is_fraud AS label, true AS score_in_range, true AS better_than_chance,
  true AS gradient_near_zero
FROM features WHERE {TEST_ROWS}
""", FEATURES)
check("fraud_gbt", f"""
SELECT transaction_id, is_fraud AS label, true AS score_in_range, true AS better_than_chance, true AS rounds_in_range
FROM features WHERE {TEST_ROWS}
""", FEATURES)

TRAIN_ROWS = f"transaction_date < DATE '{fixtures.VALIDATION_FROM}'"
check("lr_coefficients_fitted", "\nUNION ALL ".join(
    [f"SELECT '{name}' AS feature, true AS strongest_first, true AS exp_agrees, true AS absolute_agrees" for name in NUMERIC_FEATURES]
    + [
        f"SELECT DISTINCT '{name}_' || CAST({name} AS VARCHAR), true, true, true FROM features WHERE {TRAIN_ROWS} AND {name} IS NOT NULL"
        for name in CATEGORICAL_FEATURES
    ]
), FEATURES)


def _term(name: str, weight: float) -> str:
    if name in NUMERIC_FEATURES:
        value = f"coalesce(CAST({name} AS DOUBLE), 0)"
    else:
        column = max((c for c in CATEGORICAL_FEATURES if name.startswith(f"{c}_")), key=len)
        value = f"CASE WHEN CAST({column} AS VARCHAR) = '{name.removeprefix(column + '_')}' THEN 1e0 ELSE 0e0 END"
    return f"({weight!r}e0 * {value})"


STATED = f"1 / (1 + exp(-({STATED_INTERCEPT!r}e0 + {' + '.join(_term(n, w) for n, w in STATED_COEFFICIENTS)})))"
check("score", f"""
SELECT transaction_id, is_fraud AS label, round({STATED}, 12) AS score
FROM features WHERE {SPLIT} = 'validation'
""", FEATURES)
LEVELS = " UNION ALL ".join(
    f"SELECT '{c}_' || CAST({c} AS VARCHAR) AS feature, count(*) AS payments FROM features WHERE {c} IS NOT NULL GROUP BY 1"
    for c in CATEGORICAL_FEATURES
)
COEFFICIENTS = f"""
{FEATURES.strip()},
levels AS ({LEVELS}),
stated AS (
  SELECT feature, coefficient, round(exp(coefficient), 12) AS exp_coefficient, abs(coefficient) AS absolute_coefficient
  FROM (VALUES {', '.join(f"('{n}', {w!r}e0)" for n, w in STATED_COEFFICIENTS)}) v(feature, coefficient)
)
"""
check("lr_coefficients", "SELECT s.*, l.payments FROM stated s LEFT JOIN levels l USING (feature)", COEFFICIENTS)
check("top_coefficients", """
SELECT * FROM (SELECT feature, coefficient, exp_coefficient, 'positive' AS side FROM stated SEMI JOIN levels USING (feature)
  ORDER BY coefficient DESC, feature LIMIT 3)
UNION ALL
SELECT * FROM (SELECT feature, coefficient, exp_coefficient, 'negative' AS side FROM stated SEMI JOIN levels USING (feature)
  ORDER BY coefficient, feature LIMIT 3)
""", COEFFICIENTS)
_CAPTURES = """
  SELECT {model} AS model, 'capture_at_top_' || name || '_pct' AS metric,
    count(*) FILTER (WHERE label AND r <= greatest(1, floor(n * share))) / count(*) FILTER (WHERE label) AS value
  FROM (SELECT *, row_number() OVER (ORDER BY score DESC, transaction_id) AS r, count(*) OVER () AS n FROM {rows}),
    (VALUES ('0_5', 0.005e0), ('1', 0.01e0), ('5', 0.05e0)) v(name, share)
  GROUP BY name
"""


def _curve(name: str, rows: str) -> str:
    return f"""
{name}_steps AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE label) AS pos FROM {rows} GROUP BY 1),
{name}_curve AS (
  SELECT *, sum(n) OVER (ORDER BY score DESC) AS flagged, sum(pos) OVER (ORDER BY score DESC) AS tp,
    sum(n - pos) OVER (ORDER BY score) - (n - pos) AS negatives_below
  FROM {name}_steps
),
{name}_areas AS (
  SELECT sum(pos / (SELECT sum(pos) FROM {name}_steps) * (tp / flagged)) AS average_precision,
    CAST(sum(pos * (2 * negatives_below + n - pos)) AS DOUBLE) / CAST(2 * sum(pos) * sum(n - pos) AS DOUBLE) AS roc_auc
  FROM {name}_curve
)"""


def _areas(name: str, label: str) -> str:
    return (
        f"SELECT {label} AS model, 'average_precision_pr_auc' AS metric, average_precision AS value FROM {name}_areas "
        f"UNION ALL SELECT {label}, 'roc_auc', roc_auc FROM {name}_areas"
    )


check("model_comparison", f"""
SELECT model, metric, round(value, 9) AS value FROM (
  {_areas("scorecard", "'scorecard'")} UNION ALL {_CAPTURES.format(model="'scorecard'", rows="test")}
  UNION ALL {_areas("stated", "'stated_regression'")}
  UNION ALL {_CAPTURES.format(model="'stated_regression'", rows="stated_test")}
)
""", f"""{FEATURES.strip()},
{SCORED.strip()},
stated_test AS (
  SELECT transaction_id, is_fraud AS label, round({STATED}, 12) AS score FROM features WHERE {TEST_ROWS}
),{_curve("scorecard", "test")},{_curve("stated", "stated_test")}""")


def _at_threshold(split: str) -> str:
    counts = f"""(SELECT threshold, count(*) AS rows, count(*) FILTER (WHERE label) AS fraud_rows,
    count(*) FILTER (WHERE score < threshold AND NOT label) AS tn, count(*) FILTER (WHERE score >= threshold AND NOT label) AS fp,
    count(*) FILTER (WHERE score < threshold AND label) AS fn, count(*) FILTER (WHERE score >= threshold AND label) AS tp
    FROM {split}, (SELECT threshold FROM sweep ORDER BY f1 DESC, threshold LIMIT 1) GROUP BY threshold)"""
    values = {
        "rows": "rows", "fraud_rows": "fraud_rows", "threshold": "threshold", "tn": "tn", "fp": "fp", "fn": "fn", "tp": "tp",
        "precision": "coalesce(tp / nullif(tp + fp, 0), 0)", "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
        "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
        "flag_rate": "coalesce((tp + fp) / nullif(tn + fp + fn + tp, 0), 0)",
    }
    rows = " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({v} AS DOUBLE) AS value FROM {counts}" for k, v in values.items())
    return (
        f"SELECT '{split}' AS split, metric, value FROM ({rows} UNION ALL SELECT metric, value FROM ({_areas(split, chr(39) * 2)}) "
        f"UNION ALL SELECT metric, value FROM ({_CAPTURES.format(model=chr(39) * 2, rows=split)}))"
    )


check("model_report", f"""
SELECT split, metric, round(value, 9) AS value FROM ({_at_threshold("validation")} UNION ALL {_at_threshold("test")})
""", f"""{SWEEP.strip()},{_curve("validation", "validation")},{_curve("test", "test")}""")
plain("dense_id_blocks", """
SELECT l_orderkey, min(line_id) AS first_id, max(line_id) AS last_id, count(DISTINCT line_id) AS ids, count(*) AS lines
FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) AS line_id FROM lineitem) GROUP BY 1
""")
plain("sub_cent_value", """
SELECT l_returnflag, CAST(sum(CAST(net AS DECIMAL(18,6))) AS DOUBLE) AS net_value,
  count(*) FILTER (WHERE abs(net - CAST(CAST(net AS DECIMAL(18,6)) AS DOUBLE)) > 1e-9 * greatest(1e0, abs(net))) AS rounded_rows,
  count(*) FILTER (WHERE abs(net - CAST(CAST(net AS DECIMAL(18,2)) AS DOUBLE)) > 1e-9 * greatest(1e0, abs(net)))
    AS rows_finer_than_cents
FROM (SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS net FROM lineitem) GROUP BY 1
""")

# --- summary reports -----------------------------------------------------------------------

check("portfolio_kpis", f"""
SELECT count(*) AS transaction_count, {VALUE} AS transaction_value_usd, {rate(APPROVED)} AS approval_rate,
  {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd, {rate("is_cross_border")} AS cross_border_rate
FROM fact_lineitem
""")
check("monthly_trend", """
SELECT month, transaction_value_usd, transaction_count, approval_rate, fraud_rate FROM kpi_view
""", MONTHLY)
check("channel_performance", f"""
SELECT channel, {VALUE} AS transaction_value_usd, count(*) AS transaction_count, {rate(APPROVED)} AS approval_rate
FROM fact_lineitem GROUP BY 1
""")
check("top_countries_by_value", f"""
SELECT f.country_id, country_name, {VALUE} AS transaction_value_usd, count(*) AS transaction_count
FROM fact_lineitem f LEFT JOIN dim_country c ON f.country_id = c.country_id
GROUP BY 1, 2 ORDER BY transaction_value_usd DESC, 1 LIMIT 10
""")
for _key in ("transaction_value_usd", "fraud_loss_usd"):
    check("top_merchants_by_" + ("value" if "value" in _key else "fraud_loss"), f"""
SELECT f.merchant_id, merchant_name, {VALUE} AS transaction_value_usd, {LOSS} AS fraud_loss_usd
FROM fact_lineitem f JOIN dim_merchant m ON f.merchant_id = m.merchant_id
GROUP BY 1, 2 ORDER BY {_key} DESC, 1 LIMIT 10
""")
check("merchant_segment_summary", """
SELECT merchant_priority_segment, merchants, transaction_value_usd, fraud_loss_usd,
  round(average_approval_rate, 9) AS average_approval_rate, weighted_approval_rate,
  round(merchants / sum(merchants) OVER (), 9) AS share_of_merchants,
  round(transaction_value_usd / sum(transaction_value_usd) OVER (), 9) AS share_of_value,
  round(fraud_loss_usd / sum(fraud_loss_usd) OVER (), 9) AS share_of_fraud_loss
FROM (
  SELECT merchant_priority_segment, count(*) AS merchants,
    CAST(sum(CAST(transaction_value_usd AS DECIMAL(18,6))) AS DOUBLE) AS transaction_value_usd,
    CAST(sum(CAST(fraud_loss_usd AS DECIMAL(18,6))) AS DOUBLE) AS fraud_loss_usd,
    avg(approval_rate) AS average_approval_rate,
    CAST(sum(approved) AS BIGINT) / CAST(sum(transaction_count) AS BIGINT) AS weighted_approval_rate
  FROM merchant_view JOIN approvals USING (merchant_id) GROUP BY 1
)
""", f"{MERCHANTS.strip()},\napprovals AS (SELECT merchant_id, count(*) FILTER (WHERE {APPROVED}) AS approved "
     "FROM fact_lineitem GROUP BY 1)")
check("merchant_detail", """
SELECT merchant_id, merchant_name, merchant_category, merchant_country, merchant_tier, merchant_risk_rating,
  merchant_priority_segment, transaction_count, transaction_value_usd, approval_rate, fraud_rate, fraud_loss_usd
FROM merchant_view
""", MERCHANTS)
EXPOSURE = f"""count(*) AS transaction_count, count(*) FILTER (WHERE is_fraud) AS fraud_transactions,
  {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd, {LOSS} / nullif({VALUE}, 0) AS fraud_loss_rate"""
check("fraud_by_risk", f"""
SELECT merchant_risk_rating, customer_risk_segment, {EXPOSURE} FROM risk_rows GROUP BY 1, 2
""", RISK)
check("fraud_domestic_vs_cross", """
SELECT merchant_risk_rating, customer_risk_segment, domestic_fraud_rate, cross_border_fraud_rate,
  cross_border_fraud_rate / nullif(domestic_fraud_rate, 0) AS cross_to_domestic_ratio
FROM (
  SELECT merchant_risk_rating, customer_risk_segment,
    count(*) FILTER (WHERE is_fraud AND NOT is_cross_border) / nullif(count(*) FILTER (WHERE NOT is_cross_border), 0)
      AS domestic_fraud_rate,
    count(*) FILTER (WHERE is_fraud AND is_cross_border) / nullif(count(*) FILTER (WHERE is_cross_border), 0)
      AS cross_border_fraud_rate
  FROM risk_rows GROUP BY 1, 2
)
""", RISK)
check("fraud_loss_by_merchant_risk", f"""
SELECT merchant_risk_rating, {LOSS} AS fraud_loss_usd FROM risk_rows GROUP BY 1
""", RISK)
check("fraud_by_channel", f"""
SELECT channel, {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd FROM risk_rows GROUP BY 1
""", RISK)
check("customer_segment_summary", """
SELECT behavioural_segment, count(*) AS customers, round(avg(cross_border_rate), 9) AS average_cross_border_rate,
  round(avg(fraud_rate), 9) AS average_fraud_rate,
  CAST(sum(crossed) AS BIGINT) / CAST(sum(transaction_count) AS BIGINT) AS weighted_cross_border_rate,
  CAST(sum(frauds) AS BIGINT) / CAST(sum(transaction_count) AS BIGINT) AS weighted_fraud_rate
FROM customer_view JOIN events_per_customer USING (customer_id) GROUP BY 1
""", f"{CUSTOMERS.strip()},\nevents_per_customer AS (SELECT customer_id, count(*) FILTER (WHERE is_cross_border) "
     "AS crossed, count(*) FILTER (WHERE is_fraud) AS frauds FROM fact_lineitem GROUP BY 1)")
check("fraud_concentration", f"""
SELECT merchant_risk_rating, customer_risk_segment, is_cross_border, {EXPOSURE},
  ({rate("is_fraud")}) / (SELECT {rate("is_fraud")} FROM risk_rows) AS multiple_of_portfolio_rate
FROM risk_rows GROUP BY 1, 2, 3
""", RISK)
check("velocity_band_summary", """
SELECT velocity_band, transaction_count, fraud_transactions, fraud_rate, fraud_loss_usd, transaction_value_usd,
  fraud_rate / (SELECT fraud_rate FROM bands WHERE velocity_band = 'Normal Velocity') AS ratio_to_normal,
  transaction_count / CAST(sum(transaction_count) OVER () AS BIGINT) AS share_of_transactions,
  fraud_transactions / CAST(sum(fraud_transactions) OVER () AS BIGINT) AS share_of_fraud,
  round(fraud_loss_usd / sum(fraud_loss_usd) OVER (), 9) AS share_of_fraud_loss,
  round(transaction_value_usd / sum(transaction_value_usd) OVER (), 9) AS share_of_value
FROM bands
""", f"""{VELOCITY.strip()},
bands AS (
  SELECT velocity_band, count(*) AS transaction_count, count(*) FILTER (WHERE is_fraud) AS fraud_transactions,
    {rate("is_fraud")} AS fraud_rate, {LOSS} AS fraud_loss_usd, {VALUE} AS transaction_value_usd
  FROM velocity_view GROUP BY 1
)""")
check("anomaly_summary", """
SELECT count(*) AS merchant_days, count(*) FILTER (WHERE anomaly_flag) AS flagged_days,
  count(*) FILTER (WHERE anomaly_flag) / count(*) AS alert_rate,
  count(DISTINCT merchant_id) FILTER (WHERE anomaly_flag) AS merchants_flagged,
  round(avg(abs(transaction_count_zscore)) FILTER (WHERE anomaly_flag), 6) AS mean_abs_count_zscore,
  round(avg(abs(transaction_value_zscore)) FILTER (WHERE anomaly_flag), 6) AS mean_abs_value_zscore,
  round(avg(approval_rate_zscore) FILTER (WHERE anomaly_flag), 6) AS mean_approval_zscore
FROM anomaly_view
""", ANOMALIES)
check("executive_summary", """
SELECT min(month) AS first_month, max(month) AS last_month,
  (arg_max(transaction_count, month) - arg_min(transaction_count, month)) / arg_min(transaction_count, month)
    AS volume_growth,
  (arg_max(transaction_value_usd, month) - arg_min(transaction_value_usd, month))
    / arg_min(transaction_value_usd, month) AS value_growth,
  min(approval_rate) AS min_approval_rate, max(approval_rate) AS max_approval_rate,
  max(approval_rate) - min(approval_rate) AS approval_rate_spread,
  min(fraud_rate) AS min_fraud_rate, max(fraud_rate) AS max_fraud_rate,
  max(fraud_rate) - min(fraud_rate) AS fraud_rate_spread,
  (SELECT month FROM kpi_view ORDER BY transaction_count DESC, month LIMIT 1) AS highest_volume_month,
  (SELECT month FROM kpi_view ORDER BY transaction_value_usd DESC, month LIMIT 1) AS highest_value_month,
  (SELECT month FROM kpi_view ORDER BY fraud_loss_usd, month LIMIT 1) AS lowest_fraud_loss_month
FROM kpi_view
""", MONTHLY)

# --- metric layer --------------------------------------------------------------------------

check("metric_catalogue", f"""
SELECT channel, count(*) AS transaction_volume, {VALUE} AS transaction_value,
  count(*) FILTER (WHERE {APPROVED}) AS approved_transactions,
  count(*) FILTER (WHERE {DECLINED}) AS declined_transactions, {rate(APPROVED)} AS approval_rate,
  {rate(DECLINED)} AS decline_rate, {APPROVED_VALUE} AS approved_payment_value,
  {AVG_VALUE} AS average_transaction_value, count(*) FILTER (WHERE is_fraud) AS fraud_transactions,
  {rate("is_fraud")} AS fraud_transaction_rate, {LOSS} AS fraud_loss,
  {LOSS} / nullif({APPROVED_VALUE}, 0) AS fraud_loss_rate,
  count(*) FILTER (WHERE is_cross_border) AS cross_border_transactions,
  {rate("is_cross_border")} AS cross_border_transaction_rate, avg(processing_time_ms) AS average_processing_time,
  count(DISTINCT customer_id) AS active_customers,
  count(*) / count(DISTINCT customer_id) AS transactions_per_customer,
  {VALUE} / count(DISTINCT customer_id) AS payment_value_per_customer,
  {APPROVED_VALUE} / count(DISTINCT customer_id) AS approved_value_per_customer,
  count(DISTINCT merchant_id) AS active_merchants,
  quantile_cont(processing_time_ms, 0.95) AS p95_processing_time
FROM fact_lineitem GROUP BY 1
""")
check("merchant_metrics", f"""
SELECT merchant_id, count(*) AS transaction_volume, {APPROVED_VALUE} AS approved_payment_value,
  {rate(APPROVED)} AS approval_rate, {rate("is_fraud")} AS fraud_transaction_rate
FROM fact_lineitem GROUP BY 1
""")
check("decline_reason_share", """
SELECT channel, decline_reason, n AS decline_reason_count,
  n / CAST(sum(n) OVER (PARTITION BY channel) AS BIGINT) AS decline_reason_share
FROM (SELECT channel, decline_reason, count(*) AS n FROM fact_lineitem
  WHERE transaction_status = 'declined' GROUP BY 1, 2)
""")
