"""Named queries: each takes (spark, directory) and reads whole tables.

Doubles that depend on the order of additions (averages of rates, deviations) are rounded here,
for comparison only; the library functions return them as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.functions import dates, metrics
from paygrain.functions.dates import transaction_date, transaction_month
from paygrain.functions.fingerprint import with_fingerprint
from paygrain.functions.measures import measure, member_words, members_counted, merged_words
from paygrain.functions.money import dollars, finer_than_money, money_sums
from paygrain.operators import enrich, evaluation, modeling, ordering, part_state, quality
from paygrain.plans import reports, views
from paygrain.session import materialise, stored
from paygrain.sources import fixtures, tables
from paygrain.sources.fixtures import Star

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register ``build`` under its own name."""
    REGISTRY[build.__name__] = lambda spark, directory: build(Star(spark, directory))
    return build


def rounded(table: DataFrame, digits: int, *columns: str) -> DataFrame:
    return table.withColumns({c: F.round(c, digits) for c in columns})


# --- report views --------------------------------------------------------------------------


@query
def payment_performance_daily(s: Star) -> DataFrame:
    return views.payment_performance_daily(s.lineitem, s.country)


@query
def decline_analysis_monthly(s: Star) -> DataFrame:
    return views.decline_analysis_monthly(s.lineitem, s.country)


@query
def merchant_intelligence(s: Star) -> DataFrame:
    return views.merchant_intelligence(s.lineitem, s.merchant)


@query
def customer_analytics(s: Star) -> DataFrame:
    return views.customer_analytics(s.lineitem, s.customer)


@query
def fraud_risk_segments(s: Star) -> DataFrame:
    return views.fraud_risk_segments(s.lineitem, s.merchant, s.customer)


@query
def transaction_velocity(s: Star) -> DataFrame:
    return views.transaction_velocity(s.with_currency(s.events))


ANOMALY_DOUBLES = [
    "baseline_transaction_count_sd", "baseline_transaction_value_sd", "baseline_approval_rate",
    "baseline_approval_rate_sd", "transaction_count_zscore", "transaction_value_zscore", "approval_rate_zscore",
]


@query
def merchant_daily_anomalies(s: Star) -> DataFrame:
    return rounded(views.merchant_daily_anomalies(s.events), 6, *ANOMALY_DOUBLES)


@query
def merchant_daily_anomalies_confirmed(s: Star) -> DataFrame:
    """Only days with two signals and a material value are flagged."""
    confirmed = views.merchant_daily_anomalies(s.events, z=2.0, min_signals=2, min_value=500.0)
    return confirmed.select("merchant_id", "transaction_date", "transaction_value_usd", "anomaly_flag")


@query
def executive_kpis_monthly(s: Star) -> DataFrame:
    return views.executive_kpis_monthly(s.lineitem)


def features(s: Star) -> DataFrame:
    return views.fraud_model_features(s.events, s.customer, s.merchant, s.device, s.country)


def stored_features(s: Star) -> DataFrame:
    """For fits, whose jobs would each join all dimensions again."""
    return stored(features(s))


@query
def fraud_model_features(s: Star) -> DataFrame:
    return features(s)


# --- sources and data quality --------------------------------------------------------------


def star_tables(s: Star, fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_transactions": fact, "dim_customer": s.customer, "dim_merchant": s.merchant,
        "dim_device": s.device, "dim_country": s.country, "dim_date": calendar(s, fact),
    }


def calendar(s: Star, fact: DataFrame) -> DataFrame:
    day = transaction_date(fact)
    # One row, computed once: several checks read the calendar, and the fact comes from joins.
    bounds = materialise(fact.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))
    return enrich.season_weights(enrich.calendar_between(bounds))


@query
def row_counts(s: Star) -> DataFrame:
    return tables.row_counts(star_tables(s, s.lineitem))


@query
def table_manifest(s: Star) -> DataFrame:
    return tables.manifest(star_tables(s, s.with_currency(s.events)))


@query
def part_manifest(s: Star) -> DataFrame:
    return tables.part_manifest(s.raw("events").withColumnRenamed("event_id", "transaction_id"))


@query
def sub_cent_value(s: Star) -> DataFrame:
    """Sums of amounts with four decimals, and how many rows an exact sum would round."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    summed = s.raw("lineitem").groupBy("l_returnflag").agg(
        *(total.alias(name) for name, total in money_sums(net, "net").items()),
        F.count_if(finer_than_money(net)).alias("rounded_rows"),
        F.count_if(finer_than_money(net, 2)).alias("rows_finer_than_cents"),
    )
    return summed.select("l_returnflag", dollars("net").alias("net_value"), "rounded_rows", "rows_finer_than_cents")


@query
def active_members_quarterly(s: Star) -> DataFrame:
    """Distinct customers and merchants per quarter, from the bitmaps of the months."""
    fact = s.lineitem.select("customer_id", "merchant_id", transaction_month(s.lineitem))
    members = {"active_customers": "customer_id", "active_merchants": "merchant_id"}
    months = member_words(fact, ["month"], members)
    quarter = F.trunc("month", "quarter").alias("quarter")
    return members_counted(merged_words(months, quarter), ["quarter"], list(members))


@query
def core_kpis(s: Star) -> DataFrame:
    return quality.core_kpis(s.lineitem)


@query
def summary_metrics(s: Star) -> DataFrame:
    return quality.summary_metrics(s.events)


@query
def dq_business_rules(s: Star) -> DataFrame:
    return quality.business_rules(s.lineitem)


@query
def dq_referential_integrity(s: Star) -> DataFrame:
    """Customers of one segment are left out, so that there are orphans to find."""
    known = star_tables(s, s.lineitem)
    known["dim_customer"] = s.customer.where("customer_segment <> 'MACHINERY'")
    return quality.referential_integrity(s.lineitem, known)


@query
def dq_row_rules(s: Star) -> DataFrame:
    return quality.row_rule_checks(s.with_currency(s.lineitem))


@query
def dq_dimensions(s: Star) -> DataFrame:
    dimensions = {name: t for name, t in star_tables(s, s.events).items() if name != "fact_transactions"}
    return quality.dimension_checks(dimensions, {"dim_country": 25})


@query
def dq_part_keys(s: Star) -> DataFrame:
    return quality.part_key_checks(tables.with_part(s.raw("lineitem")), "l_orderkey")


@query
def dq_parts(s: Star) -> DataFrame:
    """Part names derived from the rows: later parts overlap earlier ones and repeat ids."""
    lines = s.raw("lineitem")
    last = lines.agg(F.max("l_orderkey")).scalar()
    number = F.floor(F.col("l_orderkey") * 5 / (1 + last)) + F.floor(F.col("l_linenumber") / 7)
    return quality.part_key_checks(lines.withColumn("part", F.concat(F.lit("part-"), number.cast("string"))), "l_orderkey")


@query
def dq_part_report(s: Star) -> DataFrame:
    """The report from summaries that were made at two times; some ids lie outside their part's range.

    Customers of one segment are left out, so that there are orphans to find.
    """
    fact = stored(s.with_currency(s.lineitem))
    known = star_tables(s, fact)
    known["dim_customer"] = s.customer.where("customer_segment <> 'MACHINERY'")
    last = fact.agg(F.max("transaction_id")).scalar()
    stray = F.when(F.col("transaction_id") % 97 == 0, 1).otherwise(0)
    number = F.floor(F.col("transaction_id") * 5 / (1 + last)) + stray
    parted = fact.withColumn("part", F.concat(F.lit("part-"), number.cast("string")))
    earlier, later = (part_state.part_summaries(parted.where(c), known) for c in ("part < 'part-3'", "part >= 'part-3'"))
    return part_state.report(earlier.unionByName(later), known, 5_000_000)


@query
def dq_calendar_gaps(s: Star) -> DataFrame:
    """A calendar without June."""
    return quality.date_coverage_check(s.lineitem, calendar(s, s.lineitem).where(F.month("date") != 6))


@query
def dq_wrong_flags(s: Star) -> DataFrame:
    """Every tenth payment has the wrong flag."""
    wrong = F.when(F.col("transaction_id") % 10 == 3, ~F.col("is_cross_border")).otherwise(F.col("is_cross_border"))
    return quality.cross_border_check(s.lineitem.withColumn("is_cross_border", wrong), s.merchant, s.customer)


def lineitem_quality(s: Star) -> DataFrame:
    fact = stored(s.with_currency(s.lineitem))
    known = star_tables(s, fact)
    known.pop("fact_transactions")
    return quality.quality_report(fact, known, {"dim_country": 25, "fact_transactions": 5_000_000})


@query
def dq_report(s: Star) -> DataFrame:
    return lineitem_quality(s)


@query
def dq_gate(s: Star) -> DataFrame:
    return quality.gate(lineitem_quality(s))


@query
def kpi_reconciliation(s: Star) -> DataFrame:
    """The reconciliation figures of the two facts against each other."""
    return quality.reconcile(quality.core_kpis(s.lineitem), quality.core_kpis(s.events))


# --- enrichment ----------------------------------------------------------------------------


@query
def calendar_dim(s: Star) -> DataFrame:
    return rounded(calendar(s, s.lineitem), 12, "transaction_weight")


@query
def season_weights(s: Star) -> DataFrame:
    weighted = calendar(s, s.lineitem).groupBy("year", "month").agg(F.sum("transaction_weight").alias("weight"))
    return rounded(weighted, 12, "weight")


@query
def market_share(s: Star) -> DataFrame:
    value = measure(s.lineitem, "country_id").select("country_id", dollars("value").alias("value_usd"))
    return rounded(enrich.market_share(value, "value_usd"), 12, "market_weight")


@query
def customer_tenure(s: Star) -> DataFrame:
    """Months between each order's date and a fixed reference date."""
    orders = s.raw("orders")
    months = enrich.customer_tenure(F.to_date("o_orderdate"), F.lit("2002-12-31").cast("date"))
    return orders.select("o_orderkey", months.alias("account_tenure_months"))


@query
def merchant_risk_rating(s: Star) -> DataFrame:
    """The part size stands in for the country's risk multiplier."""
    rating = enrich.merchant_risk_rating(
        F.col("p_type"), F.lit(0.8) + F.col("p_size") / 50.0, category_factor=fixtures.CATEGORY_FRAUD_FACTOR
    )
    return s.raw("part").select("p_partkey", rating.alias("merchant_risk_rating"))


@query
def merchant_tier(s: Star) -> DataFrame:
    return s.merchant.select("merchant_id", enrich.merchant_tier(F.col("merchant_size")).alias("merchant_tier"))


@query
def surrogate_keys(s: Star) -> DataFrame:
    return s.raw("customer").select("c_custkey", enrich.surrogate_key(F.col("c_custkey"), "C", 7).alias("customer_id"))


@query
def fx_convert(s: Star) -> DataFrame:
    converted = enrich.fx_convert(s.with_currency(s.lineitem), enrich.usd_rates(s.spark))
    return converted.select("transaction_id", "currency", "transaction_amount_usd", "transaction_amount")


@query
def fx_missing(s: Star) -> DataFrame:
    """A rate table without the rand and the dirham."""
    rates = enrich.usd_rates(s.spark).where("currency NOT IN ('ZAR', 'AED')")
    return enrich.fx_missing(s.with_currency(s.lineitem), rates)


@query
def cross_border_flag(s: Star) -> DataFrame:
    merchants = s.merchant.select("merchant_id", "merchant_country")
    customers = s.customer.select("customer_id", "home_country")
    flag = enrich.cross_border_flag(F.col("merchant_country"), F.col("home_country"))
    return (
        s.events.join(merchants, "merchant_id").join(customers, "customer_id")
        .select("transaction_id", flag.alias("is_cross_border"))
    )


def expectations(s: Star) -> DataFrame:
    return enrich.with_expectations(
        s.events, s.customer, s.merchant, fixtures.CATEGORY_FRAUD_FACTOR,
        fixtures.CATEGORY_APPROVAL_DELTA, fixtures.SEGMENT_CROSS_BORDER_RATE,
    )


@query
def fraud_scorecard(s: Star) -> DataFrame:
    return expectations(s).select("transaction_id", "expected_fraud")


@query
def approval_scorecard(s: Star) -> DataFrame:
    return rounded(expectations(s).select("transaction_id", "expected_approval"), 9, "expected_approval")


@query
def cross_border_propensity(s: Star) -> DataFrame:
    return expectations(s).select("transaction_id", "expected_cross_border")


@query
def expected_processing_time(s: Star) -> DataFrame:
    return expectations(s).select("transaction_id", "expected_processing_ms")


@query
def fraud_loss(s: Star) -> DataFrame:
    """The line discount gives the fraction lost."""
    c = F.col
    lines = s.raw("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "1.0 - l_discount AS loss_fraction",
        "l_linestatus = 'F' AND l_quantity >= 49 AS is_fraud",
        "CASE WHEN l_returnflag = 'R' THEN 'declined' ELSE 'approved' END AS status",
    )
    loss = enrich.fraud_loss(c("l_extendedprice"), c("loss_fraction"), c("is_fraud"), c("status"))
    return lines.select("l_orderkey", "l_linenumber", loss.alias("fraud_loss_amount_usd"))


@query
def event_time(s: Star) -> DataFrame:
    """Payment times put together again from their date, hour, minute and second."""
    stamp = F.col("ts")
    rebuilt = dates.event_time(F.to_date(stamp), F.hour(stamp), F.minute(stamp), F.second(stamp))
    return s.raw("events").select("event_id", rebuilt.alias("event_time"))


@query
def dense_ids(s: Star) -> DataFrame:
    lines = s.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return ordering.dense_ids(lines, order, start=1001, name="transaction_id")


@query
def dense_id_blocks(s: Star) -> DataFrame:
    """Ids over a key that repeats: each key has a block of its own without gaps."""
    lines = s.raw("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    ids = ordering.dense_ids(lines, [F.col("l_orderkey")], start=1, name="line_id")
    # Ids are bits of 64-bit words: neighbours share a row of a task's memory, equal ones a bit.
    bit = F.expr("shiftleft(1L, CAST(pmod(line_id, 64) AS INT))")
    words = ids.groupBy("l_orderkey", F.shiftright("line_id", 6).alias("word")).agg(
        F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"),
    )
    return words.groupBy("l_orderkey").agg(
        F.min("low").alias("first_id"), F.max("high").alias("last_id"),
        F.sum(F.bit_count("bits")).alias("ids"), F.sum("n").alias("lines"),
    )


CALIBRATION_DOUBLES = [
    "expected_fraud_rate", "expected_approval_rate", "expected_cross_border_rate", "expected_processing_time_ms",
]


@query
def score_calibration(s: Star) -> DataFrame:
    calibrated = enrich.score_calibration(expectations(s), ["channel", "risk_segment"])
    return rounded(calibrated, 9, *CALIBRATION_DOUBLES)


# --- model preparation and evaluation ------------------------------------------------------

SPLIT_DATES = (fixtures.VALIDATION_FROM, fixtures.TEST_FROM)


@query
def chronological_split(s: Star) -> DataFrame:
    return modeling.chronological_split(features(s), *SPLIT_DATES).select("transaction_id", "split")


@query
def hash_sample(s: Star) -> DataFrame:
    return modeling.read_split(features(s), "train", *SPLIT_DATES).select("transaction_id")


@query
def id_fingerprints(s: Star) -> DataFrame:
    """Fingerprints of names of 1 to 32 bytes made from all order lines."""
    sign = F.expr("repeat('#', CAST(l_linenumber * l_linenumber DIV 2 AS INT))")
    named = s.raw("lineitem").select("l_orderkey", "l_linenumber", F.concat(sign, F.col("l_orderkey").cast("string")).alias("name"))
    return with_fingerprint(named, "name", "fingerprint").drop("name")


@query
def split_summary(s: Star) -> DataFrame:
    return modeling.split_summary(modeling.chronological_split(features(s), *SPLIT_DATES))


def stand_in_scores(s: Star) -> DataFrame:
    """The scorecard's expected fraud, relative to its upper bound, as the score of a payment."""
    day = transaction_date(s.events)
    return expectations(s).select(
        "transaction_id", F.col("is_fraud").alias("label"),
        (F.col("expected_fraud") / F.lit(0.08)).alias("score"), day,
    )


def scored(s: Star, split: str) -> DataFrame:
    rows = stand_in_scores(s)
    day, first, second = F.col("transaction_date"), *(F.lit(d).cast("date") for d in SPLIT_DATES)
    kept = {"validation": (day >= first) & (day < second), "test": day >= second}[split]
    return rows.where(kept).drop("transaction_date")


@query
def threshold_sweep(s: Star) -> DataFrame:
    return evaluation.threshold_sweep(scored(s, "validation"))


@query
def best_threshold(s: Star) -> DataFrame:
    return evaluation.best_threshold(evaluation.threshold_sweep(scored(s, "validation")))


@query
def capture_at_top(s: Star) -> DataFrame:
    return evaluation.capture_at_top(scored(s, "test"))


@query
def confusion_metrics(s: Star) -> DataFrame:
    return evaluation.confusion_metrics(scored(s, "test"), 0.3)


@query
def capacity_threshold(s: Star) -> DataFrame:
    return evaluation.capacity_threshold(scored(s, "validation"))


@query
def operating_points(s: Star) -> DataFrame:
    chosen = [(row["capacity"], row["threshold"])
              for row in evaluation.capacity_threshold(scored(s, "validation")).collect()]
    return evaluation.operating_points(scored(s, "test"), chosen)


@query
def average_precision(s: Star) -> DataFrame:
    return rounded(evaluation.average_precision(scored(s, "test")), 9, "average_precision")


@query
def roc_auc(s: Star) -> DataFrame:
    return evaluation.roc_auc(scored(s, "test"))


@query
def evaluation_metrics(s: Star) -> DataFrame:
    return rounded(evaluation.evaluate(scored(s, "test"), 0.3), 9, "value")


def train(view: DataFrame) -> DataFrame:
    return modeling.read_split(view, "train", *SPLIT_DATES, modulus=None)


def test_split(view: DataFrame) -> DataFrame:
    return modeling.read_split(view, "test", *SPLIT_DATES)


def fitted_on(view: DataFrame, model, scored_rows: DataFrame) -> DataFrame:
    """Scored rows with what has to hold for each score and for the fit itself.

    A fit passes if it ranks the validation split, which it has not seen, better than chance.
    """
    seen = modeling.score(model, modeling.read_split(view, "validation", *SPLIT_DATES))
    unseen = evaluation.roc_auc(seen).first()[0]
    return scored_rows.select(
        "transaction_id", "label", F.col("score").between(0, 1).alias("score_in_range"),
        F.lit(unseen > 0.5).alias("better_than_chance"),
    )


@query
def fraud_lr(s: Star) -> DataFrame:
    """Besides, the weighted residuals of the regression add up to nothing: its intercept is free."""
    view = stored_features(s)
    rows = train(view)
    model = modeling.fit_lr(rows)
    residual = modeling.balanced_weights(modeling.model_columns(rows)).select("transaction_id", "weight").join(
        modeling.score(model, rows), "transaction_id"
    ).agg(F.sum(F.col("weight") * (F.col("score") - F.col("label").cast("double"))) / F.sum("weight")).first()[0]
    checked = fitted_on(view, model, modeling.score(model, test_split(view)))
    return checked.withColumn("gradient_near_zero", F.lit(abs(residual) < 1e-3))


@query
def fraud_gbt(s: Star) -> DataFrame:
    """Besides, the number of rounds that the held-out rows chose is inside its limits."""
    view = stored_features(s)
    model = modeling.fit_gbt(train(view))
    checked = fitted_on(view, model, modeling.score(model, test_split(view)))
    return checked.withColumn("rounds_in_range", F.lit(1 <= len(model.trees.trees) <= 250))


def stated(s: Star, split: str) -> DataFrame:
    rows = modeling.read_split(features(s), split, *SPLIT_DATES)
    return modeling.stated_score(rows, fixtures.STATED_INTERCEPT, fixtures.STATED_COEFFICIENTS)


@query
def score(s: Star) -> DataFrame:
    """The stated regression applied to the validation split."""
    return rounded(stated(s, "validation"), 12, "score")


def stated_table(s: Star) -> DataFrame:
    """The stated coefficients, with the payments that have each level."""
    table = rounded(modeling.coefficient_table(s.spark, fixtures.STATED_COEFFICIENTS), 12, "exp_coefficient")
    levels = modeling.level_counts(features(s), modeling.CATEGORICAL_FEATURES)
    applies = levels.select(F.concat_ws("_", "feature", "level").alias("feature"), F.col("n").alias("payments"))
    return table.join(applies, "feature", "left")


@query
def lr_coefficients(s: Star) -> DataFrame:
    return stated_table(s)


@query
def lr_coefficients_fitted(s: Star) -> DataFrame:
    """The coefficients of a regression fitted here: names, order, and the columns made from them."""
    table = modeling.lr_coefficients(modeling.fit_lr(train(stored_features(s)), max_iter=50), s.spark)
    strength = [r.absolute_coefficient for r in table.collect()]
    return table.select(
        "feature", F.lit(strength == sorted(strength, reverse=True)).alias("strongest_first"),
        (F.abs(F.log("exp_coefficient") - F.col("coefficient")) < 1e-9).alias("exp_agrees"),
        (F.greatest(F.col("coefficient"), -F.col("coefficient")) == F.col("absolute_coefficient")).alias("absolute_agrees"),
    )


@query
def top_coefficients(s: Star) -> DataFrame:
    """Strongest stated coefficients of each sign among levels that occur."""
    return modeling.top_coefficients(stated_table(s).where("payments IS NOT NULL"), 3)


@query
def model_comparison(s: Star) -> DataFrame:
    """The stated regression against the scorecard, on the test split."""
    compared = evaluation.model_comparison(
        {"stated_regression": rounded(stated(s, "test"), 12, "score"), "scorecard": scored(s, "test")}
    )
    return rounded(compared, 9, "value")


@query
def model_report(s: Star) -> DataFrame:
    """Threshold from validation; both splits evaluated at it."""
    return rounded(evaluation.model_report(scored(s, "validation"), scored(s, "test")), 9, "value")


# --- summary reports -----------------------------------------------------------------------


def risk(s: Star) -> DataFrame:
    return views.risk_measures(s.lineitem, s.merchant, s.customer)


@query
def portfolio_kpis(s: Star) -> DataFrame:
    return reports.portfolio_kpis(s.lineitem)


@query
def monthly_trend(s: Star) -> DataFrame:
    return reports.monthly_trend(views.executive_kpis_monthly(s.lineitem))


@query
def channel_performance(s: Star) -> DataFrame:
    return reports.channel_performance(s.lineitem)


@query
def top_countries_by_value(s: Star) -> DataFrame:
    return reports.top_countries_by_value(s.lineitem, s.country)


@query
def top_merchants_by_value(s: Star) -> DataFrame:
    return reports.top_merchants_by_value(s.lineitem, s.merchant)


@query
def top_merchants_by_fraud_loss(s: Star) -> DataFrame:
    return reports.top_merchants_by_fraud_loss(s.lineitem, s.merchant)


@query
def merchant_segment_summary(s: Star) -> DataFrame:
    summary = reports.merchant_segment_summary(views.merchant_intelligence(s.lineitem, s.merchant))
    return rounded(
        summary, 9, "average_approval_rate", "share_of_merchants", "share_of_value", "share_of_fraud_loss"
    )


@query
def merchant_detail(s: Star) -> DataFrame:
    return reports.merchant_detail(views.merchant_intelligence(s.lineitem, s.merchant))


@query
def fraud_by_risk(s: Star) -> DataFrame:
    return reports.fraud_by_risk(risk(s))


@query
def fraud_domestic_vs_cross(s: Star) -> DataFrame:
    return reports.fraud_domestic_vs_cross(risk(s))


@query
def fraud_loss_by_merchant_risk(s: Star) -> DataFrame:
    return reports.fraud_loss_by_merchant_risk(risk(s))


@query
def fraud_by_channel(s: Star) -> DataFrame:
    return reports.fraud_by_channel(risk(s))


@query
def customer_segment_summary(s: Star) -> DataFrame:
    summary = reports.customer_segment_summary(views.customer_analytics(s.lineitem, s.customer))
    return rounded(summary, 9, "average_cross_border_rate", "average_fraud_rate")


@query
def fraud_concentration(s: Star) -> DataFrame:
    return reports.fraud_concentration(risk(s))


@query
def velocity_band_summary(s: Star) -> DataFrame:
    summary = reports.velocity_band_summary(views.transaction_velocity(s.events))
    return rounded(summary, 9, "share_of_fraud_loss", "share_of_value")


@query
def anomaly_summary(s: Star) -> DataFrame:
    summary = reports.anomaly_summary(views.merchant_daily_anomalies(s.events))
    return rounded(summary, 6, "mean_abs_count_zscore", "mean_abs_value_zscore", "mean_approval_zscore")


@query
def executive_summary(s: Star) -> DataFrame:
    return reports.executive_summary(views.executive_kpis_monthly(s.lineitem))


# --- metric layer --------------------------------------------------------------------------


@query
def metric_catalogue(s: Star) -> DataFrame:
    return metrics.metric_catalogue(s.lineitem, ["channel"])


@query
def merchant_metrics(s: Star) -> DataFrame:
    return metrics.merchant_metrics(s.lineitem)


@query
def decline_reason_share(s: Star) -> DataFrame:
    return metrics.decline_reason_share(s.lineitem, ["channel"])
