"""Splits, preparation and the two models on a small learnable table."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from paygrain.operators import evaluation, modeling
from paygrain.sources import sinks

CATEGORIES = modeling.CATEGORICAL_FEATURES


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        amount = rng.uniform(1, 1000)
        risky = rng.choice(["Low", "Low", "High"])
        row = {
            "transaction_id": i, "transaction_date": date(2025, 9, 1) + timedelta(days=i // 5),
            "transaction_hour": i % 24, "day_of_week_num": i % 7 + 1, "transaction_month": 9 + i // 150,
            "transaction_amount_usd": None if i % 50 == 0 else amount, "processing_time_ms": 100 + i,
            "account_tenure_months": i % 60, "is_cross_border": i % 2 == 0,
            "is_fraud": rng.random() < (0.6 if risky == "High" and amount > 400 else 0.05),
            **{c: f"{c}{i % 3}" for c in CATEGORIES if c != "is_cross_border"},
        }
        row["customer_risk_segment"] = None if i % 70 == 0 else risky
        rows.append(row)
    names = ["transaction_id", "transaction_date", *modeling.FEATURES, "is_fraud"]
    kinds = {"transaction_date": "date", "transaction_amount_usd": "double", "is_cross_border": "boolean", "is_fraud": "boolean"}
    kinds |= {c: "string" for c in CATEGORIES if c != "is_cross_border"}
    ddl = ", ".join(f"{n} {kinds.get(n, 'bigint')}" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl).cache()


@pytest.fixture(scope="module")
def linear(features):
    return modeling.fit_lr(modeling.read_split(features, "train", modulus=None), max_iter=30)


def test_splits_follow_the_dates(features):
    split = modeling.chronological_split(features)
    bounds = {r["split"]: r for r in split.groupBy("split").agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")).collect()}
    assert bounds["train"].b == date(2025, 10, 31)
    assert (bounds["validation"].a, bounds["validation"].b) == (date(2025, 11, 1), date(2025, 11, 30))
    assert bounds["test"].a == date(2025, 12, 1)
    summary = {r["split"]: r["rows"] for r in modeling.split_summary(split).collect()}
    assert sum(summary.values()) == 600
    for name in ("validation", "test"):
        assert modeling.read_split(features, name).count() == summary[name]
    with pytest.raises(ValueError, match="Unknown split"):
        modeling.read_split(features, "holdout")


@pytest.mark.parametrize("modulus", [1, 2, 4, 16, 5])
def test_hash_sample_is_stable_and_about_right(spark, modulus):
    ids = spark.range(4000).withColumnRenamed("id", "transaction_id")
    first = {r[0] for r in modeling.hash_sample(ids, modulus=modulus).collect()}
    again = {r[0] for r in modeling.hash_sample(ids.repartition(9), modulus=modulus).collect()}
    assert first == again and abs(len(first) - 4000 / modulus) < 200


def test_leakage_guard():
    modeling.assert_no_leakage(modeling.FEATURES)
    with pytest.raises(modeling.LeakageError, match="decline_reason"):
        modeling.assert_no_leakage(["channel", "decline_reason"])


def test_mode_prefers_the_smallest_among_equals(spark):
    rows = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    assert modeling.most_frequent(rows, ["x", "y"]) == {"x": "a"}


def test_balanced_weights(features):
    weighted = modeling.balanced_weights(features).groupBy("is_fraud").agg(F.sum("weight").alias("w")).collect()
    assert [r.w for r in weighted] == [pytest.approx(300.0)] * 2
    with pytest.raises(ValueError, match="both classes"):
        modeling.balanced_weights(features.where("is_fraud"))


def test_linear_model_learns_and_survives_a_reload(features, linear, spark, tmp_path):
    test = modeling.read_split(features, "test")
    scored = modeling.score(linear, test)
    assert scored.columns == ["transaction_id", "label", "score"] and scored.count() == test.count()
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert evaluation.roc_auc(scored).first()[0] > 0.6
    sinks.save_model(linear, str(tmp_path / "model"))
    again = modeling.score(sinks.load_model(str(tmp_path / "model")), test)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))


def test_unknown_and_missing_categories_are_scored(features, linear):
    odd = modeling.read_split(features, "test").withColumns({"channel": F.lit("telepathy"), "merchant_tier": F.lit(None).cast("string")})
    assert modeling.score(linear, odd).where("score IS NULL").count() == 0


def test_coefficients(features, linear, spark):
    table = modeling.lr_coefficients(linear, spark)
    rows = table.collect()
    levels = sum(
        features.where("transaction_date < '2025-11-01'").select(c).na.drop().distinct().count() for c in CATEGORIES
    )
    assert len(rows) == len(modeling.NUMERIC_FEATURES) + levels
    by_name = {r.feature: r for r in rows}
    assert by_name["customer_risk_segment_High"].coefficient > by_name["customer_risk_segment_Low"].coefficient
    assert [r.absolute_coefficient for r in rows] == sorted((r.absolute_coefficient for r in rows), reverse=True)
    top = modeling.top_coefficients(table, 3).collect()
    assert [r.side for r in top].count("positive") == 3 and len(top) == 6
    assert top[0].coefficient == max(r.coefficient for r in rows)


def test_boosted_model_learns_and_reloads(features, spark, tmp_path):
    model = modeling.fit_gbt(modeling.read_split(features, "train", modulus=None), max_iter=6, max_leaves=6)
    test = modeling.read_split(features, "test").withColumn("channel", F.when(F.col("transaction_id") % 2 == 0, "telepathy"))
    scored = modeling.score(model, test)
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert evaluation.roc_auc(scored).first()[0] > 0.55
    model.save(spark, str(tmp_path / "trees"))
    again = modeling.FraudTrees.load(spark, str(tmp_path / "trees"))
    assert again == model
    assert sorted(map(tuple, modeling.score(again, test).collect())) == sorted(map(tuple, scored.collect()))


def test_nulls_are_filled_with_exact_medians(features, linear):
    train = modeling.read_split(features, "train", modulus=None)
    known = sorted(r[0] for r in train.select("transaction_amount_usd").na.drop().collect())
    middle = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    odd = modeling.model_columns(train.where("transaction_amount_usd IS NULL"))
    assert {r[0] for r in linear.transform(odd).select("transaction_amount_usd_filled").collect()} == {middle}


def test_stated_scores(features):
    rows = modeling.read_split(features, "test")
    found = modeling.stated_score(rows, 0.5, [("transaction_hour", 0.1), ("channel_web", -1.0)])
    joined = found.join(rows.select("transaction_id", "transaction_hour", "channel"), "transaction_id").collect()
    for r in joined:
        z = 0.5 + 0.1 * r.transaction_hour - (r.channel == "web")
        assert r.score == pytest.approx(1 / (1 + 2.718281828459045**-z))
    with pytest.raises(ValueError, match="Unknown"):
        modeling.stated_score(rows, 0.0, [("nothing_x", 1.0)])
