"""Feature preparation and the two fraud models: a Spark ML pipeline and leaf-wise boosted trees."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.functions.fingerprint import with_fingerprint
from paygrain.functions.money import ratio
from paygrain.operators import boosting
from paygrain.operators.boosting import BoostedTrees, Settings
from paygrain.operators.ordering import union_all
from paygrain.operators.quantiles import exact_medians

# Feature names and split dates must equal the published ones for results to agree.
NUMERIC_FEATURES = [
    "transaction_hour", "day_of_week_num", "transaction_month", "transaction_amount_usd",
    "processing_time_ms", "account_tenure_months",
]
CATEGORICAL_FEATURES = [
    "payment_method", "channel", "is_cross_border", "customer_segment", "customer_risk_segment",
    "merchant_category", "merchant_size", "merchant_tier", "merchant_risk_rating", "device_type",
    "operating_system", "transaction_region",
]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
LABEL = "is_fraud"
# Identifiers and fields known only after the outcome.
LEAKING = [
    "transaction_id", "transaction_status", "decline_reason", "fraud_loss_amount_usd",
    "customer_id", "merchant_id", "device_id", LABEL,
]
SAMPLE_MODULUS = 4
VALIDATION_FROM, TEST_FROM = "2025-11-01", "2025-12-01"
SEED = 11


class LeakageError(ValueError):
    pass


def assert_no_leakage(features: list[str]) -> None:
    leaking = sorted(set(features) & set(LEAKING))
    if leaking:
        raise LeakageError(f"Not allowed as features: {leaking}")


# --- splits --------------------------------------------------------------------------------


def _day(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def chronological_split(
    features: DataFrame, validation_from: str | date = VALIDATION_FROM, test_from: str | date = TEST_FROM
) -> DataFrame:
    """Add a ``split`` column: train before, validation between, test from the second date."""
    day = F.col("transaction_date")
    split = F.when(day < _day(validation_from), "train").when(day < _day(test_from), "validation").when(
        day >= _day(test_from), "test"
    )
    return features.withColumn("split", split)


def hash_sample(rows: DataFrame, key: str = "transaction_id", modulus: int = SAMPLE_MODULUS) -> DataFrame:
    """A fixed 1-in-``modulus`` choice: ids whose public 64-bit fingerprint is divisible by it."""
    name = "fingerprint"
    while name in rows.columns:
        name += "_"
    return with_fingerprint(rows, key, name).where(F.col(name) % modulus == 0).drop(name)


def read_split(
    features: DataFrame,
    split: str,
    validation_from: str | date = VALIDATION_FROM,
    test_from: str | date = TEST_FROM,
    modulus: int | None = SAMPLE_MODULUS,
) -> DataFrame:
    """The model columns of one split; the training split is the hash sample unless
    ``modulus`` is None. The date filter is on the view's date, so it reaches the scan."""
    day = F.col("transaction_date")
    if split == "train":
        rows = features.where(day < _day(validation_from))
        if modulus is not None:
            rows = hash_sample(rows, modulus=modulus)
    elif split == "validation":
        rows = features.where((day >= _day(validation_from)) & (day < _day(test_from)))
    elif split == "test":
        rows = features.where(day >= _day(test_from))
    else:
        raise ValueError(f"Unknown split: {split}")
    return rows.select("transaction_id", *FEATURES, LABEL)


def split_summary(split_rows: DataFrame) -> DataFrame:
    return split_rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(LABEL)).alias("fraud"),
        ratio(F.count_if(F.col(LABEL)), F.count(F.lit(1))).alias("fraud_rate"),
    )


# --- preparation ---------------------------------------------------------------------------


def level_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, level, n): how often each non-null value of each categorical column occurs."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns]
    levels = rows.select(F.inline(F.array(*pairs))).where(F.col("level").isNotNull())
    return levels.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(rows: DataFrame, columns: list[str]) -> dict[str, str]:
    """The most frequent value of each categorical column, the smallest among equals."""
    ranked = level_counts(rows, columns).groupBy("feature").agg(
        F.max("n").alias("n"), F.min(F.struct(-F.col("n"), "level")).alias("first")
    )
    return {row["feature"]: row["first"]["level"] for row in ranked.collect()}


def model_columns(rows: DataFrame) -> DataFrame:
    """Features in the types the ML stages take: doubles and strings."""
    rest = [c for c in rows.columns if c not in FEATURES]
    return rows.select(
        *rest,
        *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES],
        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL_FEATURES],
    )


def balanced_weights(rows: DataFrame) -> DataFrame:
    """Weight ``n / (2 * n_class)``, which gives both classes the same total."""
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(LABEL)).alias("fraud")).first()
    fraud, other = counts["fraud"], counts["n"] - counts["fraud"]
    if not fraud or not other:
        raise ValueError("training needs both classes")
    label = F.col(LABEL).cast("double")
    weight = F.when(F.col(LABEL), counts["n"] / (2 * fraud)).otherwise(counts["n"] / (2 * other))
    return rows.withColumns({"label_num": label, "weight": weight})


def _imputers(modes: dict[str, str], medians: dict[str, float]) -> list:
    """Stages that fill nulls with the training rows' modes and exact medians."""
    return [_fill_modes(modes), _fill_medians(medians)]


def _fill_medians(medians: dict[str, float]) -> SQLTransformer:
    """A column ``x_filled`` for each number; zero where the training rows have no value at all."""
    filled = [f"COALESCE(NANVL({c}, CAST(NULL AS DOUBLE)), {medians.get(c, 0.0)!r}D) AS {c}_filled" for c in NUMERIC_FEATURES]
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def _indexer() -> StringIndexer:
    return StringIndexer(
        inputCols=CATEGORICAL_FEATURES, outputCols=[f"{c}_index" for c in CATEGORICAL_FEATURES],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )


def _fill_modes(modes: dict[str, str]) -> SQLTransformer:
    """A stage that replaces null categories by the training mode; saved with the pipeline."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    kept = ", ".join(modes)
    filled = ", ".join(f"COALESCE({column}, {quoted(value)}) AS {column}" for column, value in modes.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({kept}), {filled} FROM __THIS__")


def linear_pipeline(modes: dict[str, str], medians: dict[str, float], rows: int, max_iter: int = 300) -> Pipeline:
    """Median and mode imputation, scaling, one-hot encoding, L2 logistic regression.

    Every known category keeps its own column; an unknown one is all zeros. The penalty
    ``1 / rows`` is a unit inverse strength on the weighted sum of losses.
    """
    scaled = VectorAssembler(inputCols=[f"{c}_filled" for c in NUMERIC_FEATURES], outputCol="numeric")
    scaler = StandardScaler(inputCol="numeric", outputCol="numeric_scaled", withMean=True, withStd=True)
    onehot = OneHotEncoder(
        inputCols=[f"{c}_index" for c in CATEGORICAL_FEATURES],
        outputCols=[f"{c}_onehot" for c in CATEGORICAL_FEATURES], dropLast=True,
    )
    assembled = VectorAssembler(
        inputCols=["numeric_scaled", *[f"{c}_onehot" for c in CATEGORICAL_FEATURES]], outputCol="features"
    )
    model = LogisticRegression(
        featuresCol="features", labelCol="label_num", weightCol="weight", regParam=1.0 / rows,
        elasticNetParam=0.0, standardization=False, maxIter=max_iter,
    )
    return Pipeline(stages=[*_imputers(modes, medians), _indexer(), scaled, scaler, onehot, assembled, model])


# --- fitting and scoring -------------------------------------------------------------------


def fit_lr(train: DataFrame, max_iter: int = 300) -> PipelineModel:
    """Fit the logistic regression on a training split."""
    assert_no_leakage(FEATURES)
    rows = model_columns(train).persist()
    try:
        modes, medians = most_frequent(rows, CATEGORICAL_FEATURES), exact_medians(rows, NUMERIC_FEATURES)
        pipeline = linear_pipeline(modes, medians, rows.count(), max_iter)
        return pipeline.fit(balanced_weights(rows))
    finally:
        rows.unpersist()


@dataclass
class FraudTrees:
    """Boosted trees with the values that fill nulls before they are binned."""

    modes: dict[str, str]
    medians: dict[str, float]
    trees: BoostedTrees

    def transform(self, rows: DataFrame) -> DataFrame:
        return filled(rows, self.modes, self.medians).withColumn("score", self.trees.probability())

    def save(self, spark: SparkSession, path: str) -> None:
        self.trees.save(spark, f"{path}/trees")
        values = [(k, c, str(v)) for k, own in (("mode", self.modes), ("median", self.medians)) for c, v in own.items()]
        spark.createDataFrame(values, "kind string, feature string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/filled")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FraudTrees:
        rows = spark.read.parquet(f"{path}/filled").collect()
        modes = {r.feature: r.value for r in rows if r.kind == "mode"}
        medians = {r.feature: float(r.value) for r in rows if r.kind == "median"}
        return FraudTrees(modes, medians, BoostedTrees.load(spark, f"{path}/trees"))


def filled(rows: DataFrame, modes: dict[str, str], medians: dict[str, float]) -> DataFrame:
    """Nulls replaced by the training rows' most frequent levels and medians."""
    numbers = {c: F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(m)) for c, m in medians.items()}
    return rows.withColumns({**numbers, **{c: F.coalesce(c, F.lit(m)) for c, m in modes.items()}})


def fit_gbt(train: DataFrame, max_iter: int = 250, patience: int = 20, max_leaves: int = 31) -> FraudTrees:
    """Fit leaf-wise boosted trees; a fixed tenth of the rows tells when to stop."""
    assert_no_leakage(FEATURES)
    held_out = F.pmod(F.xxhash64("transaction_id", F.lit(SEED)), F.lit(10)) == 0
    rows = model_columns(train).persist()
    try:
        modes, medians = most_frequent(rows, CATEGORICAL_FEATURES), exact_medians(rows, NUMERIC_FEATURES)
        weighted = filled(balanced_weights(rows), modes, medians).withColumn("held_out", held_out)
        settings = Settings(max_iter=max_iter, patience=patience, max_leaves=max_leaves)
        return FraudTrees(modes, medians, boosting.fit(weighted, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "label_num", "weight", "held_out", settings))
    finally:
        rows.unpersist()


def stated_score(rows: DataFrame, intercept: float, coefficients: list[tuple[str, float]]) -> DataFrame:
    """(transaction_id, label, score) by a logistic regression whose coefficients are given.

    A name is a numeric feature, or ``column_level`` for a level of a categorical one, as in the
    table of a fitted model. Nulls count as zero. Terms are added in the given order.
    """
    total = F.lit(float(intercept))
    for name, weight in coefficients:
        if name in NUMERIC_FEATURES:
            value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        else:
            column = max((c for c in CATEGORICAL_FEATURES if name.startswith(f"{c}_")), key=len, default=None)
            if column is None:
                raise ValueError(f"Unknown feature: {name}")
            level = F.col(column).cast("string") == F.lit(name.removeprefix(f"{column}_"))
            value = F.when(level, 1.0).otherwise(0.0)
        total = total + F.lit(float(weight)) * value
    return rows.select("transaction_id", F.col(LABEL).alias("label"), (1 / (1 + F.exp(-total))).alias("score"))


def score(model: PipelineModel | FraudTrees, rows: DataFrame) -> DataFrame:
    """Fraud probability of each payment as (transaction_id, label, score)."""
    scored = model.transform(model_columns(rows))
    value = F.col("score") if isinstance(model, FraudTrees) else F.get(vector_to_array("probability"), F.lit(1))
    return scored.select("transaction_id", F.col(LABEL).alias("label"), value.alias("score"))


# --- explanation ---------------------------------------------------------------------------


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector slots: numeric features, then category levels."""
    indexer = next(stage for stage in model.stages if type(stage).__name__ == "StringIndexerModel")
    levels = [
        f"{column}_{level}"
        for column, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray, strict=True)
        for level in labels
    ]
    return [*NUMERIC_FEATURES, *levels]


def lr_coefficients(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Coefficients of the logistic regression, strongest first."""
    coefficients = [float(value) for value in model.stages[-1].coefficients.toArray()]
    names = feature_names(model)
    if len(names) != len(coefficients):
        raise ValueError("feature names and coefficients differ in number")
    return coefficient_table(spark, list(zip(names, coefficients, strict=True)))


def coefficient_table(spark: SparkSession, coefficients: list[tuple[str, float]]) -> DataFrame:
    """Named coefficients with their odds ratios, strongest first."""
    table = spark.createDataFrame(coefficients, "feature string, coefficient double")
    return table.withColumns(
        {"exp_coefficient": F.exp("coefficient"), "absolute_coefficient": F.abs("coefficient")}
    ).orderBy(F.desc("absolute_coefficient"), "feature")


def top_coefficients(coefficients: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most positive and the ``n`` most negative coefficients."""
    picked = coefficients.select("feature", "coefficient", "exp_coefficient")
    return union_all(
        [
            picked.orderBy(F.desc("coefficient"), "feature").limit(n).withColumn("side", F.lit("positive")),
            picked.orderBy("coefficient", "feature").limit(n).withColumn("side", F.lit("negative")),
        ]
    )
