"""Reading, writing and describing tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paygrain import schema
from paygrain.functions.dates import transaction_date
from paygrain.operators import quality
from paygrain.plans import views
from paygrain.sources import sinks, tables


def test_missing_tables_are_named(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there"))
    assert tables.read_table(spark, str(tmp_path / "there")).count() == 3
    with pytest.raises(tables.MissingTables, match="nowhere"):
        tables.read_table(spark, str(tmp_path / "nowhere"))
    with pytest.raises(tables.MissingTables, match="Missing tables: a, b"):
        tables.read_tables(spark, {"b": str(tmp_path / "x"), "a": "no_such_view", "c": str(tmp_path / "there")})


def test_nanosecond_files_of_pandas(spark, dimensions, tmp_path):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    times = np.array(["2025-01-01T23:59:59.123456789", "1969-12-31T23:59:59.999999999", "NaT"], dtype="datetime64[ns]")
    columns = {c: [None] * 3 for c in schema.REQUIRED_COLUMNS} | {
        "transaction_id": [1, 2, 3], "transaction_timestamp": times, "country_id": ["IRL"] * 3,
        "transaction_amount_usd": [1.0, 2.0, 3.0], "transaction_status": ["approved"] * 3, "is_fraud": [False] * 3,
    }
    (tmp_path / "fact").mkdir()
    pq.write_table(pa.table(columns), tmp_path / "fact" / "part.parquet", version="2.6")
    back = tables.read_fact(spark, str(tmp_path / "fact"))
    kinds = dict(back.dtypes)
    assert kinds["transaction_timestamp"] == "timestamp_ntz" and kinds["is_cross_border"] == "boolean"
    found = [r.transaction_timestamp for r in back.orderBy("transaction_id").collect()]
    assert found == [datetime(2025, 1, 1, 23, 59, 59, 123456), datetime(1969, 12, 31, 23, 59, 59, 999999), None]
    daily = views.payment_performance_daily(back, dimensions["dim_country"]).collect()
    assert {str(r.transaction_date): r.transaction_count for r in daily} == {"2025-01-01": 1, "1969-12-31": 1, "None": 1}
    named = tables.read_tables(spark, {"fact_transactions": str(tmp_path / "fact")})
    assert named["fact_transactions"].dtypes == back.dtypes


def test_odd_files_are_not_called_missing(spark, tmp_path):
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "part.parquet").write_text("not a table")
    with pytest.raises(Exception) as error:
        tables.read_fact(spark, str(tmp_path / "odd")).count()
    assert not isinstance(error.value, tables.MissingTables)


def test_all_reports_as_views(spark, payments, dimensions):
    declined = {"transaction_status": "declined", "decline_reason": "do_not_honor"}
    fact = payments({}, {"is_fraud": True, "fraud_loss_amount_usd": 5.0}, declined)
    names = views.register_report_views(
        spark, fact, dimensions["dim_merchant"], dimensions["dim_customer"], dimensions["dim_device"],
        dimensions["dim_country"],
    )
    assert len(names) == 9 and all(spark.table(n).count() > 0 for n in names)


def test_a_day_is_replaced_alone(spark, payments, tmp_path):
    path = str(tmp_path / "fact")
    sinks.write_fact(payments(*[{"transaction_timestamp": datetime(2025, 1, 1 + i % 3)} for i in range(9)]), path)
    again = payments({"transaction_timestamp": datetime(2025, 1, 2)})
    sinks.write_fact(again, path)
    counts = spark.read.parquet(path).groupBy("transaction_date").count().collect()
    assert {str(r[0])[-2:]: r[1] for r in counts} == {"01": 3, "02": 1, "03": 3}
    sinks.write_fact(again, path, replace="table")
    assert spark.read.parquet(path).count() == 1


def test_views_by_name(spark):
    tables.register_views(spark, {"some_numbers": spark.range(4)})
    assert tables.read_table(spark, "some_numbers").count() == 4


def test_parts_round_trip(spark, payments, tmp_path):
    path = str(tmp_path / "parts")
    fact = payments(*[{"transaction_timestamp": datetime(2025, 1, 1 + i % 3)} for i in range(50)])
    sinks.write_parts(fact.coalesce(1).orderBy("transaction_id"), path, rows_per_file=20)
    back = tables.read_fact(spark, path)
    assert back.count() == 50
    manifest = tables.part_manifest(back).orderBy("start_transaction_id").collect()
    assert [(r.rows, r.start_transaction_id) for r in manifest] == [(20, 1), (20, 21), (10, 41)]
    checks = quality.part_key_checks(tables.with_part(back))
    assert checks.count() == 6 and checks.where("NOT passed").count() == 0
    sinks.write_parts(fact.limit(5), path)
    assert tables.read_fact(spark, path).count() == 5
    with pytest.raises(tables.MissingTables):
        tables.read_fact(spark, str(tmp_path / "none"))


def test_fact_layout_prunes_days(spark, payments, dimensions, tmp_path):
    path = str(tmp_path / "fact")
    fact = payments(*[{"transaction_timestamp": datetime(2025, 1, 1 + i % 3, 7)} for i in range(60)])
    sinks.write_fact(fact, path)
    back = spark.read.parquet(path)
    day = back.where(transaction_date(back) == F.lit("2025-01-02").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan and day.count() == 20
    daily = views.payment_performance_daily(back, dimensions["dim_country"])
    assert sorted(map(tuple, daily.collect())) == sorted(
        map(tuple, views.payment_performance_daily(fact, dimensions["dim_country"]).collect())
    )


def test_busy_day_is_written_by_many_tasks(spark, payments, tmp_path):
    """Nearly all payments on one day: AQE splits the day, every row is written."""
    template = payments({}).drop("transaction_id", "transaction_timestamp", "customer_id")
    many = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 100 == 0, F.lit("2025-01-02")).otherwise(F.lit("2025-01-01")).cast("timestamp_ntz").alias(
            "transaction_timestamp"
        ),
        F.sha2(F.col("id").cast("string"), 256).alias("customer_id"),
    )
    kinds = dict(template.dtypes)
    fact = many.select("*", *[F.lit(v).cast(kinds[n]).alias(n) for n, v in template.first().asDict().items()])
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        sinks.write_fact(fact, str(tmp_path / "busy"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    back = spark.read.parquet(str(tmp_path / "busy"))
    files = tables.with_part(back).groupBy("transaction_date").agg(F.count_distinct("part").alias("files"), F.count("*").alias("n"))
    found = {str(r.transaction_date): (r.n, r.files) for r in files.collect()}
    assert found["2025-01-01"][0] == 59_400 and found["2025-01-02"][0] == 600
    assert found["2025-01-01"][1] > 3


def test_samples_and_reports(spark, tmp_path):
    sinks.write_sample(spark.range(100), "id", 7, str(tmp_path / "sample"))
    back = spark.read.option("header", True).csv(str(tmp_path / "sample"))
    assert sorted(int(r.id) for r in back.collect()) == list(range(7))
    for kind in ("json", "csv"):
        sinks.write_report(spark.range(5), str(tmp_path / kind), kind)
    assert spark.read.json(str(tmp_path / "json")).count() == 5
    sinks.write_table(spark.range(2), str(tmp_path / "table"))
    sinks.write_table(spark.range(3), str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3


def test_counts_and_columns(spark):
    some = {"b": spark.range(2), "a": spark.range(3).withColumn("x", F.lit("t"))}
    assert [tuple(r) for r in tables.row_counts(some).collect()] == [("a", 3), ("b", 2)]
    assert {tuple(r) for r in tables.manifest(some).collect()} == {("a", 3, 2), ("b", 2, 1)}
    assert [tuple(r) for r in tables.describe_columns(some["a"]).collect()] == [("id", "bigint"), ("x", "string")]
    assert tables.describe_columns(some["a"], ["age_band"]).count() == 0
    assert tables.drop_columns(some["a"], ["x", "age_band"]).columns == ["id"]


def test_declared_schemas(spark, payments):
    declared = schema.table_schema("fact_transactions")
    assert declared.fieldNames() == payments({}).columns == schema.REQUIRED_COLUMNS
    assert all(len(schema.table_schema(name)) == len(columns) for name, columns in schema.TABLE_COLUMNS.items())
