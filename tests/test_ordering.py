"""The ranged orderings equal plain windows, whatever the ties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paygrain.operators.ordering import (
    dense_ids,
    keys_at,
    ntile,
    percent_rank,
    share_of_total,
    with_global_ranks,
    with_running_totals,
)


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one value, some are null, the rest is skewed."""
    rng = random.Random(5)
    values = [
        (i, None if i % 41 == 0 else 0.0 if i % 3 == 0 else round(rng.lognormvariate(2, 2), 2), f"id{i % 500:04d}")
        for i in range(3000)
    ]
    return spark.createDataFrame(values, "id bigint, value double, name string").repartition(7)


@pytest.mark.parametrize("ranges", [None, 1, 10, 60])
def test_ranks_equal_plain_windows(rows, ranges):
    orders = {
        "by_value": [F.col("value")],
        "by_value_desc_id": [F.col("value").isNull(), -F.col("value"), F.col("id")],
        "by_name_id": [F.col("name"), F.col("id")],
    }
    ranked, n = with_global_ranks(rows, orders, ranges)
    assert n == 3000
    checked = ranked.withColumns(
        {
            "plain_value": F.rank().over(Window.orderBy("value")),
            "plain_desc": F.row_number().over(Window.orderBy(F.desc_nulls_last("value"), "id")),
            "plain_name": F.row_number().over(Window.orderBy("name", "id")),
            "plain_percent": F.percent_rank().over(Window.orderBy("value")),
            "plain_tile": F.ntile(7).over(Window.orderBy(F.desc_nulls_last("value"), "id")),
            "percent": percent_rank("by_value", n),
            "tile": ntile("by_value_desc_id", n, 7),
        }
    )
    assert checked.count() == 3000
    wrong = checked.where(
        "by_value <> plain_value OR by_value_desc_id <> plain_desc OR by_name_id <> plain_name "
        "OR percent <> plain_percent OR tile <> plain_tile"
    )
    assert wrong.count() == 0


@pytest.mark.parametrize("ranges", [None, 1, 30])
def test_positions_equal_the_sorted_list(rows, ranges):
    expected = sorted(((r.value is not None, r.value or 0.0, r.id) for r in rows.collect()))
    positions = [1, 2, 74, 75, 700, 1500, 2999, 3000]
    keys = keys_at(rows, [F.col("value"), F.col("id")], positions, ranges)
    assert [(k[0] is not None, k[0] or 0.0, k[1]) for k in keys] == [expected[p - 1] for p in positions]
    ties = keys_at(rows, [F.col("value")], positions, ranges)
    assert [t[0] for t in ties] == [k[0] for k in keys]


@pytest.mark.parametrize("ranges", [None, 30])
def test_running_totals_equal_plain_windows(rows, ranges):
    counts = rows.groupBy("value").agg(F.count("*").alias("n"), F.sum("id").alias("weight"))
    totals, grand = with_running_totals(
        counts, [F.col("value")], {"n_up_to": "n", "weight_up_to": "weight"}, ranges
    )
    window = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    wrong = totals.withColumns(
        {"n_plain": F.sum("n").over(window), "w_plain": F.sum("weight").over(window)}
    ).where("n_plain <> n_up_to OR w_plain <> weight_up_to")
    assert wrong.count() == 0 and totals.count() == counts.count()
    assert grand == {"n_up_to": 3000, "weight_up_to": sum(range(3000))}


def test_percent_rank_with_null_and_ties(spark):
    table = spark.createDataFrame([(None,), (1.0,), (2.0,), (2.0,), (3.0,)], "v double")
    ranked, n = with_global_ranks(table, {"r": [F.col("v")]}, ranges=5)
    assert sorted(r[0] for r in ranked.select(percent_rank("r", n)).collect()) == [0.0, 0.25, 0.5, 0.5, 1.0]


def test_more_tiles_than_rows_and_single_row(spark):
    ranked, n = with_global_ranks(spark.range(3), {"r": [F.col("id")]})
    assert sorted(r[0] for r in ranked.select(ntile("r", n, 5)).collect()) == [1, 2, 3]
    one, n = with_global_ranks(spark.range(1), {"r": [F.col("id")]})
    assert one.select(percent_rank("r", n)).first()[0] == 0.0


def test_empty_table(spark):
    ranked, n = with_global_ranks(spark.range(0), {"r": [F.col("id")]})
    assert n == 0 and ranked.count() == 0


def test_ranged_plan_has_no_single_task_window(rows):
    ranked, _ = with_global_ranks(rows, {"r": [F.col("value")]}, ranges=20)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "_range" in plan


def test_dense_ids_start_where_asked(spark):
    ids = dense_ids(spark.range(0, 1000, 7), [-F.col("id")], start=501, ranges=20)
    assert [r.dense_id for r in ids.orderBy(F.desc("id")).collect()] == list(range(501, 501 + 143))


def test_shares_sum_to_one(rows):
    shares = share_of_total(rows.fillna(0.0), "value", "share")
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    assert share_of_total(rows.limit(3), F.lit(0.0), "share").where("share IS NOT NULL").count() == 0
