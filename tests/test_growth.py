"""What tasks hold, joins and scans repeat, and jobs are dealt to, as the tables grow."""

from __future__ import annotations

import re

from conftest import TESTDATA
from pyspark.sql import functions as F

from paygrain.catalog import queries
from paygrain.functions.measures import member_words, members_counted, merged_words
from paygrain.operators import boosting
from paygrain.operators.boosting import Settings
from paygrain.sources.fixtures import Star

SMALL = str(TESTDATA / "sf0.001")


def test_quality_reports_join_the_fact_once(spark):
    for name in ("dq_report", "dq_gate", "dq_part_report"):
        read = queries.REGISTRY[name](spark, SMALL).inputFiles()
        assert read and not [path for path in read if "orders.parquet" in path or "lineitem.parquet" in path]


def test_fits_join_the_features_once(spark):
    view = queries.stored_features(Star(spark, SMALL))
    for split in (queries.train(view), queries.test_split(view)):
        assert split.columns and not [path for path in split.inputFiles() if "customer.parquet" in path or "part.parquet" in path]
    assert view.count() == queries.features(Star(spark, SMALL)).count()


def test_a_block_of_a_bitmap_holds_512_members(spark):
    numbers = [*range(1024), *range(500), -1, -64, -513, 1 << 40, None]
    fact = spark.createDataFrame([("g", n, 7) for n in numbers] + [(None, 3, None)], "k string, a bigint, b int")
    words = member_words(fact, ["k"], {"as": "a", "bs": "b"})
    assert words.where("k = 'g' AND member = 'as' AND block IN (0, 1)").count() == 2
    assert words.where("k = 'g' AND member = 'as'").count() == 5
    expected = {("g", 1028, 1), (None, 1, 0)}
    assert {tuple(r) for r in members_counted(words, ["k"], ["as", "bs"]).collect()} == expected
    halves = [member_words(fact.where(c), ["k"], {"as": "a", "bs": "b"}) for c in ("a % 2 = 0", "a % 2 <> 0 OR a IS NULL")]
    united = merged_words(halves[0].unionByName(halves[1]), "k")
    assert {tuple(r) for r in members_counted(united, ["k"], ["as", "bs"]).collect()} == expected


def test_blocks_of_ids_are_not_grouped_by_id(spark):
    plan = queries.dense_id_blocks.__wrapped__ if hasattr(queries.dense_id_blocks, "__wrapped__") else queries.dense_id_blocks
    frame = plan(Star(spark, SMALL))
    assert not re.search(r"Aggregate\(keys=\[[^\]]*line_id", frame._jdf.queryExecution().toString())
    wrong = frame.where("ids <> lines OR last_id - first_id + 1 <> lines")
    assert frame.count() > 0 and wrong.count() == 0


def test_rows_of_one_partition_are_dealt_to_cores_and_have_gradients_once_a_tree(spark, monkeypatch):
    rows = spark.range(30_000, numPartitions=1).select(
        (F.col("id") % 17).cast("double").alias("a"), F.lit("u").alias("c"), ((F.col("id") * 7919) % 17 < 5).alias("y"),
        F.lit(1.0).alias("w"), (F.col("id") % 10 == 0).alias("held"),
    )
    parts = []
    plain = boosting.Trainer.begin_tree
    monkeypatch.setattr(boosting.Trainer, "begin_tree", lambda self: parts.append(self.arrays.getNumPartitions()) or plain(self))
    model = boosting.fit(rows, ["a"], ["c"], "y", "w", "held", Settings(max_iter=2))
    assert len(model.trees) == 2 and parts == [3, 3, 3]
