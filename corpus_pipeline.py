"""From raw documents to training windows, in five stages.

Each stage is a function of (spark, docs, directory) over all that the stage before it kept. Its
result is written as Parquet and read again as the next one's documents, which also cuts the
lineage: an executor that is lost costs the stage that runs, not those before it. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.llm import lines, mixing, packing, rules, simhash
from paygrain.llm.queries import TOKENIZER
from paygrain.session import use_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Documents without the lines that others repeat; ``n_chars`` is that of the new text."""
    kept = lines.apply_bitmaps(docs, lines.line_bitmaps(docs))
    n_chars = F.when(F.col(kept.columns[-1]) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.one_of_each_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def window_packing(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Pieces of tokenised documents in windows."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("window_packing", window_packing),
]

ORACLE_SQL = None  # neither XXH64 fingerprints nor tokenizers are SQL


def run(spark: SparkSession, directory: str) -> DataFrame:
    """The pieces of all documents; stages write to the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, directory).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
