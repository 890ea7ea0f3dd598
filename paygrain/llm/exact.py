"""Exact duplicates by merging sorted digest runs in a tree.

Every partition of the scan is a leaf that holds a run of digests. In each round ``fan_in``
neighbouring nodes send their runs to a common parent, cut by digest over all tasks; the runs are
sorted, merged, and of equal digests the identifier that ranks first and the number of copies
are kept. After the last round one node is left. The outcome goes down the tree the way the runs
came up. A digest that a third of all rows share is one row per node in every round, and on the
way down no key has more rows than one leaf and its ``fan_in - 1`` neighbours hold.

A digest is the SHA-256 of the text with its length and its XXH64. Rows merge only where all
three agree, which verifies each merge at every level.

Defined cases: a null text is an empty one; a null ``doc_id`` ranks behind all others; of rows
with equal id and text the first one read stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.llm.common import text_of
from paygrain.session import materialise

FAN_IN = 16
DIGEST = ("digest", "length", "check")
RUN_SHIFT = 33  # monotonically_increasing_id counts rows within a partition in the lower 33 bits


def leaves(docs: DataFrame, keep: str) -> DataFrame:
    """One narrow row per document: digest, identifier, position in its run."""
    text = text_of(F.col("text"))
    position = F.monotonically_increasing_id()
    rows = docs.select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("length"),
        F.xxhash64(text).alias("check"),
        position.alias("position"),
    )
    return rows.withColumns(
        {"node": F.shiftright("position", RUN_SHIFT), "best": first_ranked(keep), "copies": F.lit(1).cast("long")}
    )


def first_ranked(keep: str) -> Column:
    """A struct whose maximum is the row that stays."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    rank = F.col("doc_id") if keep == "largest" else -F.col("doc_id")
    return F.struct(rank.alias("rank"), (-F.col("position")).alias("earlier"), F.col("doc_id").alias("id"))


def parent_of(frame: DataFrame, fan_in: int) -> DataFrame:
    return frame.withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))


def exact_duplicates(docs: DataFrame, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    bottom = materialise(leaves(docs, keep))
    runs = (bottom.agg(F.max("node")).first()[0] or 0) + 1
    rounds = max(1, math.ceil(math.log(runs, fan_in))) if runs > 1 else 1
    levels = [bottom]
    for _ in range(rounds):
        merged = parent_of(levels[-1], fan_in).groupBy("node", *DIGEST)
        levels.append(materialise(merged.agg(F.max("best").alias("best"), F.sum("copies").alias("copies"))))
    outcome = levels.pop()
    while levels:
        below = levels.pop()
        down = below.drop("best", "copies").withColumnRenamed("node", "own")
        down = down.withColumn("node", F.floor(F.col("own") / fan_in).cast("long"))
        shared = outcome.where("copies > 1").select("node", *DIGEST, "best", "copies")
        if levels:
            outcome = down.join(shared, ["node", *DIGEST]).select(F.col("own").alias("node"), *DIGEST, "best", "copies")
        else:
            outcome = down.join(shared, ["node", *DIGEST], "left")
    alone = F.col("copies").isNull()
    return outcome.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("best.earlier") == -F.col("position"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
