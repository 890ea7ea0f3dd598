"""Additive measures of the fact table and the columns reported from them.

Every report groups once into additive measures (which Spark combines on the map side, so a
hot key never travels row by row), may roll them up again after attaching attributes to the
much smaller result, and only then divides. Unused measures are pruned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.functions.money import dollars, limbs, money_sums, ratio
from paygrain.schema import APPROVED, DECLINED


WORDS = 8  # of 64 bits in a block of a bitmap
BLOCK_BITS = [f"bits{i}" for i in range(WORDS)]


def _additive() -> dict[str, Column]:
    approved = F.col("transaction_status") == APPROVED
    return {
        "n": F.count(F.lit(1)),
        **money_sums("transaction_amount_usd", "value"),
        "value_n": F.count("transaction_amount_usd"),
        "approved_n": F.count_if(approved),
        "declined_n": F.count_if(F.col("transaction_status") == DECLINED),
        **money_sums(F.when(approved, F.col("transaction_amount_usd")), "approved"),
        "fraud_n": F.count_if(F.col("is_fraud")),
        **money_sums("fraud_loss_amount_usd", "loss"),
        "cross_n": F.count_if(F.col("is_cross_border")),
        "ms_sum": F.sum("processing_time_ms"),
        "ms_n": F.count("processing_time_ms"),
    }


ADDITIVE_NAMES = [
    "n", *limbs("value"), "value_n", "approved_n", "declined_n", *limbs("approved"),
    "fraud_n", *limbs("loss"), "cross_n", "ms_sum", "ms_n",
]


def additive_columns() -> list[Column]:
    return [expression.alias(name) for name, expression in _additive().items()]


def measure(fact: DataFrame, *keys: str | Column, extra: Sequence[Column] = ()) -> DataFrame:
    return fact.groupBy(*keys).agg(*additive_columns(), *extra)


def roll_up(measures: DataFrame, *keys: str | Column, extra: Sequence[Column] = ()) -> DataFrame:
    return measures.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in ADDITIVE_NAMES], *extra)


def distinct_members(fact: DataFrame, keys: Sequence[str], member: str, name: str) -> DataFrame:
    """Distinct non-null members per group, deduplicated before they are counted.

    A pass of its own over two or three columns. As one more distinct aggregate beside the
    measures it would copy every row, or carry all measures at the grain of the member.
    """
    pairs = fact.select(*keys, member).dropna(subset=[member]).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def meet(groups: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach further columns to groups whose keys may be null."""
    renamed = extra.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return groups.join(renamed, same, "left").drop(*[f"_{key}" for key in keys])


def member_words(fact: DataFrame, keys: Sequence[str], members: dict[str, str]) -> DataFrame:
    """(keys, member, block, bits0 to bits7): the sets of members per group as bitmaps, mergeable by ``bit_or``.

    ``members`` maps a name to a column of whole numbers. A number is a bit of one of the eight 64-bit
    words of its block, so that of densely numbered members a group has a row per 512, made in the
    tasks, in one scan for all of ``members``; keys are short numbers, so tasks hold few bytes a row.
    Blocks of finer groups make those of coarser ones: no second scan of the fact.
    """
    pairs = F.array(*(
        F.struct(F.lit(i).cast("tinyint").alias("place"), F.col(c).cast("bigint").alias("number"))
        for i, c in enumerate(members.values())
    ))
    rows = fact.select(*keys, F.inline(pairs)).where("number IS NOT NULL")
    bit = F.expr("shiftleft(1L, CAST(pmod(number, 64) AS INT))")
    word = F.pmod(F.shiftright("number", 6), F.lit(WORDS))
    words = [F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"bits{i}") for i in range(WORDS)]
    grouped = rows.groupBy(*keys, "place", F.shiftright("number", 9).alias("block")).agg(*words)
    names = F.array(*(F.lit(name) for name in members))
    return grouped.select(*keys, F.get(names, F.col("place").cast("int")).alias("member"), "block", *BLOCK_BITS)


def merged_words(words: DataFrame, *keys: str | Column) -> DataFrame:
    """The bitmaps of coarser groups from those of finer ones."""
    return words.groupBy(*keys, "member", "block").agg(*(F.bit_or(bits).alias(bits) for bits in BLOCK_BITS))


def members_counted(words: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One column per name with the number of distinct members of each group."""
    held = reduce(add, (F.bit_count(bits) for bits in BLOCK_BITS))
    counts = {n: F.when(F.col("member") == n, held).otherwise(0).cast("bigint") for n in names}
    return words.groupBy(*keys).agg(*(F.sum(count).alias(n) for n, count in counts.items()))


def with_distinct_members(groups: DataFrame, fact: DataFrame, keys: Sequence[str], members: dict[str, str]) -> DataFrame:
    """Add one distinct count per entry of ``members`` (new column -> counted column)."""
    kinds = {fact.schema[member].dataType.typeName() for member in members.values()}
    if kinds <= {"byte", "short", "integer", "long"}:
        groups = meet(groups, members_counted(member_words(fact, keys, members), keys, list(members)), keys)
    else:
        for name, member in members.items():
            groups = meet(groups, distinct_members(fact, keys, member, name), keys)
    return groups.fillna(0, subset=list(members))


def reported(name: str) -> Column:
    """A report column computed from additive measures, named as in the reports."""
    expressions = {
        "transaction_count": lambda: F.col("n"),
        "transaction_value_usd": lambda: dollars("value"),
        "average_transaction_value_usd": lambda: ratio(dollars("value"), F.col("value_n")),
        "approved_transactions": lambda: F.col("approved_n"),
        "declined_transactions": lambda: F.col("declined_n"),
        "approved_payment_value_usd": lambda: dollars("approved"),
        "fraud_transactions": lambda: F.col("fraud_n"),
        "fraud_loss_usd": lambda: dollars("loss"),
        "cross_border_transactions": lambda: F.col("cross_n"),
        "average_processing_time_ms": lambda: ratio(F.col("ms_sum").cast("double"), F.col("ms_n")),
        "approval_rate": lambda: ratio(F.col("approved_n"), F.col("n")),
        "decline_rate": lambda: ratio(F.col("declined_n"), F.col("n")),
        "fraud_rate": lambda: ratio(F.col("fraud_n"), F.col("n")),
        "cross_border_rate": lambda: ratio(F.col("cross_n"), F.col("n")),
        "fraud_loss_rate": lambda: ratio(dollars("loss"), dollars("value")),
        "fraud_loss_rate_approved": lambda: ratio(dollars("loss"), dollars("approved")),
    }
    return expressions[name]().alias(name)


def report(measures: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return measures.select(*keys, *[reported(name) for name in names])
