"""Mix sources to target weights by thresholds on a hash of the document.

Every source gets a target number of words. A source whose target is below its size gives up
the documents whose hash lies above a threshold; one whose target is larger repeats all its
documents, and those below the threshold once more. The threshold comes from nested histograms:
words are summed by source and the leading bits of the hash, the bucket in which a source's
budget ends is found, and only that bucket is refined by the next bits. Nothing is sorted, and a
source with a third of all rows is a few thousand partial sums per task.

Defined cases: a null text has no words; a null source is a source, the last one; rows that
share a ``doc_id`` (null included) share a hash and are taken or left together; documents
without words are never taken; an empty table gives an empty mix; other columns keep their values,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.llm.common import free_name, text_of, word_count
from paygrain.session import materialise

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
LEVELS = 5
LEVEL_BITS = 12
HASH_BITS = LEVELS * LEVEL_BITS
BROADCAST_ROWS = 100_000


def document_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text, an integer that any SQL engine can repeat."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def checked_broadcast(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table counted to be small; larger ones are shuffled."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def budgets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS, share: float = 1.0
) -> DataFrame:
    """Per source: size, target, whole repeats and the remainder, from (source, size).

    Weights repeat over the sources in code point order, null last. Targets share ``share`` of
    all words by weight; those above ``most_repeats`` times the size stop there and the excess
    is shared again by weight, until none is above. One row per source: a small table.
    """
    sizes = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = materialise(
        sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), rank % len(weights)).cast("double"))
        .withColumn("cap", (F.col("source_size") * most_repeats).cast("double"))
    )
    rest = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    target, shared = F.col("cap"), ranked
    while weight_sum := shared.agg(F.sum("weight")).first()[0]:
        even = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight_sum))
        target = F.least(even, F.col("cap"))
        full = shared.where(even > F.col("cap")).agg(F.sum("source_size"), F.count("*")).first()
        if not full[1]:
            break
        rest -= full[0] * most_repeats
        shared = shared.where(even <= F.col("cap"))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        ranked.withColumn("target", target)
        .withColumn("repeats", repeats.cast("long"))
        .withColumn("remainder", F.col("target") - F.col("repeats") * F.col("source_size"))
        .select("source", "source_size", "target", "repeats", "remainder")
    )


def bucket(level: int) -> Column:
    return F.shiftright(F.col("hash"), HASH_BITS - LEVEL_BITS * (level + 1))


def thresholds(sized: DataFrame, budget: DataFrame) -> DataFrame:
    """``budget`` with the threshold per source: documents up to it are taken once more.

    ``open`` is the leading bits of the bucket that the budget ends in and ``below`` the words
    of the buckets before it. After the last level a bucket is one hash value, taken if that
    brings the source nearer to its target than leaving it.
    """
    state = materialise(budget.withColumns({"open": F.lit(0).cast("long"), "below": F.lit(0).cast("long")}))
    rows = state.count()
    in_source = Window.partitionBy("source").orderBy("bucket")
    for level in range(LEVELS):
        last = level == LEVELS - 1
        inside = (
            (F.shiftright(F.col("hash"), HASH_BITS - LEVEL_BITS * level) == F.col("open")) if level else F.lit(True)
        )
        parent = checked_broadcast(state.select(F.col("source").alias("of"), "open"), rows)
        sums = (
            sized.where(F.col("size") > 0)
            .join(parent, F.col("source").eqNullSafe(F.col("of")))
            .where(inside)
            .groupBy("source", bucket(level).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        upto = sums.withColumn("upto", F.sum("words").over(in_source)).select(
            F.col("source").alias("of"), "bucket", "words", "upto"
        )
        ends = state.join(
            upto, F.col("source").eqNullSafe(F.col("of")) & (F.col("below") + F.col("upto") > F.col("remainder"))
        )
        first = ends.groupBy("source").agg(F.min(F.struct("bucket", "words", "upto")).alias("end"))
        state = materialise(
            state.join(
                first.select(F.col("source").alias("of"), "end"), F.col("source").eqNullSafe(F.col("of")), "left"
            ).select(
                *budget.columns,
                F.coalesce("end.bucket", F.lit(-1).cast("long")).alias("open"),
                (F.col("below") + F.coalesce(F.col("end.upto") - F.col("end.words"), F.lit(0))).alias("below"),
                F.coalesce("end.words", F.lit(0).cast("long")).alias("words"),
            )
        )
        if not last:
            state = state.drop("words")
    nearer = (F.col("below") + F.col("words") - F.col("remainder")) < (F.col("remainder") - F.col("below"))
    threshold = F.when(nearer, F.col("open")).otherwise(F.col("open") - 1)
    return state.withColumn("threshold", threshold).drop("open", "below", "words", "remainder")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS, share: float = 1.0
) -> DataFrame:
    """``docs`` and a last column ``mix``: size, source_size, target, copies and taken words.

    The documents themselves are read twice, for the sizes and for the result, and not shuffled.
    An own column of that name keeps it; the new one is then called ``mix_``.
    """
    into, plan_name = free_name(docs, "mix"), free_name(docs, "plan__")
    own = F.struct(
        word_count(text_of(F.col("text"))).alias("size"), document_hash(F.col("doc_id")).alias("hash")
    )
    sized = materialise(docs.select("source", own.alias("own")).select("source", "own.*"))
    plan = materialise(thresholds(sized, budgets(sized, weights, most_repeats, share)))
    plan = plan.select(F.struct(*plan.columns).alias(plan_name))
    size, of = F.col(into)["size"], F.col(plan_name)
    extra = F.when(F.col(into)["hash"] <= of["threshold"], 1).otherwise(0)
    copies = F.when(size > 0, of["repeats"] + extra).otherwise(0).cast("long")
    return (
        docs.withColumn(into, own)
        .join(checked_broadcast(plan, plan.count()), F.col("source").eqNullSafe(of["source"]))
        .select(
            *docs.columns,
            F.struct(
                size.alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"),
                copies.alias("copies"), (size * copies).alias("taken"),
            ).alias(into),
        )
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    chosen = mix(docs, **how)
    times = F.sequence(F.lit(1).cast("long"), F.col(chosen.columns[-1])["copies"])
    copies = chosen.where(F.col(chosen.columns[-1])["copies"] > 0)
    return copies.select(*docs.columns, F.explode(times).alias(free_name(docs, "copy__"))).select(*docs.columns)
