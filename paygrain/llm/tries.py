"""The prefix trie of conversations, and sums over all its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. Its key is an MD5 over its depth and three sums of 40
hashed bits per turn (120 bits that depend on every turn and its place), which a running sum gives
for all prefixes at once; texts are read once and never moved.

``subtree_totals`` adds figures up over subtrees without walking down them. Each round of joins
rakes all leaves into their parents and, at the same time, compresses chains: a random part of the
nodes with a single child, no two of them neighbours, hand their sum to their child as an extra for
the parent above, and leave. So bushes and chains of any depth shrink by a constant share each
round. Then the contracted nodes are put back: a node's total is that of its child plus what it
handed over, added up along the children by joins that halve the way. Nodes tell each other by
messages that are aggregated by key, in the tasks first: a parent of many is no hot key.

Defined cases: a null role or text is empty; turns are ordered with null first, equal ones by role
and text, and repeated rows are turns of their own; rows without ``conv_id`` belong to no
conversation and are left out; an empty table has no node, not even a root. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.llm.common import Scratch, lookup, text_of
from paygrain.session import materialise

PIECES, PIECE_BITS = 3, 40  # sums of 2^23 turns still fit a long


def digested(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, n_bytes): the turns of each conversation, numbered from 0."""
    role, text = text_of(F.col("role")), text_of(F.col("text"))
    # The role's length tells where it ends.
    digest = F.md5(F.concat_ws(":", F.char_length(role).cast("string"), role, text))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest", "n_bytes")
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "digest", "n_bytes")


def node_key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *(s.cast("string") for s in sums))))


ROOT = hashlib.md5(b"0,0,0,0").digest()


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, n_bytes): every conversation in every node but the root it belongs to."""
    names = [f"s{i}" for i in range(PIECES)]
    pieces = [F.pmod(F.xxhash64("digest", "place", F.lit(i)), F.lit(1 << PIECE_BITS)) for i in range(PIECES)]
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    hashed = turns.withColumns({f"p{i}": piece for i, piece in enumerate(pieces)})
    summed = hashed.withColumns({name: F.sum(f"p{i}").over(upto) for i, name in enumerate(names)})
    depth = F.row_number().over(Window.partitionBy("conv_id").orderBy("place"))
    return summed.withColumn("depth", depth).select(
        "conv_id", "depth",
        node_key(F.col("depth"), [F.col(n) for n in names]).alias("key"),
        node_key(F.col("depth") - 1, [F.col(n) - F.col(f"p{i}") for i, n in enumerate(names)]).alias("parent"),
        "n_bytes",
    )


def added(*columns: str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])


def subtree_totals(nodes: DataFrame, names: list[str]) -> DataFrame:
    """(key, names): the sums of the bigint columns ``names`` over each node's subtree, itself included.

    ``nodes`` has key, parent (null: a root) and the columns to sum; any number of trees.
    """
    extras = [f"extra_{n}" for n in names]
    with Scratch(nodes.sparkSession, "tries") as scratch:
        alive = nodes.select("key", "parent", *names, *(F.lit(0).cast("long").alias(e) for e in extras))
        raked, spliced = [], []
        while True:
            state = scratch.table(contracted(alive, names, extras, len(raked)))
            raked.append(state.where("raked").select("key", *names))
            alive = state.where("NOT raked AND NOT spliced").select("key", "parent", *names, *extras)
            if not alive.limit(1).count():
                break
            spliced.append(state.where("spliced").select("key", "child", *(F.col(f"handed_{n}").alias(n) for n in names)))
        found = reduce(DataFrame.unionAll, raked)
        if spliced:
            found = found.unionAll(expanded(reduce(DataFrame.unionAll, spliced), found, names, scratch))
        return materialise(found)


def contracted(alive: DataFrame, names: list[str], extras: list[str], number: int) -> DataFrame:
    """One round of rake and compress: what has become of each node, by two exchanges of messages.

    ``raked``: a leaf, whose sums went to its parent. ``spliced``: a node with a single child, not
    a leaf, that tossed heads while the child is not such a node with heads, so that no two
    neighbours leave at once; its child carries its sums up as extras and has its parent from now
    on, and ``handed_x`` is what the node adds to its child's total.
    """
    blank = {c: F.lit(None).cast(t) for c, t in alive.dtypes}
    own = alive.withColumns({"n_below": F.lit(0), "child": F.lit(None).cast("binary")})
    up = alive.where("parent IS NOT NULL").select(
        *(F.col("parent").alias("key") if c == "key" else value.alias(c) for c, value in blank.items()),
        F.lit(1).alias("n_below"), F.col("key").alias("child"),
    )
    state = own.unionAll(up).groupBy("key").agg(
        *(F.max(c).alias(c) for c in alive.columns[1:]), F.sum("n_below").alias("n_below"), F.min("child").alias("child")
    )
    heads = (F.col("n_below") == 1) & F.col("parent").isNotNull() & (F.pmod(F.xxhash64("key", F.lit(number)), F.lit(2)) == 0)
    state = state.withColumn("heads", heads)
    given, under, more = ([f"{word}_{n}" for n in names] for word in ("given", "under", "more"))
    no_sums = [F.lit(None).cast("long").alias(c) for c in [*given, *under, *more]]
    to_self = [F.lit(None).cast("boolean").alias("under_heads"), F.lit(0).alias("n_inner"), F.lit(None).cast("boolean").alias("over_heads"), F.lit(None).cast("binary").alias("above")]
    own_part = state.select("*", *to_self, *no_sums)

    def message(rows: DataFrame, to: str, values: dict) -> DataFrame:
        return rows.select(*(
            F.col(to).alias("key") if c == "key" else values.get(c, F.lit(None)).cast(t).alias(c) for c, t in own_part.dtypes
        ))

    leaf, to_parent = F.col("n_below") == 0, state.where("parent IS NOT NULL")
    sums = {f"given_{n}": F.when(leaf, F.col(n) + F.col(e)) for n, e in zip(names, extras, strict=True)}
    sums |= {f"under_{n}": F.when(~leaf, F.col(e)) for n, e in zip(names, extras, strict=True)}
    upward = message(to_parent, "parent", {"under_heads": F.when(~leaf, F.col("heads")), "n_inner": F.when(leaf, 0).otherwise(1), **sums})
    carried = {f"more_{n}": F.col(n) + F.col(e) for n, e in zip(names, extras, strict=True)}
    downward = message(state.where("heads"), "child", {"over_heads": F.lit(True), "above": F.col("parent"), **carried})
    told = own_part.unionAll(upward).unionAll(downward).groupBy("key").agg(
        *(F.max(c).alias(c) for c in ["parent", *names, *extras, "n_below", "child", "heads", "under_heads", "over_heads", "above", *under, *more]),
        F.sum("n_inner").alias("n_inner"), *(F.sum(c).alias(c) for c in given),
    )
    raked = F.col("n_below") == 0
    spliced = F.col("heads") & (F.col("n_inner") == 1) & ~F.col("under_heads")
    moved = F.coalesce("over_heads", F.lit(False)) & ~raked & ~F.col("heads")
    return told.select(
        "key", F.when(moved, F.col("above")).otherwise(F.col("parent")).alias("parent"), "child",
        *(added(n, f"given_{n}").alias(n) for n in names),
        *((F.col(e) + F.when(moved, F.col(f"more_{n}")).otherwise(0)).alias(e) for n, e in zip(names, extras, strict=True)),
        raked.alias("raked"), F.coalesce(spliced, F.lit(False)).alias("spliced"),
        *((F.col(n) + F.col(f"under_{n}")).alias(f"handed_{n}") for n in names),
    )


def expanded(spliced: DataFrame, raked: DataFrame, names: list[str], scratch: Scratch) -> DataFrame:
    """Totals of the nodes that left chains: what each handed over, added up along the children.

    A child that was raked has its total; one that left later hands on in turn. Ways of children
    are halved by joining them to themselves.
    """
    ways = scratch.table(spliced)
    while True:
        on = ways.select(F.col("key").alias("child"), F.col("child").alias("next"), *(F.col(n).alias(f"on_{n}") for n in names))
        ways = scratch.table(ways.join(on, "child", "left").select(
            "key", F.coalesce("next", "child").alias("child"), *(added(n, f"on_{n}").alias(n) for n in names),
            F.col("next").isNotNull().alias("further"),
        ))
        if not ways.where("further").limit(1).count():
            break
    ends = raked.withColumnsRenamed({"key": "child", **{n: f"end_{n}" for n in names}})
    return ways.join(ends, "child").select("key", *((F.col(n) + F.col(f"end_{n}")).alias(n) for n in names))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): SHA-256 of the ascending ids, joined by commas.

    Ids are sorted by ranges; the ids that a range has of a node become one piece of text. A node's
    pieces are then hashed one after the other in their order, so that no node's ids are ever held
    together.
    """
    ranged = ends.repartitionByRange("conv_id").withColumn("range", F.spark_partition_id())
    ids = F.array_sort(F.collect_list("conv_id"))
    pieces = ranged.groupBy("key", "range").agg(ids.alias("ids")).select(
        "key", F.get("ids", F.lit(0)).alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece")
    )
    return pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "piece").mapInArrow(
        hashed_in_order, "key binary, ends_sha256 string"
    )


def hashed_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its pieces, which come one after the other."""

    def batch(keys: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])

    last, running = None, None
    for rows in batches:
        keys, digests = [], []
        for key, piece in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            if key == last:
                running.update(b"," + piece.encode())
                continue
            if running:
                keys.append(last)
                digests.append(running.hexdigest())
            last, running = key, hashlib.sha256(piece.encode())
        yield batch(keys, digests)
    if running:
        yield batch([last], [running.hexdigest()])


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over the turns that ``digested`` gives.

    ``conversations`` has every ``conv_id`` once, also those without a turn. Columns: key, parent,
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that sharing the subtree's prefixes saves), ends_sha256.
    """
    members = materialise(prefixes(turns))
    everyone = conversations.select("conv_id")
    figures = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes")]
    inner = members.groupBy("key").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), *figures)
    top = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"),
    )
    nodes = materialise(top.unionByName(inner))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", added("n_children"))
    own = nodes.select(
        "key", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    last = members.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("last"))
    ends = everyone.join(last, "conv_id", "left").select(F.coalesce("last.key", F.lit(ROOT)).alias("key"), "conv_id")
    with_ends = nodes.join(totals, "key").join(ends_digest(ends), "key", "left")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = lookup(with_ends, above, ["parent"], ["key"])
    nobody = hashlib.sha256(b"").hexdigest()
    return found.select(
        "key", "parent", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
