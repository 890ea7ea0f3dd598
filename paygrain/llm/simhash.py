"""Near-duplicates by SimHash: fingerprints, links at few differing bits, groups.

Links are found by a self-join of binary tries. Documents with equal fingerprints are one leaf.
Two 64-bit fingerprints that differ in at most ``max_bits`` bits agree in one of ``max_bits + 1``
blocks, so the fingerprints are dealt to tasks once per block, by the value of that block; each
task builds the tries of its blocks from the sorted fingerprints and walks them against
themselves. A walk takes pairs of nodes, counts the differing bits of the prefixes they have in
common, drops pairs beyond ``max_bits``, and opens the shallower node of the rest until both are
leaves. Pairs of nodes are numpy arrays, worked off in portions of bounded size.

A block value that more than ``max_trie`` fingerprints share is cut by its next bits: every two
subtrees whose next bits differ in no more than ``max_bits`` become a task of their own. Tasks
return links of spanning trees, never all pairs, and the links are joined to groups by passing on
the smallest label until nothing changes.

Defined cases: a null text, and one without words, has the fingerprint zero and is linked like
any other; a text shorter than a shingle is one shingle; a null ``doc_id`` never names a group
that has another id; an empty table gives an empty result; other columns keep their values, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from paygrain.llm.common import free_name, lookup, text_of
from paygrain.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BITS = 64
MAX_TRIE = 1 << 16
MOST_SPLIT_BITS = 12
BROADCAST_ROWS = 100_000
PORTION = 1 << 20  # pairs of nodes that a walk opens at a time
HASHED_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a whole text as an unsigned integer."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and white space \x20, \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = min(shingle_words, len(words)) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - first].tolist()
    ends = ends[first:].tolist()
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHED_AT_ONCE):
        spans = zip(starts[at : at + HASHED_AT_ONCE], ends[at : at + HASHED_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprint_of(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a long (its bits, signed)."""

    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return simhash(text_of(text))


class Tries:
    """Binary tries over sorted distinct keys, one per cell, as arrays of nodes.

    Node ``i`` below ``len(keys) - 1`` is the branch between the neighbours ``i`` and ``i + 1``;
    the leaves follow. ``depth`` is the number of leading bits that all leaves of a node share.
    """

    def __init__(self, cells: np.ndarray, keys: np.ndarray) -> None:
        self.leaf0 = max(len(keys) - 1, 0)
        same_cell = cells[1:] == cells[:-1]
        shared = BITS - bit_length(keys[1:] ^ keys[:-1])
        self.depth = np.concatenate([np.where(same_cell, shared, -1), np.full(len(keys), BITS)]).astype(np.int16)
        self.key = np.concatenate([keys[:-1], keys])
        self.left, self.right, self.roots = self.branches()

    def branches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        leaf0, depth = self.leaf0, self.depth[: self.leaf0].tolist()
        left, right, roots, path = [0] * leaf0, [0] * leaf0, [], []
        for i, d in enumerate(depth):
            if d < 0:
                roots += path[:1]
                path = []
                continue
            last = leaf0 + i
            while path and depth[path[-1]] > d:
                last = path.pop()
            left[i], right[i] = last, leaf0 + i + 1
            if path:
                right[path[-1]] = i
            path.append(i)
        roots += path[:1]
        return np.array(left, np.int64), np.array(right, np.int64), np.array(roots, np.int64)

    def close_leaves(self, a: np.ndarray, b: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Walk the given pairs of nodes together; yield pairs of leaves within ``max_bits``."""
        open_pairs = [(a, b)]
        while open_pairs:
            a, b = open_pairs.pop()
            if len(a) > PORTION:
                middle = len(a) // 2
                open_pairs += [(a[:middle], b[:middle]), (a[middle:], b[middle:])]
                continue
            own = a == b
            node, a, b = a[own & (a < self.leaf0)], a[~own], b[~own]
            common = np.minimum(self.depth[a], self.depth[b])
            differing = np.bitwise_count((self.key[a] ^ self.key[b]) >> (BITS - common).astype(np.uint64))
            near = differing <= max_bits
            a, b, common = a[near], b[near], common[near]
            leaves = common == BITS
            if leaves.any():
                yield a[leaves] - self.leaf0, b[leaves] - self.leaf0
            a, b = a[~leaves], b[~leaves]
            swap = self.depth[a] > self.depth[b]  # the shallower node is opened
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            low, high = self.left[node], self.right[node]
            a, b = (
                np.concatenate([self.left[a], self.right[a], low, high, low]),
                np.concatenate([b, b, low, high, high]),
            )
            if len(a):
                open_pairs.append((a, b))


def bit_length(values: np.ndarray) -> np.ndarray:
    """Bits up to the highest one that is set."""
    filled = values.copy()
    for step in (1, 2, 4, 8, 16, 32):
        filled |= filled >> np.uint64(step)
    return np.bitwise_count(filled).astype(np.int16)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked leaves the smallest label of their group, in place."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label[:] = label[label]


def links_of(cells: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning links of the fingerprints within ``max_bits``, cell by cell.

    ``cells`` has the columns table, block, low, high (the cell; ``low == high``: one subtree
    against itself), key (the fingerprint with the block turned to the front) and fingerprint.
    """
    names = ["table", "block", "low", "high"]
    key = cells["key"].to_numpy().view(np.uint64)
    order = np.lexsort((key, *(cells[n].to_numpy() for n in reversed(names))))
    cells, key = cells.iloc[order], key[order]
    change = np.zeros(len(key), dtype=bool)
    for n in names:
        value = cells[n].to_numpy()
        change[1:] |= value[1:] != value[:-1]
    tries = Tries(np.cumsum(change), key)
    root = tries.roots
    own = cells["low"].to_numpy()[root] == cells["high"].to_numpy()[root]
    # Two subtrees in a cell part at its root; where only one has leaves it shares the next bits.
    both = ~own & (tries.depth[root] < cells["split"].to_numpy()[root])
    a = np.concatenate([root[own], tries.left[root[both]]])
    b = np.concatenate([root[own], tries.right[root[both]]])
    label, waiting, size = np.arange(len(key)), [], 0
    for pair in tries.close_leaves(a, b, max_bits):
        waiting.append(pair)
        size += len(pair[0])
        if size >= PORTION:
            unite(label, *map(np.concatenate, zip(*waiting, strict=True)))
            waiting, size = [], 0
    if waiting:
        unite(label, *map(np.concatenate, zip(*waiting, strict=True)))
    value = cells["fingerprint"].to_numpy()
    linked = label != np.arange(len(key))
    return pd.DataFrame({"a": value[linked], "b": value[label[linked]]})


def turned(value: Column, bits: int) -> Column:
    """``value`` with its leading ``bits`` moved to the end."""
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, BITS - bits))


def cells_of(distinct: DataFrame, max_bits: int, max_trie: int) -> DataFrame:
    """Every fingerprint once per block, and in crowded blocks once per pair of subtrees."""
    tables = max_bits + 1
    width = BITS // tables
    keys = F.array(*(F.struct(F.lit(t).alias("table"), turned(F.col("fingerprint"), t * width).alias("key")) for t in range(tables)))
    rows = distinct.select("fingerprint", F.explode(keys).alias("at")).select("fingerprint", "at.*")
    rows = rows.withColumn("block", F.shiftrightunsigned("key", BITS - width))
    crowded = rows.groupBy("table", "block").agg(F.count("*").alias("n")).where(F.col("n") > max_trie)
    more = F.least(F.ceil(F.log2(F.col("n") / max_trie)) + 1, F.lit(min(MOST_SPLIT_BITS, BITS - width)))
    crowded = materialise(crowded.select("table", "block", more.cast("int").alias("more")))
    n_crowded = crowded.count()
    if n_crowded <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    rows = rows.join(crowded, ["table", "block"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
    subtree = F.expr(f"CASE WHEN more = 0 THEN 0L ELSE shiftrightunsigned(shiftleft(key, {width}), {BITS} - more) END")
    flips = F.filter(
        F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, more) - 1")), lambda m: F.bit_count(m) <= max_bits
    )
    rows = rows.withColumn("subtree", subtree).withColumn("flip", F.explode(flips))
    other = F.col("subtree").bitwiseXOR(F.col("flip"))
    return rows.select(
        "table", "block", F.least("subtree", other).alias("low"), F.greatest("subtree", other).alias("high"),
        (F.lit(width) + F.col("more")).alias("split"), "key", "fingerprint",
    )


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, max_trie: int = MAX_TRIE) -> DataFrame:
    """(a, b): links whose connected parts are those of all pairs within ``max_bits``."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield links_of(pd.concat(parts, ignore_index=True), max_bits)

    cells = cells_of(distinct, max_bits, max_trie).repartition("table", "block", "low", "high")
    return cells.mapInPandas(join, "a long, b long").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(fingerprint, root) for every fingerprint that has a link."""
    links = materialise(links)
    both = links.unionAll(links.select("b", "a").toDF("a", "b"))
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("node"), F.least("a", "near").alias("root"))
    )
    while True:
        # The smallest root among the neighbours, then the root of that root.
        seen = lookup(both, labels.select(F.col("node").alias("b"), F.col("root").alias("theirs")), ["b"], ["a"])
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("nearest"))
        closer = labels.join(nearest, "node").select("node", F.col("root").alias("was"), F.least("root", "nearest").alias("root"))
        closer = materialise(closer)
        hop = closer.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        after = lookup(closer, hop, ["root"], ["node"])
        after = materialise(after.select("node", "was", F.coalesce("beyond", "root").alias("root")))
        if not after.where("was <> root").limit(1).count():
            return after.select(F.col("node").alias("fingerprint"), "root")
        labels = after.drop("was")


def grouped(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, max_trie: int = MAX_TRIE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_hash, fingerprint) per document, (fingerprint, root) and (root, first) per group.

    ``first`` is the smallest (doc_id, text_hash) of the group, ids that are null last.
    """
    text_hash = F.xxhash64(text_of(F.col("text"))).alias("text_hash")
    marked = materialise(
        docs.select("doc_id", text_hash, fingerprint_of(F.col("text"), shingle_words).alias("fingerprint"))
    )
    pair = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min(pair).alias("first")))
    roots = connected(near_links(distinct.select("fingerprint"), max_bits, max_trie))
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = materialise(rooted)
    return marked, rooted.select("fingerprint", "root"), rooted.groupBy("root").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id), one row per document.

    ``text_hash`` (XXH64 of the text) tells rows with one ``doc_id`` apart; ``fingerprint`` is 16
    hex digits; ``component_id`` is the smallest ``doc_id`` that links lead to.
    """
    marked, rooted, first = grouped(docs, **how)
    smallest = first.select("root", F.col("first.doc_id").alias("component_id"))
    groups = lookup(rooted, smallest, ["root"], ["fingerprint"])
    found = lookup(marked, groups.select("fingerprint", "component_id"), ["fingerprint"], ["doc_id", "text_hash"])
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", "text_hash", hexed.alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, **how) -> DataFrame:
    """One row of ``docs`` per group: that with the smallest id, of equal ids the smallest text hash.

    A group without ids keeps the row with the smallest text hash.
    """
    _, _, first = grouped(docs, **how)
    own, id_name, hash_name = (free_name(docs, wish) for wish in ("own__", "stay__", "hash__"))
    stay = first.select(F.col("first.doc_id").alias(id_name), F.col("first.text_hash").alias(hash_name))
    kept = docs.withColumn(own, F.xxhash64(text_of(F.col("text")))).join(
        stay, F.col("doc_id").eqNullSafe(F.col(id_name)) & (F.col(own) == F.col(hash_name)), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", own]).select(*docs.columns)
