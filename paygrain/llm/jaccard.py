"""Exact Jaccard join of documents on word shingles, in the metric space of shingle sets.

Sets that link at similarity t differ in at most ``(100 - t) / (100 + t)`` of the sum of their
sizes, counted as elements of one set alone. That count is a metric, and so is the Jaccard
distance ``1 - similarity``; everything below rests on their triangle inequalities.

*Regions.* Copies of a set are one class. Classes that link share a twentieth of their elements among
the first quarter of them, in an order that all sets use: shared by many texts last, otherwise by
hash. The holders of such an element, cut by windows of size, elect a pivot, and a class joins the
regions of its pivots, if it has elements enough that others hold. (Which elements count as shared by many is counted on all texts and bounded in number;
it decides the order only, any choice gives the same links.)

*In a region* every set is taken relative to the pivot: what it lacks and what it adds. Members
within the threshold of the pivot are linked to it. Two members whose differences from the pivot
share nothing are as far apart as the sum of their distances, and link only if both are within the
threshold of the pivot; so only members that differ from it in a common element are joined on.
There further pivots cut the region into Voronoi cells; a cell also gets the members from other cells
whose distance to its pivot exceeds that to their own by twice the threshold at most, which by
the triangle inequality are all that can link into it, and is joined the same way. Cells
whose members are connected already are left alone; small cells, and those that pivots do not make
smaller, compare each member not yet connected with all.

*Large regions* are dealt in portions, each with the pivot. What their members then differ in makes
the elements of a second round of regions, with fewer members and much smaller sets; those that
hold nothing unconnected are dropped, and one that is still larger than a portion is joined by pairs
of half portions. So no task holds more than ``PORTION`` sets, and no group is written as pairs: a
region returns one link per member, such that links connect what all pairs would.

Defined cases: null texts and texts without words have no shingles and link with nothing, not even
with each other; fewer words than a shingle are one shingle; a component is named by its smallest
``doc_id`` that is not null; repeated rows are members each; an empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.llm.common import Scratch, lookup, text_of
from paygrain.llm.simhash import connected
from paygrain.session import materialise

SHINGLE_WORDS, PERCENT = 5, 80
MOST_SHARED = 1 << 18  # elements that are put last, the most frequent ones: 2 MB of hashes
COUNTED_AT_ONCE = 1 << 21
PORTION = 4096  # sets of a region that one task holds
CELL = 48  # members that are compared with one another
PIVOTS = 6
KNOWN_WORDS = 1 << 17
MARK_BITS = 1 << 23
FEWER = 20  # linked sets share a twentieth of their number of shingles among their first elements
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]


class WordHashes(dict):
    """64-bit hashes of words, kept while there are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, known: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a whole text as ascending 64-bit hashes."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and white space \x20, \x09-\x0D
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    count = max(n - width + 1, 1)
    mixed = np.full(count, min(n, width), np.uint64)
    for k in range(min(n, width)):
        mixed += own[k : k + count] * np.uint64(ODD[k % len(ODD)] + 2 * (k // len(ODD)))
        mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(ODD[0])
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def close(apart: np.ndarray | int, sizes: np.ndarray | int, percent: int) -> np.ndarray | bool:
    """Whether sets with ``apart`` elements in one of them alone, and so many in sum, link."""
    return (100 + percent) * apart <= (100 - percent) * sizes


def shared_by_many(docs: DataFrame, width: int, most: int = MOST_SHARED) -> np.ndarray:
    """The hashes of up to ``most`` of the shingles that most texts have, ascending."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, waiting, size = WordHashes(), set(), [], 0

        def often() -> pa.RecordBatch:
            value, count = np.unique(np.concatenate(waiting), return_counts=True)
            value, count = value[count > 2], count[count > 2]
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], ["h", "n"])

        for batch in batches:
            for text in batch.column(0):
                own = shingles(text.as_py(), known, width)
                mark = xxhash.xxh64_intdigest(own.tobytes())
                if mark in seen:
                    continue  # a copy
                seen.add(mark)
                waiting.append(own)
                size += len(own)
                if size >= COUNTED_AT_ONCE:
                    yield often()
                    seen, waiting, size = set(), [], 0
        if waiting:
            yield often()

    counts = docs.select(docs["text"].cast("string")).mapInArrow(counted, "h long, n long")
    top = counts.groupBy("h").agg(F.sum("n").alias("n")).where("n >= 8").orderBy(F.desc("n"), "h").limit(most)
    found = np.array([r.h for r in top.select("h").collect()], dtype=np.int64)
    return np.sort(found.view(np.uint64))


def in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in an ascending table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    return table[np.minimum(at, len(table) - 1)] == values


def least_shared(n: int) -> int:
    """How many of their first elements two linked sets of at least n shingles share."""
    return max(1, n // FEWER)


def signatures(docs: DataFrame, width: int, percent: int, shared: np.ndarray) -> DataFrame:
    """doc_id, text_key, n, digest of the set, and its first elements: rare ones, then shared ones."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sizes, digests, rare, often, rank = [], [], [], [], []
            for text in batch.column(2):
                own = shingles(text.as_py(), known, width)
                n = len(own)
                many = in_sorted(own, shared)
                first = n - -(-percent * n // 100) + least_shared(n) if n else 0
                cold, hot = own[~many][:first], own[many]
                sizes.append(n)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                rare.append(cold.view(np.int64))
                often.append(hot[: first - len(cold)].view(np.int64))
                rank.append(1000 - 1000 * len(hot) // max(n, 1))
            columns = [
                batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                pa.array(rare, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64())), pa.array(rank, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n", "digest", "rare", "often", "rank"])

    rows = docs.select("doc_id", F.xxhash64(text_of(docs["text"])).alias("text_key"), text_of(docs["text"]).alias("text"))
    schema = f"doc_id {kind}, text_key long, n int, digest binary, rare array<long>, often array<long>, rank int"
    return rows.mapInArrow(signed, schema)


def size_window(n: np.ndarray, percent: int) -> np.ndarray:
    """Sets that link have the same window or neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def elected(percent: int):
    """(id, pivot, hits, pivot_hits) of postings (h, id, sized): one pivot for each element and window of sizes.

    One row per class and pivot other than itself. The sum of a class's ``hits`` and, where it is the
    pivot, ``pivot_hits`` is the number of its elements here that others hold: an element counts
    once, in one of its windows. So an element of s holders makes s - 1 rows in a window at most.
    """

    def elect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        h, who, sized = (np.concatenate(c) for c in zip(*parts, strict=True))
        n, short = sized >> 1, sized & 1
        window = size_window(n, percent)
        # The longer of two sets is also in the window below its own; only an own one can be the shorter.
        short = np.concatenate([short, np.zeros_like(short)])
        posting = np.tile(np.arange(len(h)), 2)
        h, who, window = np.tile(h, 2), np.tile(who, 2), np.concatenate([window, window - 1])
        order = np.lexsort((who, window, h))
        h, who, window, short, posting = h[order], who[order], window[order], short[order], posting[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (window[1:] != window[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(h)))
        useful = (size > 1) & (np.add.reduceat(short, start) > 0)
        keep = np.repeat(useful, size)
        if not keep.any():
            return
        who, pivot, leads = who[keep], np.repeat(who[start[useful]], size[useful]), new[keep]
        counted = np.zeros(len(who), np.int64)
        counted[np.unique(posting[keep], return_index=True)[1]] = 1
        # What the pivot, the first of its window, has counted goes with the row of the second.
        of_pivot = np.zeros(len(who), np.int64)
        of_pivot[1:] = counted[:-1] * leads[:-1]
        columns = [c[~leads] for c in (who, pivot, counted, of_pivot)]
        order = np.lexsort(columns[1::-1])
        who, pivot, counted, of_pivot = (c[order] for c in columns)
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (pivot[1:] != pivot[:-1])
        start = np.flatnonzero(new)
        columns = [who[new], pivot[new], np.add.reduceat(counted, start), np.add.reduceat(of_pivot, start)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "pivot", "hits", "pivot_hits"])

    return elect


def regions_of(classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(id, pivot): the classes of each region."""
    fewer = F.greatest(F.lit(1), F.floor(F.col("n") / FEWER))
    index = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + fewer
    sized = (2 * F.col("n") + F.when(F.col("at") < index, 1).otherwise(0)).cast("long")
    rare = classes.select("id", "n", F.posexplode("rare").alias("at", "h")).select("h", "id", sized.alias("sized"))
    found = rare.repartition("h").mapInArrow(elected(percent), "id long, pivot long, hits long, pivot_hits long")
    # Shared elements have long postings; their pivot is counted in the tasks first. The rank
    # favours sets made of shared elements, which are in the middle of large groups.
    often = classes.select("id", "n", "rank", (F.size("rare")).alias("before"), F.posexplode("often").alias("at", "h"))
    often = often.withColumn("at", F.col("at") + F.col("before")).withColumn("sized", sized)
    window = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + 1e-9).cast("long")
    both = F.explode(F.array(window, window - 1))
    often = often.withColumn("own", window).withColumn("window", both)
    short = F.when(F.col("own") == F.col("window"), F.col("sized").bitwiseAND(F.lit(1).cast("long"))).otherwise(0)
    chosen = often.groupBy("h", "window").agg(F.min(F.struct("rank", "id")).alias("best"), F.count("*").alias("size"), F.sum(short).alias("short"))
    chosen = chosen.where("size > 1 AND short > 0").select("h", "window", F.col("best.id").alias("pivot"))
    joined_ = often.join(chosen, ["h", "window"])
    # An element may be held in two windows; counting it twice lets some more classes through.
    shared = joined_.groupBy("id", "pivot").agg(F.count("*").alias("hits")).withColumn("pivot_hits", F.lit(0).cast("long"))
    found = scratch.table(found.unionByName(shared))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.lit(percent) * F.col("n") / 100) / FEWER))
    hits = found.select("id", "hits").unionAll(found.where("pivot_hits > 0").select("pivot", "pivot_hits"))
    hits = hits.groupBy("id").agg(F.sum("hits").alias("hits"))
    alive = scratch.table(hits.join(classes.select("id", "n"), "id").where(F.col("hits") >= least).select("id"))
    pairs = found.where("id <> pivot").select("id", "pivot").distinct().join(alive, "id")
    # A region of one class and a pivot that itself links with nothing is none.
    sizes = pairs.groupBy("pivot").agg(F.count("*").alias("members"))
    sizes = sizes.join(alive.select(F.col("id").alias("pivot"), F.lit(True).alias("own")), "pivot", "left")
    return pairs.join(sizes.where("members > 1 OR own").select("pivot"), "pivot").select("id", "pivot")


def relative(own: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """The elements of one of two ascending sets alone, first those of ``own``."""
    return np.concatenate([own[~in_sorted(own, pivot)], pivot[~in_sorted(pivot, own)]])


class Region:
    """Sets of one region, relative to its pivot, and which of them are connected."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, percent: int) -> None:
        """``sizes`` are those of the whole sets; equal ``label`` (an index of a member): connected."""
        self.sizes, self.label, self.percent = sizes, label, percent
        self.apart0 = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, code = np.unique(flat, return_inverse=True)
        self.codes = np.split(code, np.cumsum(self.apart0)[:-1])
        self.n_codes = int(code.max(initial=-1)) + 1

    def apart(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Elements that the pivot or the member has alone."""
        mask = np.zeros(self.n_codes, bool)
        mask[self.codes[pivot]] = True
        sizes = self.apart0[members]
        flat = mask[np.concatenate([self.codes[m] for m in members])] if len(members) else np.zeros(0, bool)
        total = np.concatenate([[0], np.cumsum(flat)])
        ends = np.cumsum(sizes)
        common = total[ends] - total[ends - sizes]
        return self.apart0[pivot] + sizes - 2 * common

    def link(self, pivot: int, members: np.ndarray, apart: np.ndarray) -> None:
        near = members[close(apart, self.sizes[members] + self.sizes[pivot], self.percent)]
        names = np.unique(self.label[near])
        if len(names) > 1:
            self.label[np.isin(self.label, names)] = names[0]

    def join(self, members: np.ndarray) -> None:
        """Connect all members that link, directly or not."""
        names, count = np.unique(self.label[members], return_counts=True)
        if len(names) < 2:
            return
        if len(members) > CELL:
            cells = self.cells(members)
            held = [len(c) for c in cells]
            if sum(held) <= 2 * len(members) and 4 * max(held) <= 3 * len(members):
                for cell in cells:
                    self.join(cell)
                return
        main = names[count.argmax()]
        for m in members[self.label[members] != main].tolist():
            rest = members[self.label[members] != self.label[m]]
            sums = self.sizes[rest] + self.sizes[m]
            # By their sizes and their distances from the region's pivot, which bound theirs from below.
            least = np.maximum(np.abs(self.sizes[rest] - self.sizes[m]), np.abs(self.apart0[rest] - self.apart0[m]))
            rest = rest[close(least, sums, self.percent)]
            self.link(m, np.append(rest, m), np.append(self.apart(m, rest), 0))

    def cells(self, members: np.ndarray) -> list[np.ndarray]:
        """Voronoi cells of some pivots, each with the members near enough to link into it."""
        names, count = np.unique(self.label[members], return_counts=True)
        loose = members[self.label[members] != names[count.argmax()]]
        pivots, far = [], np.full(len(loose), np.inf)
        distances = []
        while len(pivots) < min(PIVOTS, len(loose)):
            pivot = int(loose[far.argmax()])
            apart = self.apart(pivot, members)
            self.link(pivot, members, apart)
            sizes = self.sizes[members] + self.sizes[pivot]
            distance = 2 * apart / (sizes + apart)
            pivots.append(pivot)
            distances.append(distance)
            far = np.minimum(far, distance[np.isin(members, loose)])
        table = np.array(distances)
        nearest = table.argmin(axis=0)
        own = table.min(axis=0)
        window = 2 * (100 - self.percent) / 100 + 1e-9
        made = []
        for k in range(len(pivots)):
            core = nearest == k
            if not core.any():
                continue
            reach = table[k][core].max() + window / 2
            made.append(members[core | ((table[k] <= own + window) & (table[k] <= reach))])
        return made


def spanning(ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link per member that is connected to another."""
    linked = label != np.arange(len(ids))
    return ids[linked], ids[label[linked]]


OUT = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("region", pa.binary()), ("n", pa.int64()), ("label", pa.int64()), ("elements", pa.list_(pa.int64())),
])
OUT_SCHEMA = "a long, b long, region binary, n long, label long, elements array<long>"


def labelled(label: int | None, near: bool, pivot: int) -> int | None:
    return int(pivot) if label is None and near else label


def joined_regions(percent: int, from_text: int | None):
    """Join the regions of a partition that is sorted by region and portion, one after the other.

    Rows are (region, portions, portion, id, pivot, label, n, elements or text); where none is the
    pivot, one that is not connected serves as such. A region in one portion returns links. One in more returns the links to its pivot, and the members' elements
    relative to it with a label: equal ones are connected.
    """

    def solve(rows: list[tuple], known: WordHashes) -> Iterator[pa.RecordBatch]:
        rows = list({row[3]: row for row in rows}.values())  # repeated rows of a text
        if len(rows) < 2:
            return
        region, portions = rows[0][0], rows[0][1]
        ids = np.array([r[3] for r in rows], dtype=np.int64)
        if from_text is None:
            sets = [np.sort(np.array(r[7].as_py(), dtype=np.int64).view(np.uint64)) for r in rows]
            sizes = np.array([r[6] for r in rows], dtype=np.int64)
        else:
            sets = [shingles(r[7].as_py(), known, from_text) for r in rows]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
        pivot = max(range(len(rows)), key=lambda i: (rows[i][4], rows[i][5] is None))
        moved = [relative(s, sets[pivot]) for s in sets]
        apart = np.array([len(m) for m in moved], dtype=np.int64)
        near = close(apart, sizes + sizes[pivot], percent)
        near[pivot] = True
        if portions > 1:
            far = [i for i in range(len(rows)) if i != pivot]
            a, b = ids[near], np.full(int(near.sum()), ids[pivot])
            yield batch(a, b)
            where = hashlib.blake2b(region + ids[pivot].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_pylist([
                {"a": int(ids[i]), "b": None, "region": where, "n": int(sizes[i]), "label": labelled(rows[i][5], near[i], ids[pivot]), "elements": moved[i].view(np.int64).tolist()}
                for i in far
            ], OUT)
            return
        first: dict[int, int] = {}
        label = np.array([i if r[5] is None else first.setdefault(r[5], i) for i, r in enumerate(rows)])
        label[np.isin(label, label[near])] = pivot
        if len(rows) > 2 and (label != pivot).any():
            group = Region(moved, sizes, label, percent)
            group.join(np.arange(len(rows)))
            label = group.label
        yield batch(*spanning(ids, label))

    def batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        nothing = [pa.nulls(n, f.type) for f in list(OUT)[2:]]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *nothing], schema=OUT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, last = WordHashes(), [], None
        for given in batches:
            # Texts and elements stay in the batch until their region is worked on.
            for row in zip(*(c.to_pylist() for c in given.columns[:-1]), given.columns[-1], strict=True):
                if (row[0], row[2]) != last and rows:
                    yield from solve(rows, known)
                    rows = []
                last = (row[0], row[2])
                rows.append(row)
        if rows:
            yield from solve(rows, known)

    return work


def in_portions(members: DataFrame, pivots: DataFrame, portion_size: int) -> DataFrame:
    """Members (region, id, ...) and one pivot row per region, in every portion of it."""
    counted = members.groupBy("region").agg(F.ceil(F.count("*") / F.lit(portion_size)).cast("int").alias("portions"))
    dealt = members.withColumn("pivot", F.lit(False)).join(counted, "region")
    dealt = dealt.withColumn("portion", F.pmod(F.xxhash64("id"), F.col("portions")).cast("int"))
    every = pivots.withColumn("pivot", F.lit(True)).join(counted, "region")
    every = every.withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
    return dealt.unionByName(every)


def worked(rows: DataFrame, percent: int, from_text: int | None, scratch: Scratch) -> DataFrame:
    last = "text" if from_text is not None else "elements"
    rows = rows.select("region", "portions", "portion", "id", "pivot", "label", "n", last)
    placed = rows.repartition("region", "portion").sortWithinPartitions("region", "portion")
    return scratch.table(placed.mapInArrow(joined_regions(percent, from_text), OUT_SCHEMA))


def later_regions(rest: DataFrame, percent: int, portion_size: int) -> DataFrame:
    """Regions of members that differ from a pivot in the same element and are not known to be connected.

    By the triangle inequality two members that link have all but ``n * (100 - t) / t`` of the
    elements in common in which one of n shingles differs from the pivot. So they share one of the
    first so many and one; what members add to the pivot, which is rarer, comes first.
    """
    rest = rest.select(F.col("a").alias("id"), "region", "n", "label", "elements")
    first = F.floor(F.col("n") * F.lit(100 - percent) / F.lit(percent) + 1e-9).cast("int") + 1
    own = rest.withColumn("element", F.explode(F.slice("elements", F.lit(1), first)))
    name = F.coalesce("label", "id")
    name = F.coalesce("label", "id")
    wanted = own.groupBy("region", "element").agg(F.min(name).alias("low"), F.max(name).alias("high"), F.count("*").alias("size"))
    parts = F.when(F.col("size") <= portion_size, 1).otherwise(F.ceil(2 * F.col("size") / F.lit(portion_size)))
    wanted = wanted.where("low <> high").select("region", "element", parts.cast("int").alias("parts"))
    members = own.join(wanted, ["region", "element"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    names = [F.col("element"), F.least("part", "other"), F.greatest("part", "other")]
    place = F.md5(F.concat("region", F.concat_ws(",", *(c.cast("string") for c in names)).cast("binary")))
    members = members.withColumn("region", F.unhex(place)).drop("element", "parts", "part", "other")
    return members.withColumns({"portions": F.lit(1), "portion": F.lit(0), "pivot": F.lit(False)})


def marked(key: Column, held: DataFrame) -> Column:
    """False for most keys that ``held`` does not have: texts that no region needs are not moved.

    One bit for each remainder of a key, 1 MB whatever the number of keys.
    """

    def word(k: Column) -> Column:
        return F.shiftright(F.pmod(k, F.lit(MARK_BITS)), 6).cast("int")

    def bit(k: Column) -> Column:
        return F.pmod(k, F.lit(64)).cast("int")

    own = F.col("own_key")
    ones = held.select(word(own).alias("word"), F.expr("shiftleft(1L, CAST(pmod(own_key, 64) AS INT))").alias("bits"))
    words = held.sparkSession.range(MARK_BITS // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = words.unionByName(ones).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("all"))
    table = table.select(F.transform("all", lambda w: w["bits"])).scalar()
    return F.getbit(F.element_at(table, word(key) + 1), bit(key)) == 1


def jaccard_links(
    docs: DataFrame, classes: DataFrame, scratch: Scratch, width: int, percent: int, portion_size: int
) -> DataFrame:
    """(a, b): links between classes whose connected parts are those of all links."""
    pairs = scratch.table(regions_of(classes, percent, scratch))
    region = F.col("pivot").cast("string").cast("binary").alias("region")
    pivots = pairs.select("pivot").distinct().select(region, F.col("pivot").alias("id"))
    placed = in_portions(pairs.select(region, "id"), pivots, portion_size)
    held = placed.select("id").distinct().join(classes.select("id", "doc_id", "text_key"), "id")
    held = scratch.table(held.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"}))
    texts = docs.select("doc_id", text_of(docs["text"]).alias("text")).withColumn("text_key", F.xxhash64("text"))
    texts = texts.where(marked(F.col("text_key"), held))
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    texts = texts.join(held, same).select("id", "text")
    rows = placed.join(texts, "id").withColumns({"label": F.lit(None).cast("long"), "n": F.lit(0).cast("long")})
    found = worked(rows, percent, width, scratch)
    links = [found.where("b IS NOT NULL").select("a", "b")]
    rest = found.where("b IS NULL")
    if rest.limit(1).count():
        links.append(worked(later_regions(rest, percent, portion_size), percent, None, scratch).select("a", "b"))
    return reduce(DataFrame.unionAll, links).where("a <> b").distinct()


def joined(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, portion_size: int = PORTION, most_shared: int = MOST_SHARED
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id), one row per document.

    ``text_key`` (XXH64 of the text) tells rows with one ``doc_id`` apart; ``component_id`` is the
    smallest ``doc_id`` that links lead to.
    """
    with Scratch(docs.sparkSession, "jaccard") as scratch:
        shared = shared_by_many(docs, shingle_words, most_shared)
        signed = scratch.table(signatures(docs, shingle_words, percent, shared))
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n", "rank", "rare", "often")
        classes = signed.where("n > 0").groupBy("digest").agg(F.min(first).alias("first")).select("digest", "first.*")
        classes = scratch.table(classes.withColumn("id", F.monotonically_increasing_id()))
        roots = connected(jaccard_links(docs, classes, scratch, shingle_words, percent, portion_size))
        roots = roots.withColumnRenamed("fingerprint", "id")
        rooted = classes.select("digest", "id", "no_id", "doc_id").join(roots, "id", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "id"))
        named = rooted.groupBy("root").agg(F.min(F.struct("no_id", "doc_id")).alias("first"))
        named = lookup(rooted.select("digest", "root"), named.select("root", F.col("first.doc_id").alias("component_id")), ["root"], ["digest"])
        found = lookup(signed.drop("rare", "often", "rank"), named.select("digest", "component_id"), ["digest"], ["doc_id", "text_key"])
        component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return materialise(found.select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")))
