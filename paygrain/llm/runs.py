"""Periodic runs of words, found on a grammar of each text.

Re-Pair: in rounds, neighbouring symbols that form the same pair at two or more places of a text
become a new symbol; of overlapping pairs the one found more often goes first, and of a symbol
repeated in a row every second pair. All texts of a batch are worked on at once in numpy, each with
rules of its own. A text ends as a short row of symbols, above which a balanced tree of boundaries
is laid.

Every run has a lowest node of that derivation that holds it, and crosses the boundary there: a
nonterminal's two halves, or a boundary of the tree. So the runs that cross each boundary are
computed once per distinct nonterminal, at one of its places, and once per node of the tree. A run
of at least ``max(least, powers * q)`` words with period q repeats ``anchor`` words, q words apart,
right after or right before the boundary; those places give the periods to try, the smallest
first, and each is extended word by word in both directions. What a nonterminal has is carried
to all places it derives, going down the rules only where there is something to carry. There each
interval is extended to its full length in the text, and equal ones merge.

Defined cases: a null text has no words; a null ``doc_id`` counts as the empty text where ids are
hashed; repeated rows are worked on each; an empty table gives an empty result. Other columns are
not read, whatever their names. Memory is bounded by the longest text, or by ``BATCH_WORDS``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, POWERS = 24, 3
BATCH_WORDS = 1 << 18  # texts are worked on together until they have this many words
Run = tuple[int, int, int]  # start, end, period


def anchor_words(least: int, powers: int) -> int:
    """Words that recur q words on right after or right before a boundary in a run of any period q.

    Let the run have n >= max(least, powers * q) words, x of them before the boundary and y after.
    Where x and y are both at least q, the larger one counts, n / 2 or more. Otherwise one is at
    most q - 1, and of the other all but q words count: n - 2 * q + 1 or more.
    """
    sizes = [(max(least, powers * q), q) for q in range(1, least + 1)]
    return max(1, min(min((n + 1) // 2, n - 2 * q + 1) for n, q in sizes))


class Grammar:
    """Rules of a batch of texts: symbol ``first + r`` is ``left[r] right[r]``, found at ``place[r]``."""

    def __init__(self, words: np.ndarray, text: np.ndarray) -> None:
        """``words`` are the ids of all texts, one after the other, ``text`` the number of each one's text."""
        self.first = int(words.max(initial=-1)) + 1
        self.left, self.right, self.place, self.size = [], [], [], []
        symbol, at, size = words.astype(np.int64), np.arange(len(words)), np.ones(len(words), np.int64)
        done: list[tuple[np.ndarray, ...]] = []
        n_rules = 0
        while len(symbol) > 1:
            taken, pair = self.chosen(self.pairs(symbol, text))
            if not taken.any():
                break
            spot = np.flatnonzero(taken)
            _, some, rule = np.unique(pair[spot], return_index=True, return_inverse=True)
            head = spot[some]
            self.left.append(symbol[head])
            self.right.append(symbol[head + 1])
            self.place.append(at[head])
            self.size.append(size[head] + size[head + 1])
            symbol[spot] = self.first + n_rules + rule
            size[spot] += size[spot + 1]
            n_rules += len(some)
            stay = np.ones(len(symbol), bool)
            stay[spot + 1] = False
            # Texts in which nothing was replaced are finished.
            busy = np.zeros(int(text[-1]) + 1, bool)
            busy[text[spot]] = True
            going = busy[text]
            if not going.all():
                done.append((symbol[~going], text[~going], at[~going], size[~going]))
                stay &= going
            symbol, text, at, size = symbol[stay], text[stay], at[stay], size[stay]
        done.append((symbol, text, at, size))
        joined = [np.concatenate(part) for part in zip(*done, strict=True)]
        order = np.argsort(joined[2], kind="stable")
        self.symbol, self.text, self.at, self.sizes = (part[order] for part in joined)
        empty = [np.zeros(0, np.int64)]
        self.left, self.right, self.place, self.size = (
            np.concatenate(part or empty) for part in (self.left, self.right, self.place, self.size)
        )

    @staticmethod
    def pairs(symbol: np.ndarray, text: np.ndarray) -> np.ndarray:
        """A number for each place's pair, equal for equal pairs of one text; -1 across two texts."""
        width = int(symbol.max()) + 1
        key = symbol[:-1] * width + symbol[1:]
        # Texts lie one behind the other, so a stable sort by key keeps each one's places together.
        order = np.argsort(key, kind="stable")
        key, own = key[order], text[:-1][order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        pair[text[1:] != text[:-1]] = -1
        return pair

    @staticmethod
    def chosen(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose pair is replaced now, and the pairs: repeated, and no overlapping pair goes first."""
        n = len(pair)
        same = np.concatenate([[False], (pair[1:] == pair[:-1]) & (pair[1:] >= 0)])
        start = np.flatnonzero(~same)
        offset = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        # In a row of equal pairs only every second one counts, from the first.
        usable = (pair >= 0) & (offset % 2 == 0)
        count = np.bincount(pair[usable], minlength=n + 1)[pair]
        weight = np.where((pair >= 0) & (count > 1), count * float(n + 1) + (n - pair), -1.0)
        before, after = np.concatenate([[-1.0], weight[:-1]]), np.concatenate([weight[1:], [-1.0]])
        taken = usable & (weight > 0) & (weight >= before) & (weight >= after)
        # A pair that is left at a single place makes no rule; the text's first pair never is.
        spot = np.flatnonzero(taken)
        taken[spot] = np.bincount(pair[spot], minlength=1)[pair[spot]] > 1
        return taken, pair

    def boundaries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, boundary, high) of the balanced trees over the final symbols of all texts."""
        change = np.flatnonzero(np.concatenate([[True], self.text[1:] != self.text[:-1], [True]]))
        i, j = change[:-1], change[1:]
        ends = np.append(self.at, self.at[-1:] + self.sizes[-1:])
        made = []
        while len(i):
            open_ = (j - i > 1) & (ends[j] - self.at[i] >= 2)
            i, j = i[open_], j[open_]
            middle = (i + j) // 2
            made.append((self.at[i], self.at[middle], ends[j]))
            i, j = np.concatenate([i, middle]), np.concatenate([middle, j])
        empty = [np.zeros(0, np.int64)]
        return tuple(np.concatenate(part) for part in zip(*made, strict=True)) if made else tuple(empty * 3)

    def places(self, wanted: np.ndarray) -> dict[int, list[int]]:
        """All places at which the wanted rules are derived, from the final symbols down."""
        n = len(self.left)
        holds = np.zeros(n, bool)
        holds[wanted] = True
        below = [np.where(side >= self.first, side - self.first, -1) for side in (self.left, self.right)]
        for r in range(n):  # rules only use earlier ones
            holds[r] |= any(b[r] >= 0 and holds[b[r]] for b in below)
        rule, at = self.symbol - self.first, self.at
        chosen, found = set(wanted.tolist()), defaultdict(list)
        while len(rule):
            keep = rule >= 0
            rule, at = rule[keep], at[keep]
            keep = holds[rule]
            rule, at = rule[keep], at[keep]
            for r, place in zip(rule.tolist(), at.tolist(), strict=True):
                if r in chosen:
                    found[r].append(place)
            left, right = self.left[rule], self.right[rule]
            half = np.where(left >= self.first, self.size[np.maximum(left - self.first, 0)] if n else 1, 1)
            rule, at = np.concatenate([left, right]) - self.first, np.concatenate([at, at + half])
        return found


def stretch(words: np.ndarray, a: int, b: int, low: int, high: int) -> tuple[int, int]:
    """How many words from ``a`` and ``b`` (a < b) agree going up to ``high``, and going down to ``low``."""
    up, step = 0, 32
    while b + up < high:
        n = min(step, high - b - up)
        differ = words[a + up : a + up + n] != words[b + up : b + up + n]
        first = int(differ.argmax())
        if differ[first]:
            up += first
            break
        up, step = up + n, step * 4
    down, step = 0, 32
    while a - down > low:
        n = min(step, a - down - low)
        differ = (words[a - down - n : a - down] != words[b - down - n : b - down])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            down += first
            break
        down, step = down + n, step * 4
    return up, down


class Anchors:
    """The places of each repeated row of ``width`` words within a text."""

    def __init__(self, words: np.ndarray, text: np.ndarray, width: int) -> None:
        n = max(len(words) - width + 1, 0)
        mixed = words[:n].astype(np.uint64)
        for k in range(1, width):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n].astype(np.uint64)
        inside = text[:n] == text[width - 1 :] if n else np.zeros(0, bool)
        order = np.flatnonzero(inside)
        order = order[np.argsort(mixed[order], kind="stable")]
        key, own = mixed[order], text[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(order)))
        self.order = order
        self.low, self.rank = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        self.size = np.zeros(len(words), np.int64)  # none: the row of words is there once
        self.low[order] = np.repeat(start, size)
        self.size[order] = np.repeat(np.where(size > 1, size, 0), size)

    def like(self, place: int) -> np.ndarray:
        """All places of the row of words at ``place``, ascending."""
        return self.order[self.low[place] : self.low[place] + self.size[place]]


def crossing(words: np.ndarray, anchors: Anchors, width: int, low: int, middle: int, high: int, least: int, powers: int) -> list[Run]:
    """The runs of words[low:high] that cross ``middle``."""
    tried: dict[int, set[int]] = defaultdict(set)  # period to the first ones of places, so far apart, with equal words
    longest = (high - low) // powers
    for place in (middle, middle - width):
        if low <= place <= high - width and anchors.size[place]:
            other = anchors.like(place)
            apart = other - place
            some = (other >= low) & (other <= high - width) & (apart != 0) & (np.abs(apart) <= longest)
            for q in apart[some].tolist():
                tried[abs(q)].add(place if q > 0 else place + q)
    found: list[Run] = []
    for q in sorted(tried):
        # A multiple of a period found here, within its run, gives the same run again.
        if any(q % p == 0 and q <= e - middle and q <= middle - s for s, e, p in found):
            continue
        s = e = -1
        for a in tried[q]:
            if s <= a and a + q < e:
                continue  # in the stretch found before
            up, down = stretch(words, a, a + q, low, high)
            s, e = a - down, a + q + up
            if s < middle < e and e - s >= max(least, powers * q) and not any((s, e) == run[:2] for run in found):
                found.append((s, e, q))
    return found


def runs_of(texts: list[list[int]], least: int = LEAST, powers: int = POWERS) -> list[list[Run]]:
    """The maximal runs (start, end, period) of each row of word ids, by start, then period."""
    out: list[set[Run]] = [set() for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if not starts[-1]:
        return [[] for _ in texts]
    words = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes)

    width = anchor_words(least, powers)
    anchors = Anchors(words, text, width)
    grammar = Grammar(words, text)
    # A boundary that no run can cross has no repeated row of words beside it.
    half = np.where(grammar.left >= grammar.first, 0, 1)
    inner = grammar.left >= grammar.first
    half[inner] = grammar.size[grammar.left[inner] - grammar.first]

    def worth(low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> np.ndarray:
        last = len(words) - 1
        beside = (anchors.size[np.minimum(middle, last)] > 0) | (anchors.size[np.maximum(middle - width, 0)] > 0)
        return np.flatnonzero((high - low >= least) & beside)

    low, middle, high = grammar.place, grammar.place + half, grammar.place + grammar.size
    of_rule = {}
    for r in worth(low, middle, high).tolist():
        place = int(low[r])
        found = crossing(words, anchors, width, place, int(middle[r]), int(high[r]), least, powers)
        if found:
            of_rule[r] = [(s - place, e - place, q) for s, e, q in found]
    crossed: set[Run] = set()
    low, middle, high = grammar.boundaries()
    for k in worth(low, middle, high).tolist():
        crossed.update(crossing(words, anchors, width, int(low[k]), int(middle[k]), int(high[k]), least, powers))
    for r, places in grammar.places(np.array(sorted(of_rule), dtype=np.int64)).items():
        for place in places:
            crossed.update((place + s, place + e, q) for s, e, q in of_rule[r])
    merged: dict[tuple[int, int], tuple[int, int]] = {}
    for s, e, q in sorted(crossed, key=lambda run: (run[2], run[0] - run[1])):
        number = int(text[s])
        first, last = int(starts[number]), int(starts[number + 1])
        known = merged.get((number, q))
        if known is None or not known[0] <= s <= e <= known[1]:
            up, down = stretch(words, s, s + q, first, last)
            s, e = s - down, s + q + up
            merged[number, q] = (s, e)
            out[number].add((s - first, e - first, q))
    return [smallest_periods(found) for found in out]


def smallest_periods(found: set[Run]) -> list[Run]:
    """One run for each interval, with its smallest period."""
    least: dict[tuple[int, int], int] = {}
    for s, e, q in found:
        least[s, e] = min(q, least.get((s, e), q))
    return sorted(((s, e, q) for (s, e), q in least.items()), key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, e, q in runs:
        keep[s + q : e] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # of bytes: white space is \x20 and \x09-\x0D


def find_runs(docs: DataFrame, change: Callable[[object, list], list] | None = None, least: int = LEAST, powers: int = POWERS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text and the text without its repetitions.

    ``runs`` are (start, length, period) in words, by start, then period; ``collapsed`` has single
    blanks. ``change``, a function of the id and the words, may replace the words first.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def worked(ids: list, texts: list[list[bytes]], id_type: pa.DataType) -> pa.RecordBatch:
        index: dict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        numbers = [np.fromiter(map(index.__getitem__, t), np.int64, len(t)) for t in texts]
        found = runs_of(numbers, least, powers)
        columns = [
            pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[(s, e - s, q) for s, e, q in runs] for runs in found], pa.list_(run)),
            pa.array([b" ".join(collapsed(t, runs)).decode() for t, runs in zip(texts, found, strict=True)], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, id_type = [], [], 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, words = doc.as_py(), words_of(text.as_py())
                ids.append(doc)
                texts.append(change(doc, words) if change else words)
                size += len(words) + 1
                if size >= BATCH_WORDS:
                    yield worked(ids, texts, id_type)
                    ids, texts, size = [], [], 0
        if ids:
            yield worked(ids, texts, id_type)

    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(batched, schema)


def with_planted_runs(doc_id: object, words: list) -> list:
    """The words of a tenth of the texts, by CRC-32 of the id, with their end made periodic."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document: n_runs, the run with the greatest exponent, digests of runs and kept words."""
    # Exponents compare as length / period in whole numbers: the larger of a * d and c * b.
    run = "r.length * b.period > b.length * r.period"
    tie = "r.length * b.period = b.length * r.period AND (r.start < b.start OR (r.start = b.start AND r.period < b.period))"
    best = F.expr(f"aggregate(runs, get(runs, 0), (b, r) -> IF({run} OR ({tie}), r, b))")
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[n].cast("string") for n in ("start", "length", "period"))), F.lit("\n"))), ""
    )
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
