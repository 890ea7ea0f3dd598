"""Quality rules as a cascade that stops at the first rejection.

Each rule is a condition on features of the text. On a sample of rows the time of every rule is
measured and its rejections are noted; rules are then ordered by rejections per second among the
rows that the rules before them leave. The cascade is one CASE expression, which Spark evaluates
lazily, so a rejected text costs no further rules. The sample decides the order only: a text is
kept if no rule rejects it, whatever the order.

Counts are exact for whole texts. Three-word windows are told apart by 64-bit hashes within one
text. Defined cases: a null text is an empty one and is rejected for its length; an empty table
gives an empty result and the rules keep their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.llm.common import GAP_CHARACTERS, free_name, let, text_of, word_array, word_count

Features = Callable[[str], Column]
SAMPLE_ROWS = 256
TIMED_RUNS = 2
WINDOW = 3


def windows(words: Column) -> Column:
    """A hash of every window of three words, in order."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))


def in_repeated_windows(words: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Hashes are sorted with their positions, equal neighbours give the repeated windows, and the
    words they cover are counted once.
    """

    def twice(ordered: Column) -> Column:
        same = F.filter(
            ordered, lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"])
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        to_next = F.transform(
            starts, lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(to_next, F.lit(0), lambda a, b: a + b)

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(placed), lambda ordered: let(twice(ordered), covered))
        )

    return let(windows(words), count).cast("long")


def word_features(text: Column) -> Column:
    """n_words, word_chars and n_repeat_words from one split of the text."""
    return let(
        word_array(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            in_repeated_windows(words).alias("n_repeat_words"),
        ),
    )


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARACTERS)) != "")


FEATURES: dict[str, Callable[[Column], Column]] = {
    "n_words": word_count,
    "word_chars": lambda t: F.char_length(F.array_join(word_array(t), "")).cast("long"),
    "n_symbols": lambda t: F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
    "n_dup_lines": lambda t: let(lines_with_words(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda t: let(word_array(t), in_repeated_windows),
    "n_lines": lambda t: F.size(lines_with_words(t)).cast("long"),
    "n_capitals": lambda t: F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
    "n_digits": lambda t: F.regexp_count(t, F.lit("[0-9]")).cast("long"),
    "n_exclamations": lambda t: F.octet_length(t) - F.octet_length(F.replace(t, F.lit("!"), F.lit(""))),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WORD_BASE = ("n_words", "word_chars", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from feature names to columns."""

    name: str
    rejects: Callable[[Features], Column]


BASE_RULES = (
    Rule("few_words", lambda f: f("n_words") < 50),
    Rule("repeated_windows", lambda f: 100 * f("n_repeat_words") > 50 * f("n_words")),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda f: 20 * f("n_symbols") > f("word_chars")),
    Rule("shouting", lambda f: 10 * f("n_capitals") > 4 * f("word_chars")),
    Rule("exclamations", lambda f: 5 * f("n_exclamations") > f("n_words")),
    Rule("digits", lambda f: 2 * f("n_digits") > f("word_chars")),
    Rule("word_length", lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 25 * f("n_words"))),
    Rule("repeated_lines", lambda f: 10 * f("n_dup_lines") > 5 * f("n_lines")),
)


def features_of(text: Column, known: Sequence[str] = ()) -> Features:
    """Features by name: as columns where ``known`` has them, else as expressions of the text."""
    return lambda name: F.col(name) if name in known else FEATURES[name](text)


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule: seconds for the sample and the rows it rejects."""

    rule: Rule
    seconds: float
    rejected: frozenset[int]


def estimates(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Time each rule on the first rows that a scan returns, and note what it rejects there.

    ``take`` reads no more partitions than it needs, and returns flags only.
    """
    text = text_of(F.col("text"))

    def seconds(column: Column) -> tuple[float, list]:
        best, rows = float("inf"), []
        for _ in range(TIMED_RUNS):
            began = time.perf_counter()
            rows = docs.select(column.alias("flag")).take(sample_rows)
            best = min(best, time.perf_counter() - began)
        return best, rows

    floor, _ = seconds(F.octet_length(text) < 0)
    found = []
    for rule in rules:
        took, rows = seconds(rule.rejects(features_of(text)))
        found.append(Estimate(rule, max(took - floor, 1e-4), frozenset(i for i, r in enumerate(rows) if r["flag"])))
    return found


def ordered(found: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejections per second among the sample rows that earlier rules leave."""
    left, gone, order = list(found), frozenset(), []
    while left:
        best = max(left, key=lambda e: (len(e.rejected - gone) / e.seconds, -e.seconds))
        left.remove(best)
        gone |= best.rejected
        order.append(best.rule)
    return order


def verdict(features: Features, order: Sequence[Rule]) -> Column:
    """True if no rule rejects; rules after the first rejection are not evaluated."""
    case = F.when(order[0].rejects(features), F.lit(False))
    for rule in order[1:]:
        case = case.when(rule.rejects(features), F.lit(False))
    return case.otherwise(F.lit(True))


def passes(text: Column, order: Sequence[Rule]) -> Column:
    """``verdict`` of a text that is split into words once for all rules that need them."""

    def with_words(words: Column) -> Column:
        cheap = F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        )

        def with_counts(counts: Column) -> Column:
            def feature(name: str) -> Column:
                if name in ("n_words", "word_chars"):
                    return counts[name]
                return in_repeated_windows(words) if name == "n_repeat_words" else FEATURES[name](text)

            return verdict(feature, order)

        return let(cheap, with_counts)

    return let(word_array(text), with_words)


def kept_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    order = ordered(estimates(docs, rules, sample_rows))
    return docs.where(passes(text_of(F.col("text")), order))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept) for every row of ``docs``."""
    order = ordered(estimates(docs, rules, sample_rows))
    text = free_name(docs, "text__")
    counted = docs.select("doc_id", text_of(F.col("text")).alias(text))
    counted = counted.select(
        "doc_id", text, word_features(F.col(text)).alias("of"),
        *(FEATURES[name](F.col(text)).alias(name) for name in BASE if name not in WORD_BASE),
    ).select("doc_id", text, *(name for name in BASE if name not in WORD_BASE), *(F.col("of")[name].alias(name) for name in WORD_BASE))
    known = features_of(F.col(text), BASE)
    failed = BASE_RULES[0].rejects(known) | BASE_RULES[1].rejects(known)
    return counted.select("doc_id", *BASE, failed.alias("base_failed"), verdict(known, order).alias("kept"))
