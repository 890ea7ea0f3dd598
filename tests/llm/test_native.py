"""Rules, line dedup, exact dedup and mixing: check SQL, plain Python, defined cases."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from conftest import TESTDATA
from edge_cases import edge_docs, edge_rows, no_docs  # noqa: F401
from pyspark.sql import functions as F

from paygrain.llm import exact, lines, mixing, rules
from paygrain.llm.oracle import ORACLE
from paygrain.llm.queries import QUERIES

SMALL = str(TESTDATA / "sf0.001")
GAPS = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


def split_words(text):
    for gap in GAPS[1:]:
        text = text.replace(gap, " ")
    return [w for w in text.split(" ") if w]


def plain_counts(text):
    text = text or ""
    words = split_words(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    full = [x for x in text.split("\n") if split_words(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered)


def test_counts_of_edge_texts(edge_docs, edge_rows):
    found = Counter(tuple(r)[:6] for r in rules.judged(edge_docs).collect())
    assert found == Counter((row[0], *plain_counts(row[1])) for row in edge_rows)


@pytest.mark.parametrize(
    ("text", "covered"),
    [("a b c a b c", 6), ("a a a a", 4), ("a b c d a b c", 6), ("a b", 0), ("a b c", 0), ("", 0), ("a b a b a", 5)],
)
def test_repeated_windows(spark, text, covered):
    frame = spark.createDataFrame([(text,)], "t string").select(rules.FEATURES["n_repeat_words"](F.col("t")))
    assert frame.first()[0] == covered == plain_counts(text)[4]


def test_order_changes_no_verdict(edge_docs):
    features = rules.features_of(F.coalesce("text", F.lit("")))
    text = F.coalesce("text", F.lit(""))
    frame = edge_docs.select(
        rules.verdict(features, rules.RULES), rules.verdict(features, rules.RULES[::-1]), rules.passes(text, rules.RULES)
    )
    assert all(a == b == c for a, b, c in frame.collect())


def test_rules_are_ordered_by_rejections_per_second():
    def made(name, seconds, rejected):
        return rules.Estimate(rules.Rule(name, lambda f: F.lit(False)), seconds, frozenset(rejected))

    found = [made("dear", 1.0, range(10)), made("cheap", 0.1, range(5)), made("covered", 0.2, range(5)), made("idle", 0.1, [])]
    assert [r.name for r in rules.ordered(found)] == ["cheap", "dear", "idle", "covered"]


def test_rejected_documents_go(edge_docs, no_docs):
    kept = rules.kept_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(10, 16))  # others are digits, repeats or short
    assert rules.kept_documents(no_docs).count() == 0 and rules.judged(no_docs).count() == 0


def plain_line_dedup(rows, least=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(GAPS))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(doc)
    rank = lambda doc: (doc is not None, doc or 0)
    gone = {k: max(d, key=rank) for k, d in holders.items() if len(d) >= least}
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if gone.get(key(x), doc) == doc]
        yield doc, len(all_lines) - len(kept), "\n".join(kept)


def test_line_dedup_of_edge_texts(edge_docs, edge_rows):
    found = lines.apply_bitmaps(edge_docs, lines.line_bitmaps(edge_docs))
    assert found.columns == [*edge_docs.columns, "n_dropped__"]
    got = Counter((r.doc_id, r.n_dropped__, r.text or "") for r in found.collect())
    assert got == Counter(plain_line_dedup([(r[0], r[1]) for r in edge_rows]))
    assert sum(n for _, n, _ in got) == 10


def test_bitmaps_are_changes_between_kept_and_dropped(spark):
    frame = spark.createDataFrame([([],), ([0],), ([1, 2, 5],), ([0, 1, 2, 3],)], "d array<int>")
    flips = [r[0] for r in frame.select(lines.keep_flips(F.col("d"))).collect()]
    assert flips == [[], [0, 1], [1, 3, 5, 6], [0, 4]]
    text = F.split(F.lit("a,b,c,d"), ",")
    kept = [
        spark.range(1).select(lines.kept_lines(text, F.array(*map(F.lit, f)).cast("array<int>"))).first()[0]
        for f in ([], [0, 1], [1, 3], [0, 4], [3, 4])
    ]
    assert kept == [list("abcd"), list("bcd"), list("ad"), [], list("abc")]


def test_line_dedup_of_nothing(no_docs):
    assert lines.line_bitmaps(no_docs).count() == 0
    assert lines.apply_bitmaps(no_docs, lines.line_bitmaps(no_docs)).count() == 0


@pytest.mark.parametrize("fan_in", [2, 16])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates_of_edge_texts(edge_docs, edge_rows, fan_in, keep):
    found = exact.exact_duplicates(edge_docs.repartition(7), keep, fan_in).collect()
    groups = defaultdict(list)
    for doc, text, *_ in edge_rows:
        groups[text or ""].append(doc)
    assert len(found) == len(edge_rows)
    choose = max if keep == "largest" else min
    for text, members in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows = [r for r in found if r.text_sha256 == digest]
        ids = [m for m in members if m is not None]
        assert {r.keep_id for r in rows} == {choose(ids) if ids else None}
        assert {r.group_size for r in rows} == {len(members)} and sum(r.kept for r in rows) == 1


def test_hot_text_is_a_row_per_node(spark):
    docs = spark.range(4000, numPartitions=40).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact.exact_duplicates(docs, fan_in=4)
    assert found.where("kept").count() == 4000 - 1334 + 1
    assert {(r.keep_id, r.group_size) for r in found.where("group_size > 1").collect()} == {(3999, 1334)}


def test_nothing_to_deduplicate(no_docs):
    assert exact.exact_duplicates(no_docs).count() == 0


def test_mix_of_edge_documents(edge_docs, no_docs):
    chosen = mixing.mix(edge_docs)
    assert chosen.columns == [*edge_docs.columns, "mix_"]
    rows = chosen.collect()
    assert len(rows) == 17 and all(0 <= r.mix_.copies <= 3 and r.mix_.taken == r.mix_.size * r.mix_.copies for r in rows)
    assert all(r.mix_.target <= 3 * r.mix_.source_size for r in rows)
    copies = mixing.mixed_documents(edge_docs)
    assert copies.columns == edge_docs.columns and copies.count() == sum(r.mix_.copies for r in rows)
    assert mixing.mix(no_docs).count() == 0


def test_sources_come_near_their_targets(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    chosen = mixing.mix(docs).select("doc_id", "source", "mix.*")
    sums = chosen.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(sums) == 8 and all(abs(r.taken - r.target) <= 40 for r in sums)
    assert sorted(chosen.collect()) == sorted(mixing.mix(docs.repartition(3)).select("doc_id", "source", "mix.*").collect())


def test_targets_stop_at_the_cap_and_share_the_rest(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 500), ("c", 490), (None, 100)], "source string, size long")
    found = {r.source: r.target for r in mixing.budgets(sized).collect()}
    assert found["a"] == 30 and sum(found.values()) == pytest.approx(1100)
    assert found["b"] == pytest.approx(2 * found["c"]) and found[None] == 300
