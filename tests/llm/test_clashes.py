"""Extra columns with the names that the operators use themselves: values stay, results agree."""

from __future__ import annotations

import pytest
from edge_cases import edge_rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from paygrain.llm import bayes, exact, jaccard, lattice, lines, mixing, packing, rules, runs, simhash
from paygrain.llm.queries import PIECES, TOKENIZER

NAMES = [
    "own__", "stay__", "hash__", "id__", "flips__", "n_dropped__", "copy__", "copy", "mix", "mix_", "plan__", "text__", "quality",
    "toxic", "quality_label", "expected", "host", "path", "evidence", "e", "hash", "size", "position", "node", "best", "copies",
    "fingerprint", "root", "first", "text_hash", "text_key", "n", "digest", "rare", "often", "rank", "id", "block", "words", "trained",
    "of", "at", "word", "count", "runs", "collapsed", "n_lines", "key", "h", "p", "total", "doc", "component_id", "kept", "n_words",
]
BASE = "doc_id long, text string, lang string, source string, n_chars long"
OPERATORS = {
    "rules": rules.judged, "exact": exact.exact_duplicates, "simhash": simhash.near_duplicates, "runs": runs.find_runs,
    "lines": lines.line_bitmaps, "jaccard": jaccard.joined,
    "mixing": lambda d: mixing.mix(d).withColumn("taken", F.struct("*")[mixing.mix(d).columns[-1]]).select("doc_id", "taken"),
    "packing": lambda d: packing.pack(d, TOKENIZER).select("doc_id", "start", "length", "doc_tokens"),
    "lattice": lambda d: lattice.scored(d, PIECES, rounds=0),
    "bayes": lambda d: bayes.judged(d, d.sparkSession.createDataFrame([(1, 1, 0), (6, 0, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")),
}


@pytest.fixture(scope="module")
def tables(spark, edge_rows):
    """The same rows without and with a column of every name, whose values tell row and column."""
    plain = spark.createDataFrame(edge_rows, BASE)
    extra = ", ".join(f"{n} string" for n in NAMES)
    rows = [(*row, *(f"{i}{n}" for n in NAMES)) for i, row in enumerate(edge_rows)]
    return plain, spark.createDataFrame(rows, f"{BASE}, {extra}")


def values(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_gives_the_same(tables, name):
    plain, clashing = tables
    assert values(OPERATORS[name](clashing)) == values(OPERATORS[name](plain))


@pytest.mark.parametrize("stage", [stage for stage in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_stage_keeps_the_values(spark, tables, stage):
    plain, clashing = tables
    kept = stage[1](spark, clashing, "")
    assert kept.columns == clashing.columns
    given = {tuple(r[n] for n in NAMES) for r in clashing.collect()}
    rows = kept.collect()
    assert rows and {tuple(r[n] for n in NAMES) for r in rows} <= given
    assert sorted(str(r[:5]) for r in rows) == sorted(str(r[:5]) for r in stage[1](spark, plain, "").collect())


def test_labels_are_learned_one_by_one(spark):
    words = {True: "awful hateful nasty vile", False: "gentle calm plain kind"}
    docs = [(i, " ".join(f"{w} t{i}x{k}" for k in range(4) for w in words[i % 2 == 0].split())) for i in range(60)]
    frame = spark.createDataFrame([(*d, "en", "a", 1) for d in docs], BASE)
    labels = spark.createDataFrame([(i, None, int(i % 2 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in bayes.judged(frame, labels).collect()}
    assert all((found[i].toxic_probability > 0.5) == (i % 2 == 0) for i in range(60))
    assert all(r.quality_evidence == 0.0 for r in found.values())
