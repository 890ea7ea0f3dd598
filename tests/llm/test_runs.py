"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import TESTDATA
from edge_cases import LONG, edge_docs, edge_rows, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from paygrain.llm import runs
from paygrain.llm.queries import QUERIES

SMALL = str(TESTDATA / "sf0.01")


def plain_runs(words, least=24, powers=3):
    found = {}
    for q in range(1, len(words) // powers + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, powers * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_words(text):
    for gap in "\t\n\x0b\x0c\r":
        text = (text or "").replace(gap, " ")
    return [w for w in text.split(" ") if w]


def plain_row(doc_id, text):
    words = plain_words(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    own = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *own, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def random_words(pick):
    k = pick.choice([1, 2, 3, 5, 50])
    words = [pick.randrange(k) for _ in range(pick.randrange(40))]
    for _ in range(pick.randrange(5)):
        kind = pick.randrange(4)
        if kind == 0 and words:
            a = pick.randrange(len(words))
            words += words[a : pick.randrange(a, len(words) + 1)] * pick.randrange(1, 6)
        elif kind == 1:
            words += [pick.randrange(k) for _ in range(pick.randrange(30))]
        elif kind == 2 and words:
            tail = words[-pick.randrange(1, 20) :]
            words += tail * pick.randrange(1, 5) + tail[: pick.randrange(len(tail) + 1)]
        elif words:
            words[pick.randrange(len(words))] = pick.randrange(k + 1)
    return words[:1200]


def test_runs_of_made_texts():
    pick = random.Random(11)
    for _ in range(250):
        texts = [random_words(pick) for _ in range(pick.randrange(1, 8))]
        assert runs.runs_of(texts) == [plain_runs(t) for t in texts]


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 6), st.integers(2, 4))
@settings(max_examples=150, deadline=None)
def test_short_runs(words, least, powers):
    found = runs.runs_of([words, words[::-1]], least, powers)
    assert found == [plain_runs(words, least, powers), plain_runs(words[::-1], least, powers)]


def test_grammar_spells_the_texts_and_repeats_no_pair():
    pick = random.Random(3)
    texts = [random_words(pick) for _ in range(30)]
    words = np.concatenate([np.array(t, dtype=np.int64) for t in texts])
    text = np.repeat(np.arange(30), [len(t) for t in texts])
    grammar = runs.Grammar(words, text)

    def spelled(symbol):
        r = symbol - grammar.first
        return [symbol] if r < 0 else spelled(grammar.left[r]) + spelled(grammar.right[r])

    for number, given_ in enumerate(texts):
        own = grammar.symbol[grammar.text == number].tolist()
        assert [w for s in own for w in spelled(s)] == given_
        pairs = list(zip(own, own[1:], strict=False))
        apart = [p for i, p in enumerate(pairs) if i == 0 or pairs[i - 1] != p]
        assert len(set(apart)) == len(apart)
    for r, place in enumerate(grammar.place.tolist()):
        assert spelled(r + grammar.first) == words[place : place + grammar.size[r]].tolist()


def test_places_of_rules():
    words = np.array([0, 1, 2, 3, 0, 1, 2, 3, 9, 0, 1, 2, 3, 0, 1], dtype=np.int64)
    grammar = runs.Grammar(words, np.zeros(len(words), np.int64))
    for r, places in grammar.places(np.arange(len(grammar.left))).items():
        size, at = int(grammar.size[r]), int(grammar.place[r])
        for p in places:
            assert words[p : p + size].tolist() == words[at : at + size].tolist()
        assert at in places


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(plain_row(r.doc_id, r.text) for r in docs if len(r.text or "") < 9000)
    short = {r[0] for r in expected}
    result = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()]
    assert len(result) == len(docs)
    assert sorted(r for r in result if r[0] in short) == expected
    assert sum(r[1] > 0 for r in expected) > 20


def test_edge_cases(spark, edge_docs, edge_rows):
    found = runs.run_digests(runs.find_runs(edge_docs, runs.with_planted_runs)).collect()
    expected = [plain_row(r[0], r[1]) for r in edge_rows if r[1] != LONG]
    order = lambda row: tuple((x is None, x or 0) for x in row[:2]) + tuple(row[6:])
    assert sorted((tuple(r) for r in found if r.doc_id != 5), key=order) == sorted(expected, key=order)
    (own,) = [r for r in found if r.doc_id == 5]
    assert (own.start, own.length, own.period, own.n_runs) == (0, 60_000, 977, 1)


def test_empty_table(spark, no_docs):
    assert runs.run_digests(runs.find_runs(no_docs)).count() == 0


@pytest.mark.parametrize("word", ["a", "a b"])
def test_one_repeated_word(spark, word):
    text = " ".join([word] * 30_000)
    (row,) = runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    q = len(word.split())
    assert [tuple(r) for r in row.runs] == [(0, 30_000 * q, q)] and row.collapsed == word
