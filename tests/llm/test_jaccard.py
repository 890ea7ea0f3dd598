"""Components of the Jaccard join against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import TESTDATA
from edge_cases import edge_docs, edge_rows, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from paygrain.llm import jaccard
from paygrain.llm.queries import QUERIES

SMALL = str(TESTDATA / "sf0.01")
SCHEMA = "doc_id long, text string"


def plain_set(text):
    for gap in "\t\n\x0b\x0c\r":
        text = (text or "").replace(gap, " ")
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in text.split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_components(texts, percent=80):
    """(doc_id, n_shingles, component_id) of [(doc_id, text)], by the overlap of all pairs."""
    sets = [plain_set(t) for _, t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = np.zeros(i + 1, dtype=np.int64)
        for x in s:
            held = [j for j in holders[x] if j < i]
            common[held] += 1
        for j in np.flatnonzero(common).tolist():
            if 100 * common[j] >= percent * (len(s) + len(sets[j]) - common[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            ids[top(i)] = min(doc, ids.get(top(i), doc))
    return sorted(
        ((doc, len(s), ids.get(top(i))) for i, ((doc, _), s) in enumerate(zip(texts, sets, strict=True))), key=str
    )


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def family(pick, size, words, edits, first):
    """Copies of one text, each with some words of its own."""
    base = [f"b{first}x{i}" for i in range(words)]
    texts = []
    for d in range(size):
        own = list(base)
        for _ in range(pick.randrange(edits + 1)):
            own[pick.randrange(words)] = f"o{pick.randrange(40)}"
        texts.append((first + d, " ".join(own)))
    return texts


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain_components(docs)
    result = found(QUERIES["op11_jaccard_join"](spark, SMALL))
    assert result == expected
    assert len({c for _, _, c in expected}) < len(docs) - 30


@pytest.mark.parametrize(("portion", "most"), [(4096, 1 << 18), (16, 1 << 18), (16, 3)])
def test_families(spark, portion, most):
    pick = random.Random(portion + most)
    texts = family(pick, 90, 80, 4, 0) + family(pick, 30, 30, 2, 1000) + family(pick, 40, 200, 12, 2000)
    texts += [(3000 + i, " ".join(f"p{j}" for j in range(60)) + " " + " ".join(f"u{i}x{j}" for j in range(pick.randrange(60)))) for i in range(40)]
    pick.shuffle(texts)
    result = jaccard.joined(spark.createDataFrame(texts, SCHEMA), portion_size=portion, most_shared=most)
    assert found(result) == plain_components(texts)


@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=70), st.sampled_from([50, 80, 90]))
@settings(max_examples=60, deadline=None)
def test_region_joins_all_members(lists, percent):
    whole = [np.unique(np.array(x, dtype=np.uint64)) for x in lists]
    moved = [jaccard.relative(s, whole[0]) for s in whole]
    sizes = np.array([len(s) for s in whole])
    group = jaccard.Region(moved, sizes, np.arange(len(whole)), percent)
    group.join(np.arange(len(whole)))
    root = list(range(len(whole)))
    for i in range(len(whole)):
        for j in range(i):
            common = len(np.intersect1d(whole[i], whole[j]))
            if 100 * common >= percent * (len(whole[i]) + len(whole[j]) - common):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    expected = {tuple(np.flatnonzero(np.array(root) == r)) for r in set(root)}
    assert {tuple(np.flatnonzero(group.label == r)) for r in set(group.label.tolist())} == expected


def test_edge_cases(spark, edge_docs, edge_rows):
    assert found(jaccard.joined(edge_docs)) == plain_components([r[:2] for r in edge_rows])


def test_empty_table(spark, no_docs):
    assert jaccard.joined(no_docs).count() == 0


def test_election_makes_a_row_for_each_further_holder():
    pick = random.Random(11)
    sizes = [pick.randrange(300, 700) for _ in range(40)]
    holders = {h: sorted(pick.sample(range(6 if h < 60 else 40), pick.randrange(1, 5))) for h in range(180)}
    postings = [(h, i, 2 * sizes[i] + pick.randrange(2)) for h, held in holders.items() for i in held]
    elect, rows, plain = jaccard.elected(80), [], []
    for part in range(9):  # partitions of elements
        own = [p for p in postings if p[0] % 9 == part]
        batch = jaccard.pa.RecordBatch.from_arrays([jaccard.pa.array(c, jaccard.pa.int64()) for c in zip(*own, strict=True)], ["h", "id", "sized"])
        rows += [r for out in elect(iter([batch])) for r in out.to_pylist()]
    windows = jaccard.size_window(np.array(sizes), 80)
    hits, pairs = {}, set()
    for h in holders:
        met = set()
        for w in range(int(windows.min()) - 1, int(windows.max()) + 1):
            group = [(i, s & 1 and windows[i] == w) for g, i, s in postings if g == h and windows[i] - w in (0, 1)]
            if len(group) > 1 and any(short for _, short in group):
                met |= {i for i, _ in group}
                pairs |= {(i, group[0][0]) for i, _ in group[1:]}
        for i in met:
            hits[i] = hits.get(i, 0) + 1
    assert {(r["id"], r["pivot"]) for r in rows} == pairs
    for r in rows:
        plain += [(r["id"], r["hits"]), (r["pivot"], r["pivot_hits"])]
    assert {i: sum(n for j, n in plain if j == i) for i in hits} == hits and sum(n for _, n in plain) == sum(hits.values())
    assert len(rows) <= len(postings) - len(holders)


def test_election_grows_with_the_holders():
    def made(size):
        columns = [[7] * size, list(range(size)), [2 * 500 + 1] * size]
        batch = jaccard.pa.RecordBatch.from_arrays([jaccard.pa.array(c, jaccard.pa.int64()) for c in columns], ["h", "id", "sized"])
        return sum(b.num_rows for b in jaccard.elected(80)(iter([batch])))

    assert [made(n) for n in (1, 2, 500, 4000)] == [0, 1, 499, 3999]
