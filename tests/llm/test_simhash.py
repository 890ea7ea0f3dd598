"""Fingerprints and groups against plain Python over all pairs."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from edge_cases import edge_docs, edge_rows, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paygrain.llm import simhash
from paygrain.llm.queries import QUERIES

SMALL = str(TESTDATA / "sf0.001")


def plain_fingerprint(text):
    for gap in "\t\n\x0b\x0c\r":
        text = text.replace(gap, " ")
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in text.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Group number of each fingerprint, by comparing all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    group = np.arange(len(prints))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            near = np.bitwise_count(prints ^ prints[i]) <= 3
            low = group[near].min()
            if (group[near] != low).any():
                group[near], changed = low, True
    return group


@given(st.text(alphabet="aB c\t\n é#　", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_portions(monkeypatch):
    text = " ".join(f"t{i}" for i in range(500))
    monkeypatch.setattr(simhash, "HASHED_AT_ONCE", 7)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_equals_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [plain_fingerprint(docs[i]) for i in ids]
    groups = plain_groups(prints)
    expected = {i: (f"{p:016x}", ids[g]) for i, p, g in zip(ids, prints, groups, strict=True)}
    assert {r[0]: (r[1], r[2]) for r in QUERIES["op6_simhash_near_dedup"](spark, SMALL).collect()} == expected


def clustered(seed, centres, members, flips):
    rng = np.random.default_rng(seed)
    found = set()
    for centre in rng.integers(0, 1 << 63, size=centres, dtype=np.uint64):
        for _ in range(members):
            value = int(centre)
            for bit in rng.integers(0, 64, size=rng.integers(0, flips + 1)):
                value ^= 1 << int(bit)
            found.add(value)
    return sorted(found)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize(("max_trie", "flips"), [(1 << 16, 4), (8, 4), (2, 8)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, max_trie, flips):
    prints = clustered(max_trie, 12, 40, flips)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    monkeypatch.setattr(simhash, "PORTION", 50)
    links = simhash.near_links(frame, max_trie=max_trie)
    assert all((int(r.a) ^ int(r.b)) for r in links.collect())
    roots = {r[0]: r[1] for r in simhash.connected(links).collect()}
    expected = plain_groups(prints)
    by_root = {}
    for p, g in zip(prints, expected, strict=True):
        by_root.setdefault(roots.get(signed(p), signed(p)), set()).add(int(g))
    assert all(len(g) == 1 for g in by_root.values()) and len(by_root) == len(set(expected.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), min_size=1, max_size=30), st.integers(0, 3))
def test_tries_find_all_close_leaves(values, max_bits):
    near = {v ^ (1 << b) for v in list(values)[:5] for b in (0, 17, 63)}
    keys = np.array(sorted(values | near), dtype=np.uint64)
    tries = simhash.Tries(np.zeros(len(keys), dtype=np.int64), keys)
    found = set()
    for a, b in tries.close_leaves(tries.roots, tries.roots, max_bits):
        found |= {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    expected = {
        (i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if int(keys[i] ^ keys[j]).bit_count() <= max_bits
    }
    assert found == expected


def test_long_chains_are_one_group(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in simhash.connected(links).collect()} == {0}


def test_edge_documents(edge_docs, no_docs, edge_rows):
    found = simhash.near_duplicates(edge_docs)
    rows = found.collect()
    assert len(rows) == len(edge_rows)
    empty = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(empty) == 4 and {r.component_id for r in empty} == {2}
    assert {r.component_id for r in rows if r.doc_id in (1, 6)} == {1}
    kept = simhash.one_of_each_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 5, 7, 8, None} <= set(ids) and 6 not in ids and 3 not in ids
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each_group(no_docs).count() == 0


def test_repeated_and_null_ids_keep_one_row_of_a_group(spark):
    words = [[f"t{g}w{i}" for i in range(80)] for g in range(5)]
    rows = [
        *((1, case(" ".join(words[0]))) for case in (str, str.upper, str.title)),
        *((None, case(" ".join(words[1]))) for case in (str, str.upper, str.title)),
        (None, " ".join(words[2])), (None, " ".join(words[2])),
        (None, " ".join(words[3])), (4, " ".join(words[3]).upper()), (4, " ".join(words[3]).title()), (5, " ".join(words[3])),
        (1, " ".join(words[4])), (6, " ".join(words[4]).upper()),
    ]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.text.split()[0].lower(), r.doc_id) for r in kept)
    assert found == [("t0w0", 1), ("t1w0", None), ("t2w0", None), ("t3w0", 4), ("t4w0", 1)]
