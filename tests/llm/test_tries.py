"""The prefix trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import TESTDATA

from paygrain.llm import tries
from paygrain.llm.queries import QUERIES
from paygrain.session import materialise

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rebuilt):
    """Rows of the contract for {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        turns = tuple(rebuilt[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or (not below)
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), int(leaves[node]),
            saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def plain_turns(rows):
    """The turns of each conversation in order, empty for null."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}:{text or ''}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def found(frame):
    return sorted(tuple(r[n] for n in NAMES) for r in frame.collect())


def trie_of(spark, rows):
    turns = materialise(tries.digested(spark.createDataFrame(rows, SCHEMA)))
    return tries.prefix_trie(turns, turns.where("place = 0").select("conv_id"))


def test_query_equals_plain_python(spark):
    rows = spark.read.parquet(f"{TESTDATA}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    expected = plain_trie(plain_rebuilt(plain_turns([tuple(r) for r in rows])))
    result = QUERIES["op13_conversation_trie"](spark, f"{TESTDATA}/sf0.01")
    assert dict(result.dtypes) == {n: "bigint" if n != "ends_sha256" else "string" for n in NAMES}
    assert found(result) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_bushes_and_chains(spark, seed):
    pick = random.Random(seed)
    rows = []
    for c in range(40):
        length = pick.choice([1, 2, 3, 30, 60])
        rows += [(c, t, "user", "ab"[pick.random() < 0.02]) for t in range(length)]
    assert found(trie_of(spark, rows)) == plain_trie(plain_turns(rows))


def test_edge_cases(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (2, 0, None, None), (3, 0, "", ""), (4, 0, "us", "er:x"), (5, 0, "use", "r:x"), (None, 0, "user", "nobody's"),
        (6, 0, "user", "long " * 200_000), (7, 0, "user", "long " * 200_000), (-7, 0, "é", "\U0001f600"),
    ]
    assert found(trie_of(spark, rows)) == plain_trie(plain_turns(rows))


def test_clashing_columns(spark):
    rows = [(1, 0, "user", "a", "k", 1, 2, "p"), (2, 0, "user", "a", "k", 1, 2, "p")]
    given = spark.createDataFrame(rows, SCHEMA + ", key string, place int, depth int, digest string")
    turns = tries.digested(given)
    trie = tries.prefix_trie(turns, turns.where("place = 0").select("conv_id"))
    assert found(trie) == plain_trie(plain_turns([r[:4] for r in rows]))


def test_empty_table(spark):
    assert trie_of(spark, []).count() == 0


def test_turnless_conversation(spark):
    turns = tries.digested(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA))
    trie = tries.prefix_trie(turns, spark.createDataFrame([(1,), (2,)], "conv_id long"))
    assert found(trie) == plain_trie({1: [("user", "a")], 2: []})
