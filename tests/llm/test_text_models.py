"""Extraction, chat, classifier, lattice and packing against plain Python and held-out rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from edge_cases import edge_docs, edge_rows, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paygrain.llm import bayes, chat, extraction, lattice, packing
from paygrain.llm.blocks import blocks_of
from paygrain.llm.layouts import Layouts
from paygrain.llm.queries import INJECTION, PIECES, QUERIES, TOKENIZER

SMALL = str(TESTDATA / "sf0.001")


# --- extraction ----------------------------------------------------------------------------


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    assert texts("<p>a <b>b</b>c<br>d &amp; &eacute;<p>e<script>var x = '</p>';</script>f") == ["a bc d & é", "ef"]
    assert texts("<!-- <p>x</p> --><ul><li>a<li>b</ul>c<style>p{}</style>") == ["a", "b", "c"]
    assert texts("a < b <p title='x > y'>c") == ["a < b", "c"]
    assert texts("") == texts("<p></p> \n <br>") == texts("<script>x") == []
    nested = blocks_of("<nav class='top menu'><ul><li><a href=x>Home</a> page</ul></nav><article id=main><p>t")
    assert nested[0].path == (("nav", ".top", ".menu"), ("ul",), ("li",)) and nested[0].linked == 4
    assert nested[1].path == (("article", ".main"), ("p",)) and nested[1].linked == 0


def test_only_raw_text_hides_the_rest_of_a_page():
    for tag in ("svg", "math", "object", "canvas", "audio", "video", "template", "noscript"):
        assert texts(f"<p>a</p><{tag} id=x><article><p>b</p><{tag}><p>c") == ["a", "b", "c"]
    for tag in ("svg", "math", "object", "canvas", "audio", "video"):
        assert texts(f"<p>a <{tag}>b <i>c</i></{tag}> d<p>e") == ["a b c d", "e"]
    for tag in ("script", "style", "title", "textarea", "iframe"):
        assert texts(f"<p>a</p><{tag}>b</{tag}s><p>c</{tag} ><p>d<{tag}>e<p>f") == ["a", "d"]
    assert texts("<p>a<template><p>b</template>c<noscript><p>d</noscript >e") == ["ace"]
    assert texts("<article><p>" + "<template>a" * 100_000) == ["a" * 100_000]


def test_labeller_gradient():
    rng = np.random.default_rng(0)
    rows = [rng.standard_normal((n, extraction.SIZE)).astype(np.float32) * 0.1 for n in (3, 5)]
    labels = [np.array([1, 0, 1]), np.array([0, 0, 1, 1, 0])]
    model = extraction.Labeller()
    found = model.gradients(rows, labels)

    def loss():
        p = np.concatenate([x.astype(float) for x in model.probabilities(rows)])
        y = np.concatenate(labels)
        return -np.log(np.where(y == 1, p, 1 - p)).mean()

    for parameter, gradient in zip(model.parameters(), found, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = parameter[at], 1e-2
        parameter[at] = old + step
        high = loss()
        parameter[at] = old - step
        low = loss()
        parameter[at] = old
        assert (high - low) / (2 * step) == pytest.approx(gradient[at], rel=0.05, abs=1e-4)


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    return extraction.trained(extraction.sampled(pages, 25, 50_000))


def test_labeller_on_layouts_not_seen(labeller, spark):
    given_texts = [b.text for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()[25:] for b in blocks_of(r.html)]
    layouts, vectors, wrong, total = Layouts(given_texts, 1234), extraction.Vectors(), 0, 0
    for _ in range(300):
        page, labels = layouts.page()
        chance = labeller.probabilities([vectors.of(blocks_of(page))])[0]
        wrong += int(((chance > 0.5) != np.array(labels)).sum())
        total += len(labels)
    assert wrong / total < 0.02


def test_pages_of_other_kinds(labeller):
    story = [" ".join(f"word{i}{j}" for j in range(30)) + "." for i in range(4)]
    page = (
        "<body><header><h1>Site</h1></header><div class='cookie-banner'><p>We use cookies on this site.</p></div>"
        "<main><h1>Title of it</h1>" + "".join(f"<p>{p}</p>" for p in story) + "</main>"
        "<aside class='sidebar'><ul><li><a href=x>More</a></ul></aside><section id='comments'><p>Nice story, thanks.</p>"
        "<p>I do not agree with this at all.</p></section><form><label>Mail</label></form><footer>&copy; 2024</footer>"
    )
    blocks = blocks_of(page)
    chance = labeller.probabilities([extraction.Vectors().of(blocks)])[0]
    assert [b.text for b, p in zip(blocks, chance, strict=True) if p > 0.5] == ["Title of it", *story]


def test_extraction_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for row in QUERIES["op1_html_extraction"](spark, SMALL).collect():
        blocks = blocks_of(pages[row.page_id].html)
        expected = "\n\n".join(b.text for b, y in zip(blocks, extraction.marked_article(blocks), strict=True) if y)
        assert row.text == expected and row.n_chars == len(expected) and row.url == pages[row.page_id].url


def test_extraction_of_edge_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p></p>"), (2, "u", "<p></p>"), (3, "u", "<article><p>" + "word " * 90_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in extraction.extract(frame).collect()}
    assert found[1, None] == found[None, "u"] == found[2, "u"] == ("", 0) and found[3, "u"][1] == 5 * 90_000 - 1
    assert extraction.extract(frame).count() == 5 and extraction.extract(frame.limit(0)).count() == 0


# --- chat ----------------------------------------------------------------------------------


def test_chat_query_reads_back_every_turn(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", INJECTION), (-7, 1, "assistant", INJECTION)]
    turns = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        turns[conv].append((role, text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = QUERIES["op5_chat_formatting"](spark, SMALL).collect()
    assert len(found) == len(turns)
    for row in found:
        own = turns[row.conv_id]
        loss = "".join(t for r, t in own if r == "assistant")
        assert (row.n_turns, row.turns_sha256) == (len(own), digest("".join(f"{r}\n{t}\n" for r, t in own)))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), digest(loss))


PATTERN = chat.control_pattern(chat.CONTROL)
CONTROLS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "[", " ", "é", "\U0001f600", "a", "\n", "<\\s>"]), max_size=12)


@given(CONTROLS.map("".join))
def test_escape_is_reversible_and_leaves_no_control(text):
    escaped = chat.escape(text, PATTERN)
    assert chat.unescape(escaped, PATTERN) == text
    assert not any(c in escaped for c in chat.CONTROL)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", chat.END]), CONTROLS.map("".join)), max_size=5))
def test_mask_covers_assistant_texts(turns):
    text, spans = chat.render(turns, PATTERN)
    code = TOKENIZERS.setdefault("chat", chat.chat_tokenizer(TOKENIZER)).encode(text, add_special_tokens=False)
    starts, ends = np.array(code.offsets, dtype=np.int32).reshape(-1, 2).T
    marked = chat.mask(starts, ends, spans)
    assert chat.turns_of(text, PATTERN) == turns
    assert chat.loss_text(text, starts, ends, marked, PATTERN) == "".join(t for r, t in turns if r == "assistant")


TOKENIZERS: dict = {}


def test_chat_of_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 0, None, None, "x"), (1, 0, "assistant", "b", "x"), (1, 0, "assistant", "b", "x"), (1, None, "user", "", "x"),
            (None, 1, "assistant", "word " * 50_000, "x"), (2, 0, "assistant", "", "x")]
    frame = spark.createDataFrame(rows, schema)
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame, TOKENIZER)).collect()}
    assert list(zip(found[1].roles, found[1].texts, strict=True)) == [("user", ""), ("", ""), ("assistant", "b"), ("assistant", "b")]
    assert found[1].loss_text == "bb" and found[2].loss_text == "" and found[None].loss_text == "word " * 50_000
    assert chat.read_back(chat.format_conversations(frame.limit(0), TOKENIZER)).count() == 0


# --- classifier ----------------------------------------------------------------------------


def test_classifier_on_held_out_documents(spark):
    directory = str(TESTDATA / "sf0.01")
    docs, labels = (spark.read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "labels"))
    tested = F.pmod(F.xxhash64(F.col("text")), F.lit(4)) == 0
    hidden = docs.where(tested).select("doc_id")
    found = bayes.judged(docs, labels.join(hidden, "doc_id", "left_anti")).join(labels, "doc_id").join(hidden, "doc_id").collect()
    assert len(found) > 50
    assert np.mean([(r.quality_probability >= 0.5) == bool(r.quality) for r in found]) > 0.9
    assert np.mean([(r.toxic_probability > 0.5) == bool(r.toxic) for r in found]) > 0.9


def test_sparse_sites_are_shrunk_towards_their_host(spark):
    words = "plain sentence number"
    rows = [(i, f"{words} {i}", "en" if i % 50 else "xx", "good" if i % 2 else "bad") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 2 == 1 or i % 4 == 0)) for i in range(400)], "doc_id long, quality int")
    found = bayes.scored(docs, labels, names=("quality",), most_per_class=20).collect()
    rate = {(r.host, r.path): (r.quality_host_rate, r.quality_path_rate) for r in found}
    assert rate["good", "en"][0] > 0.9 and 0.4 < rate["bad", "en"][0] < 0.6
    assert abs(rate["bad", "xx"][1] - rate["bad", "xx"][0]) < 0.3


def test_classifier_of_edge_documents(spark, edge_docs, no_docs, edge_rows):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 1), (3, None, None), (5, 0, None), (7, 0, 1)], schema)
    found = bayes.judged(edge_docs, labels)
    assert found.count() == len(edge_rows) and found.where("kept IS NULL").count() == 0
    assert bayes.judged(edge_docs, labels.limit(0)).count() == len(edge_rows)
    assert bayes.judged(no_docs, labels).count() == 0


def test_both_ways_to_look_sites_up_agree(spark, edge_docs, monkeypatch):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    one = sorted(map(str, bayes.judged(edge_docs, labels).collect()))
    monkeypatch.setattr(bayes, "BROADCAST_ROWS", 0)
    assert sorted(map(str, bayes.judged(edge_docs, labels).collect())) == one


# --- lattice -------------------------------------------------------------------------------


def all_cuts(text, pieces):
    if not text:
        return [()]
    return [(text[:n], *rest) for n in range(1, len(text) + 1) if text[:n] in pieces for rest in all_cuts(text[n:], pieces)]


@settings(max_examples=40)
@given(st.text(alphabet="abc", min_size=1, max_size=7), st.integers(0, 9))
def test_forward_recursion_sums_all_cuts(word, seed):
    names = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "ca", "<0x61>"]
    p = np.random.default_rng(seed).dirichlet(np.ones(len(names)))
    model = lattice.Lattice(names, np.log(p))
    chance = dict(zip(names, p, strict=True))
    cuts = all_cuts("▁" + word, set(names))
    total = sum(math.prod(chance[x] for x in cut) for cut in cuts)
    assert model.score(word, math.log(0.25), math.log(0.5)) == pytest.approx(math.log(0.25 * total + 0.5))
    uses, expected = [0.0] * len(names), Counter()
    model.expect(word, uses)
    for cut in cuts:
        for x in cut:
            expected[x] += math.prod(chance[y] for y in cut) / total
    assert uses == pytest.approx([expected[n] for n in names])


def plain_base(docs):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "\n"] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (held[i], len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }


def test_scores(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = plain_base(docs)
    found = QUERIES["op8_lattice_scoring"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        assert tuple(r)[1:5] == expected[r.doc_id][:4] and r.base_score == pytest.approx(expected[r.doc_id][4])
        assert -20 * r.n_tokens < r.score < 0


def plain_marginal(word, chance, byte):
    """Probability of all cuts of a word, from the chances of its prefixes."""
    text = "▁" + word
    upto = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            own = chance.get(text[i:j])
            if own is None and j == i + 1:
                own = math.prod(byte[b] for b in text[i].encode())
            upto[j] += upto[i] * (own or 0.0)
    return upto[-1]


def test_scores_equal_plain_python(spark):
    texts = ["the cat the dog", "The unseen zebra É\U0001f600", None, "a a a b", "dog dog internationalisation", "x" * 70 + " cat", "b 字 b", "the zebra sleeps"]
    docs = list(enumerate(texts * 2))
    found = {r.doc_id: r for r in lattice.scored(spark.createDataFrame(docs, "doc_id long, text string"), PIECES, rounds=0).collect()}
    names = lattice.pieces_of(PIECES)
    weight = [1 / max(i - 259 + 2, 2) if n else 0.0 for i, n in enumerate(names)]
    total = sum(weight)
    byte = {int(n[3:5], 16): w / total for n, w in zip(names, weight, strict=True) if len(n) == 6 and n.startswith("<0x")}
    chance = {n: w / total for n, w in zip(names, weight, strict=True) if n and not (len(n) == 6 and n.startswith("<0x"))}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in docs}
    learned = [i for i in words if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in learned for w in words[i])
    n = sum(counts.values()) + len(learned)
    new = (sum(c == 1 for c in counts.values()) + 0.5) / (n + 1)
    for i, own in words.items():
        end = math.log10((1 - new) * (len(learned) + 0.5) / (n + 1))
        pure = [plain_marginal(w, chance, byte) for w in own]
        mixed = [new * p + (1 - new) * counts[w] / n for w, p in zip(own, pure, strict=True)]
        assert found[i].score == pytest.approx(sum(map(math.log10, mixed)) + end)
        assert found[i].lattice_score == pytest.approx(sum(map(math.log10, pure)) + end)


@settings(max_examples=30)
@given(st.lists(st.text(alphabet="abc\xe9d", min_size=1, max_size=6), min_size=1, max_size=60), st.integers(0, 9))
def test_words_at_once_equal_words_one_by_one(words, seed):
    names = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "ca", *(f"<0x{b:02X}>" for b in (0xC3, 0xA9, 0x64))]
    p = np.random.default_rng(seed).dirichlet(np.ones(len(names)))
    model = lattice.Lattice(names, np.log(p))
    one = [model.score(w, 0.0, -math.inf) for w in words * 9]
    assert model.marginals(words * 9) == pytest.approx(one)
    totals, single = np.zeros(len(names)), [0.0] * len(names)
    model.expect_all(words * 9, totals)
    for w in words * 9:
        model.expect(w, single)
    assert totals.tolist() == pytest.approx(single)


def test_scores_of_edge_documents(edge_docs, no_docs, edge_rows, monkeypatch):
    found = lattice.scored(edge_docs, PIECES, rounds=1).collect()
    assert len(found) == len(edge_rows) and all(r.n_tokens >= 1 and r.score < 0 for r in found)
    assert lattice.scored(no_docs, PIECES, rounds=1).count() == 0
    monkeypatch.setattr(lattice, "BLOCK_CHARS", 10)
    small_blocks = lattice.scored(edge_docs, PIECES, rounds=1).collect()
    key = lambda r: (r.doc_id or -1, r.n_tokens)
    for a, b in zip(sorted(found, key=key), sorted(small_blocks, key=key), strict=True):
        assert tuple(a)[:5] == tuple(b)[:5] and a.score == pytest.approx(b.score) and a.base_score == pytest.approx(b.base_score)


# --- packing -------------------------------------------------------------------------------


def check_pieces(rows, ids_of, window):
    for row in rows:
        ids = ids_of[row.doc_id]
        assert row.ids == ids[row.start : row.start + row.length].tobytes() and row.doc_tokens == len(ids)
    covered = sorted((r.doc_id, r.start, r.length) for r in rows)
    for doc, own in itertools.groupby(covered, key=lambda r: r[0]):
        own = list(own)
        assert [r[1] for r in own] == [0, *itertools.accumulate(r[2] for r in own[:-1])]
        assert sum(r[2] for r in own) == len(ids_of[doc])
    padding = 0
    by_window = itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id)
    for _, own in by_window:
        own = list(own)
        assert [r.offset for r in own] == [0, *itertools.accumulate(r.length for r in own[:-1])]
        size = sum(r.length for r in own)
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    return padding


def test_packing_covers_every_id_once(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids_of = {
        r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4") for r in docs.collect()
    }
    rows = packing.pack(docs.repartition(3), TOKENIZER).collect()
    assert check_pieces(rows, ids_of, 1024) == 0 and {r.doc_id for r in rows} == set(ids_of)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_windows_of_any_sizes(sizes):
    made = list(packing.windows_of(((i, np.arange(n, dtype="<u4")) for i, n in enumerate(sizes)), 16))
    assert all(0 < sum(len(p[3]) for p in w) <= 16 for w in made)
    assert sum(sum(len(p[3]) for p in w) < 16 for w in made) <= 4
    got = Counter((p[0], int(x)) for w in made for p in w for x in p[3])
    assert got == Counter((i, x) for i, n in enumerate(sizes) for x in range(n))
    assert all(int(p[3][0]) == p[1] for w in made for p in w)


def test_choice_minimises_the_sum_of_squares():
    levels, rng = packing.Levels(32), np.random.default_rng(3)
    for i in range(400):
        size = int(rng.integers(1, 32))
        before = levels.counts[:32].copy()
        sums = {}
        for level in [0, *np.flatnonzero(before[1:]) + 1]:
            if level + size <= 32:
                after = before.copy()
                after[level] -= level > 0
                if level + size < 32:
                    after[level + size] += 1
                sums[int(level)] = int((after**2).sum())
        assert sums[levels.choose(size)] == min(sums.values())
        levels.place((i, 0, size, np.zeros(size)), size)


@settings(deadline=None)
@given(st.text(max_size=80))
def test_encoder_equals_the_tokenizers_library(text):
    own = TOKENIZERS.setdefault("own", packing.encoder(TOKENIZER))
    other = TOKENIZERS.setdefault("other", Tokenizer.from_file(TOKENIZER))
    other.encode_special_tokens = True
    assert own.encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids


def test_packing_of_edge_documents(edge_docs, no_docs, edge_rows):
    rows = packing.pack(edge_docs, TOKENIZER).collect()
    assert sum(r.start == 0 for r in rows) == len(edge_rows)
    assert packing.pack(no_docs, TOKENIZER).count() == 0
    assert public_tokenizers.path("byte_bpe_50k.json") == TOKENIZER


def test_packing_of_very_long_white_space(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    words = " ".join(f"word{i}" for i in range(50))
    texts = [words + gap * 1_200_000 + "<|endoftext|> end" for gap in ("\n", " ")]
    ids_of = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in enumerate(texts)}
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER).collect()
    assert check_pieces(rows, ids_of, 1024) == 0 and {r.doc_id for r in rows} == {0, 1}


def test_texts_that_the_fast_encoder_fails_on(monkeypatch):
    class Failing:
        def encode_ordinary(self, text):
            raise type("PanicException", (BaseException,), {})

    text = "a  b <|endoftext|>"
    expected = packing.encode_function(TOKENIZER)(text)
    monkeypatch.setattr(packing, "encoder", lambda path: Failing())
    assert packing.encode_function(TOKENIZER)(text) == expected


def test_runs_around_the_safe_length_encode_alike():
    encode = packing.encode_function(TOKENIZER)
    other = Tokenizer.from_file(TOKENIZER)
    for n in (packing.SAFE_RUN - 1, packing.SAFE_RUN, packing.SAFE_RUN + 1):
        text = "a" + "\n" * n + "b" + " " * (n - 1)
        assert encode(text) == other.encode(text, add_special_tokens=False).ids
