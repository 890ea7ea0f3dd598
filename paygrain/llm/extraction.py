"""Main text of HTML pages by a recurrent labeller of blocks.

A page is a sequence of text blocks. Each block becomes a vector: hashes of the element names,
classes and ids on its path, hashes of its words, and its shape. A bidirectional LSTM, in numpy,
reads the whole sequence both ways, so that each block is judged in the context of all others,
and a logistic output tells main text from the rest. The text of a page is its main blocks in
page order.

The labeller is trained on the driver, on pages made from the texts of at most ``sample_pages``
given pages in random layouts whose labels are known, and on those of the given pages that mark
their article by an element of that name. Pages longer than ``sample_chars`` are not sampled, so
what the driver holds is bounded; all pages are read and labelled whole, in batches.

Defined cases: a null, empty or textless page has an empty text; repeated rows give a row each;
other columns, whatever their names, are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrain.llm.blocks import Block, blocks_of
from paygrain.llm.layouts import Layouts

SAMPLE_PAGES = 200
SAMPLE_CHARS = 50_000
MADE_PAGES = 1200
LONGEST_TRAINED = 80  # blocks
EPOCHS, BATCH, RATE = 5, 32, 0.01
HIDDEN = 16
PATH_SIZE, WORD_SIZE, SHAPE_SIZE = 384, 64, 10
SIZE = PATH_SIZE + WORD_SIZE + SHAPE_SIZE
HASHES = 3
ROWS_AT_ONCE = 20_000
ASIDE = frozenset("nav aside footer header form menu".split())


def bucket(name: str, size: int, turn: int = 0) -> int:
    return zlib.crc32(f"{turn}{name}".encode()) % size


class Vectors:
    """Vectors of blocks. Paths recur, so the buckets of each are kept."""

    def __init__(self) -> None:
        self.paths: dict[tuple, list[int]] = {}

    def path(self, path: tuple) -> list[int]:
        found = self.paths.get(path)
        if found is None:
            names = {n for element in path for n in element}
            names |= {f"last {n}" for element in path[-1:] for n in element}
            found = sorted({bucket(n, PATH_SIZE, turn) for n in names for turn in range(HASHES)})
            self.paths[path] = found
        return found

    def of(self, blocks: Sequence[Block]) -> np.ndarray:
        made = np.zeros((len(blocks), SIZE), dtype=np.float32)
        for i, block in enumerate(blocks):
            text, row = block.text, made[i]
            row[self.path(block.path)] = 1
            words = text.split()
            hashes = np.fromiter(map(zlib.crc32, (w.encode() for w in words)), dtype=np.int64, count=len(words))
            counts = np.bincount(hashes % WORD_SIZE, minlength=WORD_SIZE)
            row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts / np.sqrt(max(len(words), 1)) / 4
            row[PATH_SIZE + WORD_SIZE :] = (
                np.log1p(len(text)) / 8, np.log1p(len(words)) / 6, block.linked / len(text), text[-1] in ".!?…\"'”",
                sum(map(str.isupper, text)) / len(text), sum(map(str.isdigit, text)) / len(text),
                text.count(",") / max(len(words), 1), "©" in text, i / len(blocks), 1 / len(blocks),
            )
        return made


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def padded(rows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as one array (step, sequence, value) and the mask of real steps."""
    longest = max(map(len, rows))
    mask = np.zeros((longest, len(rows), 1), dtype=np.float32)
    whole = np.zeros((longest, len(rows), *rows[0].shape[1:]), dtype=np.float32)
    for i, row in enumerate(rows):
        mask[: len(row), i], whole[: len(row), i] = 1, row
    return whole, mask


@dataclass
class Direction:
    """One LSTM; ``steps`` gives the order in which it reads. Gates: in, forget, out, new."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def forward(self, inputs: np.ndarray, mask: np.ndarray, steps: Sequence[int]) -> tuple[np.ndarray, list]:
        """States after each step, and what ``backward`` needs. Padding leaves the state alone."""
        n = inputs.shape[1]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states, kept = np.zeros((len(inputs), n, HIDDEN), np.float32), []
        for t in steps:
            z = inputs[t] + h @ self.u
            gates, new = sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            c2 = f * c + i * new
            th = np.tanh(c2)
            kept.append((h, c, i, f, o, new, th))
            m = mask[t]
            h, c = h + m * (o * th - h), c + m * (c2 - c)
            states[t] = h
        return states, kept

    def backward(self, d_states: np.ndarray, mask: np.ndarray, steps: Sequence[int], kept: list) -> tuple:
        """Gradients of the gate inputs and of ``u``."""
        dh = np.zeros_like(d_states[0])
        dc, du = np.zeros_like(dh), np.zeros_like(self.u)
        d_inputs = np.zeros((*d_states.shape[:2], 4 * HIDDEN), np.float32)
        for t, (h, c, i, f, o, new, th) in zip(reversed(steps), reversed(kept), strict=True):
            m = mask[t]
            dh = dh + d_states[t]
            dh_new, dc_new = dh * m, dc * m
            dc2 = dc_new + dh_new * o * (1 - th * th)
            dz = np.concatenate(
                [dc2 * new * i * (1 - i), dc2 * c * f * (1 - f), dh_new * th * o * (1 - o), dc2 * i * (1 - new * new)], 1
            )
            d_inputs[t] = dz
            du += h.T @ dz
            dh, dc = dh * (1 - m) + dz @ self.u.T, dc * (1 - m) + dc2 * f
        return d_inputs, du


class Labeller:
    """The two directions and the logistic output on both states."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1
        self.directions = [
            Direction(weights(SIZE, 4 * HIDDEN), weights(HIDDEN, 4 * HIDDEN), bias.copy()) for _ in range(2)
        ]
        self.v, self.d = weights(2 * HIDDEN, 1), np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [p for x in self.directions for p in (x.w, x.u, x.b)] + [self.v, self.d]

    def read(self, rows: Sequence[np.ndarray]) -> tuple:
        """Probabilities of main text (step, page, 1), and what the gradient needs."""
        whole, mask = padded(rows)
        orders = [range(len(whole)), range(len(whole) - 1, -1, -1)]
        runs = []
        for direction, steps in zip(self.directions, orders, strict=True):
            runs.append(direction.forward(whole @ direction.w + direction.b, mask, steps))
        states = np.concatenate([runs[0][0], runs[1][0]], axis=2)
        return sigmoid(states @ self.v + self.d), whole, mask, orders, runs, states

    def probabilities(self, rows: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Per page and block; pages of like length are read together."""
        order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: len(rows[i]))
        found: list[np.ndarray] = [np.zeros(0, np.float32)] * len(rows)
        at = 0
        while at < len(order):
            size = 1
            while at + size < len(order) and (size + 1) * len(rows[order[at + size]]) <= ROWS_AT_ONCE // 4:
                size += 1
            group = order[at : at + size]
            p = self.read([rows[i] for i in group])[0]
            for k, i in enumerate(group):
                found[i] = p[: len(rows[i]), k, 0]
            at += size
        return found

    def gradients(self, rows: Sequence[np.ndarray], labels: Sequence[np.ndarray]) -> list[np.ndarray]:
        p, whole, mask, orders, runs, states = self.read(rows)
        y, _ = padded([np.asarray(x, np.float32).reshape(-1, 1) for x in labels])
        d = (p - y) * mask / mask.sum()
        d_states = d @ self.v.T
        found = []
        for k, direction in enumerate(self.directions):
            part = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_inputs, du = direction.backward(part, mask, orders[k], runs[k][1])
            found += [np.tensordot(whole, d_inputs, ([0, 1], [0, 1])), du, d_inputs.sum((0, 1))]
        return [*found, np.tensordot(states, d, ([0, 1], [0, 1])), d.sum((0, 1))]


def train(rows: Sequence[np.ndarray], labels: Sequence[np.ndarray], epochs: int = EPOCHS, seed: int = 0) -> Labeller:
    """Fit a labeller with Adam on batches of pages of like length."""
    model, rng = Labeller(seed), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for k in rng.permutation(len(batches)):
            step += 1
            found = model.gradients([rows[i] for i in batches[k]], [labels[i] for i in batches[k]])
            norm = np.sqrt(sum(float((g * g).sum()) for g in found))
            for p, g, a, b in zip(model.parameters(), found, first, second, strict=True):
                g = g / max(norm, 1.0)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return model


def marked_article(blocks: Sequence[Block]) -> list[int] | None:
    """Labels of a page with an article element: what lies in it, and in nothing set aside there."""
    labels = []
    for block in blocks:
        elements = [e[0] for e in block.path]
        at = elements.index("article") if "article" in elements else -1
        labels.append(int(at >= 0 and not ASIDE & set(elements[at:])))
    return labels if any(labels) else None


def trained(pages: Sequence[str], made_pages: int = MADE_PAGES, seed: int = 0) -> Labeller:
    """A labeller for the texts of the given pages."""
    given = [blocks_of(page) for page in pages]
    layouts, vectors = Layouts([b.text for blocks in given for b in blocks], seed), Vectors()
    rows, labels = [], []
    for blocks in given:
        known = marked_article(blocks)
        if known and len(known) <= LONGEST_TRAINED:
            rows.append(vectors.of(blocks))
            labels.append(np.array(known))
    for _ in range(made_pages):
        page, known = layouts.page()
        blocks = blocks_of(page)
        if len(blocks) == len(known) <= LONGEST_TRAINED:
            rows.append(vectors.of(blocks))
            labels.append(np.array(known))
    return train(rows, labels, seed=seed)


def sampled(pages: DataFrame, sample_pages: int, sample_chars: int) -> list[str]:
    fits = F.octet_length("html").between(1, sample_chars)
    return [row[0] for row in pages.where(fits).select("html").take(sample_pages)]


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars and the number of blocks read and kept."""
    model = trained(sampled(pages, sample_pages, sample_chars))

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            while at < len(batch):
                part, blocks, size = at, [], 0
                while part < len(batch) and size < ROWS_AT_ONCE:
                    page = batch["html"].iloc[part]
                    blocks.append(blocks_of(page) if isinstance(page, str) else [])
                    size += len(blocks[-1])
                    part += 1
                vectors = Vectors()
                chances = model.probabilities([vectors.of(b) for b in blocks])
                rows = []
                for found, chance in zip(blocks, chances, strict=True):
                    kept = [b.text for b, p in zip(found, chance, strict=True) if p > 0.5]
                    text = "\n\n".join(kept)
                    rows.append((text, len(text), len(found), len(kept)))
                result = pd.DataFrame(rows, columns=["text", "n_chars", "n_blocks", "n_kept"])
                yield pd.concat([batch[["page_id", "url"]].iloc[at:part].reset_index(drop=True), result], axis=1)
                at = part

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    schema = f"{kinds}, text string, n_chars long, n_blocks long, n_kept long"
    return pages.select("page_id", "url", "html").mapInPandas(labelled, schema)
