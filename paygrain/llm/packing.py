"""Pack tokenised documents into windows by the sum-of-squares rule.

Each task packs the documents of its partition as they come and holds a level array: for every
fill level the number of windows filled that far. A document's last piece goes to the level that
makes the sum of the squared counts of partly filled windows smallest, a new window being level
zero; of equal sums the fuller level is taken. Longer documents fill whole windows first. When
the partition ends, pieces of the emptiest open windows are cut to fill the fullest, and what is
left over is cut into windows whose lengths are powers of two, which need no padding.

Texts are encoded by the merges of a byte-level BPE file through ``tiktoken``, which gives the
same ids as the ``tokenizers`` library several times faster (tests compare the two). Its pattern
engine gives up on white-space runs of about a million characters, so texts with a run longer
than ``SAFE_RUN``, and any other that it fails on, are encoded by ``tokenizers`` itself. Strings
of control tokens inside a text are ordinary text.

Defined cases: a null or empty text is its end id only; a null ``doc_id`` is carried along;
repeated rows are packed each; an empty table gives no windows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from paygrain.llm.common import free_name

WINDOW = 1024
END_ID = 0
SEQUENCE_SHIFT = 33  # the windows of a partition are numbered in the lower 33 bits
ROWS_OUT = 4096
SAFE_RUN = 100_000
LONG_RUN = re.compile(rf"(?<!\s)\s{{{SAFE_RUN}}}")  # tried at the start of a run only
SPECIAL = re.compile(r"<\|\w+\|>")
PIECES = "start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    # A byte is written as its character, or where that is not shown as one from 256 on.
    byte_of = {b: chr(b) for b in shown} | {256 + i: chr(b) for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = {t.translate(byte_of).encode("latin-1"): n for t, n in vocabulary.items() if not SPECIAL.fullmatch(t)}
    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_function(path: str) -> Callable[[str], list[int]]:
    """Text to ids, for texts of any kind; ``tokenizers`` is loaded when a text needs it."""
    fast, slow = encoder(path).encode_ordinary, None

    def encode(text: str) -> list[int]:
        nonlocal slow
        if len(text) < SAFE_RUN or not LONG_RUN.search(text):
            try:
                return fast(text)
            except BaseException as error:  # a panic of the library is no Exception
                if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
                    raise
        if slow is None:
            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
        return slow.encode(text, add_special_tokens=False).ids

    return encode


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.weights = np.ones(window + 1, dtype=np.int64)  # 2 * count + 1; a full window weighs 0
        self.weights[window] = 0
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def choose(self, size: int) -> int:
        """The level whose window should get ``size`` more ids; 0 is a new window."""
        last = self.window - size
        change = self.weights[size + 1 :] - self.weights[1 : last + 1] + 2
        change[self.counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        if last and change.min() <= self.weights[size]:
            return last - int(change[::-1].argmin())
        return 0

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece into the chosen window; the window, if that filled it."""
        level = self.choose(size)
        window = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
            self.weights[level] -= 2
        window.append(piece)
        level += size
        if level == self.window:
            return window
        self.open[level].append(window)
        self.counts[level] += 1
        self.weights[level] += 2
        return None

    def close(self) -> Iterator[list]:
        """Windows made of all that is still open: full ones, then powers of two."""
        yield from refill([w for level in range(self.window, 0, -1) for w in self.open[level]], self.window)


def cut(pieces: list, length: int) -> list:
    """Take ``length`` ids off the end of a list of pieces; the piece at the cut is divided."""
    taken = []
    while length:
        doc, start, tokens, ids = pieces.pop()
        taken.append((doc, start, tokens, ids[:length]))
        if length < len(ids):
            pieces.append((doc, start + length, tokens, ids[length:]))
        length -= min(length, len(ids))
    return taken


def refill(rest: list[list], window: int) -> Iterator[list]:
    """Fill the fullest windows with cuts of the emptiest; the last one ends in powers of two."""
    fills = [sum(len(piece[3]) for piece in pieces) for pieces in rest]
    head, tail = 0, len(rest) - 1
    while head < tail:
        take = min(window - fills[head], fills[tail])
        rest[head] += cut(rest[tail], take)
        fills[head] += take
        fills[tail] -= take
        tail -= not fills[tail]
        if fills[head] == window:
            yield rest[head]
            head += 1
    if head == tail:
        for bit in range(fills[head].bit_length(), -1, -1):
            if fills[head] >> bit & 1:
                yield cut(rest[head], 1 << bit)


def windows_of(documents: Iterator[tuple], window: int) -> Iterator[list]:
    """Pack (doc_id, ids) pairs; a window is a list of (doc_id, start, doc_tokens, ids)."""
    levels = Levels(window)
    for doc, ids in documents:
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [(doc, start, len(ids), ids[start : start + window])]
        if whole < len(ids):
            full = levels.place((doc, whole, len(ids), ids[whole:]), len(ids) - whole)
            if full:
                yield full
    yield from levels.close()


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, sequence_id and offset.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers, ``start`` counts the
    ids of the document before it, ``offset`` those of the window. Documents are not shuffled.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", docs["text"].cast("string").alias(free_name(docs, "text__")))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = encode_function(tokenizer_path)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                yield doc.as_py(), np.array([*ids, end_id], dtype="<u4")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << SEQUENCE_SHIFT
        rows: list[tuple] = []
        for pieces in windows_of(encoded(batches), window):
            offset = 0
            for doc, start, tokens, ids in pieces:
                rows.append((doc, start, len(ids), tokens, ids.tobytes(), sequence, offset))
                offset += len(ids)
            sequence += 1
            if len(rows) >= ROWS_OUT:
                yield as_batch(rows)
                rows = []
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
        kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        kinds[0] = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    return own.mapInArrow(packed, f"doc_id {id_type}, {PIECES}")
