"""Language-model scores as marginal probabilities over all subword segmentations.

The pieces come from an existing public vocabulary. A word, with a mark for its beginning, can be
cut into pieces in many ways; its probability is the sum over all of them of the product of the
pieces' probabilities, by a forward recursion in log space, over all words of one length at once. A word of the training texts has one
more arc, from its beginning to its end, with its share of the training tokens; the share of
words that are there once is what the pieces get instead. A text is its words and one end, so its
probability is a product over words, and those of all texts add up to one.

The pieces' probabilities start from their rank in the vocabulary and are fitted to the distinct
words of all training texts by expectation-maximisation, in tasks; only sums per piece reach the
driver.

Counts of words cover all training texts. Texts are read once, in blocks. A block sends each of
its distinct words once to be counted and scored, and gets the figures back for its documents,
which are kept as indexes into the block's words. A frequent word is one row per block.

Training texts are those whose CRC-32 of the id, as text, leaves a remainder other than
``held_out`` by ``folds``. Words are told apart with A-Z in lower case. Characters that have no
piece of their own are read as their bytes.

Defined cases: a null text is empty and consists of its end; a null ``doc_id`` counts as the
empty text, which is trained on; repeated rows count and are scored each; an empty table gives an
empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrain.llm.common import Scratch, free_name
from paygrain.session import materialise

FOLDS, HELD_OUT = 7, 2
ROUNDS = 2  # of expectation-maximisation
SMOOTHING = 0.1  # added to every piece's expected count
BLOCK_CHARS = 1 << 25  # a block ends with the document that passes this many characters
BLOCK_SHIFT = 33
EMPTY = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
FIRST_RANK = 259  # ids below are bytes and control symbols
BEGIN = "▁"
CHARACTER_BITS = 21
WORDS_AT_ONCE = 1 << 16
FEW_WORDS, LONG_WORD = 8, 64  # fewer words of a length, or longer ones, are worked on one by one


def pieces_of(path: str) -> list[str]:
    """The pieces by id; control symbols are empty strings."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return ["" if model.is_unknown(i) or model.is_control(i) else n for i, n in enumerate(names)]


class Lattice:
    """Segmentations of a word into pieces with given natural-log probabilities.

    The pieces are a trie of ``character -> (piece id or None, following characters)``.
    """

    def __init__(self, pieces: list[str], log_p: np.ndarray) -> None:
        self.log_p, self.chance = log_p.tolist(), log_p
        self.trie: dict = {}
        self.bytes: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            if len(piece) == 6 and piece.startswith("<0x"):
                self.bytes[int(piece[3:5], 16)] = i
            elif piece:
                node = self.trie
                for c in piece[:-1]:
                    node = node.setdefault(c, [None, {}])[1]
                node.setdefault(piece[-1], [None, {}])[0] = i
        # The same trie as arrays: steps from a state by a character, ascending, and each state's piece.
        steps, self.piece, waiting = [], [-1], [(0, self.trie)]
        for state, node in waiting:
            for c, (piece, below) in node.items():
                steps.append((state << CHARACTER_BITS | ord(c), len(self.piece)))
                waiting.append((len(self.piece), below))
                self.piece.append(-1 if piece is None else piece)
        table = np.array(sorted(steps), dtype=np.int64).reshape(-1, 2)
        self.step, self.next, self.piece = table[:, 0].copy(), table[:, 1].copy(), np.array(self.piece)

    def arcs(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces, log probabilities) over words of one length, by start, then end.

        ``codes`` has a row of code points per word. A character without a piece of its own is an
        arc too, with the bytes' probability and ``-1 - code point`` in place of a piece.
        """
        size = codes.shape[1]
        for i in range(size):
            rows = np.arange(len(codes))
            state = np.zeros(len(codes), dtype=np.int64)
            for j in range(i, size):
                key = state << CHARACTER_BITS | codes[rows, j]
                at = np.minimum(np.searchsorted(self.step, key), len(self.step) - 1)
                there = self.step[at] == key
                if j == i:
                    alone = np.ones(len(codes), dtype=bool)
                    alone[there] = self.piece[self.next[at[there]]] < 0
                    if alone.any():
                        own, code = np.flatnonzero(alone), codes[alone, i]
                        value, of = np.unique(code, return_inverse=True)
                        chance = np.array([sum(self.log_p[x] for x in self.as_bytes(chr(c))) for c in value])
                        yield i, i + 1, own, -1 - code, chance[of]
                rows, state = rows[there], self.next[at[there]]
                if not len(rows):
                    break
                piece = self.piece[state]
                found = piece >= 0
                if found.any():
                    yield i, j + 1, rows[found], piece[found], self.chance[piece[found]]

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Log probabilities of all beginnings of the words, summed over their cuts, and the arcs."""
        alpha = np.full((len(codes), codes.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0.0
        arcs = []
        for i, j, rows, piece, chance in self.arcs(codes):
            alpha[rows, j] = np.logaddexp(alpha[rows, j], alpha[rows, i] + chance)
            arcs.append((i, j, rows, piece, chance))
        return alpha, arcs

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Indexes of words of one length with their code points; of few or long ones the indexes alone."""
        sizes = np.array([len(w) + 1 for w in words])
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            if len(own) < FEW_WORDS or size > LONG_WORD:
                yield own, None
                continue
            text = "".join([BEGIN + words[i] for i in own.tolist()])
            yield own, np.frombuffer(text.encode("utf-32-le"), dtype="<u4").reshape(len(own), size).astype(np.int64)

    def marginals(self, words: list[str]) -> np.ndarray:
        """The log probability of each word, summed over all its cuts."""
        out = np.zeros(len(words))
        for own, codes in self.groups(words):
            if codes is None:
                out[own] = [self.score(words[i], 0.0, -math.inf) for i in own.tolist()]
            else:
                out[own] = self.forward(codes)[0][:, -1]
        return out

    def expect_all(self, words: list[str], totals: np.ndarray) -> None:
        """Add the expected uses of each piece in all words to ``totals``."""
        for own, codes in self.groups(words):
            if codes is None:
                single = [0.0] * len(totals)
                for i in own.tolist():
                    self.expect(words[i], single)
                totals += single
                continue
            alpha, arcs = self.forward(codes)
            share = np.zeros_like(alpha)  # of the probability that goes through each position
            share[:, -1] = 1.0
            for i, j, rows, piece, chance in reversed(arcs):
                part = share[rows, j] * np.exp(alpha[rows, i] + chance - alpha[rows, j])
                share[rows, i] += part
                if piece[0] >= 0:
                    totals += np.bincount(piece, part, minlength=len(totals))
                else:
                    for code, uses in zip(*sums_of(-1 - piece, part), strict=True):
                        for x in self.as_bytes(chr(code)):
                            totals[x] += uses

    def as_bytes(self, character: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in character.encode())

    def score(self, word: str, pieces: float, whole: float) -> float:
        """Log probability of a word: ``pieces`` is what all cuts together get, ``whole`` its own arc."""
        text, log_p, trie = BEGIN + word, self.log_p, self.trie
        size = len(text)
        paths: list[list[float]] = [[] for _ in range(size + 1)]
        paths[0].append(pieces)
        for i in range(size):
            into = paths[i]
            before = into[0] if len(into) == 1 else log_sum(into)
            step, j = trie.get(text[i]), i + 1
            if step is None or step[0] is None:
                paths[j].append(before + sum([log_p[x] for x in self.as_bytes(text[i])]))
            while step is not None:
                piece, node = step
                if piece is not None:
                    paths[j].append(before + log_p[piece])
                if j == size:
                    break
                step = node.get(text[j])
                j += 1
        if whole > -math.inf:
            paths[size].append(whole)
        return log_sum(paths[size])

    def expect(self, word: str, totals: list[float]) -> None:
        """Add the expected uses of each piece in the word to ``totals``."""
        text, log_p, trie, exp = BEGIN + word, self.log_p, self.trie, math.exp
        size = len(text)
        paths: list[list[float]] = [[] for _ in range(size + 1)]
        arcs: list[list[tuple]] = [[] for _ in range(size + 1)]  # (start, piece or bytes), one for each path
        alpha = [0.0] * (size + 1)
        for i in range(size):
            if i:
                into = paths[i]
                alpha[i] = into[0] if len(into) == 1 else log_sum(into)
            before = alpha[i]
            step, j = trie.get(text[i]), i + 1
            if step is None or step[0] is None:
                ids = self.as_bytes(text[i])
                paths[j].append(before + sum([log_p[x] for x in ids]))
                arcs[j].append((i, ids))
            while step is not None:
                piece, node = step
                if piece is not None:
                    paths[j].append(before + log_p[piece])
                    arcs[j].append((i, piece))
                if j == size:
                    break
                step = node.get(text[j])
                j += 1
        alpha[size] = log_sum(paths[size])
        share = [0.0] * size + [1.0]  # of the probability that goes through each position
        for j in range(size, 0, -1):
            here = share[j]
            if not here:
                continue
            total, into = alpha[j], paths[j]
            for (i, piece), path in zip(arcs[j], into):  # noqa: B905 - of one length
                part = here if len(into) == 1 else here * exp(path - total)
                share[i] += part
                if type(piece) is int:
                    totals[piece] += part
                else:
                    for x in piece:
                        totals[x] += part


def sums_of(names: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    """The different names and the sum of each one's values."""
    name, of = np.unique(names, return_inverse=True)
    return name.tolist(), np.bincount(of, values).tolist()


def in_portions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together until they have ``WORDS_AT_ONCE`` rows."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += len(batch)
        if size >= WORDS_AT_ONCE:
            yield pd.concat(waiting, ignore_index=True)
            waiting, size = [], 0
    if size:
        yield pd.concat(waiting, ignore_index=True)


def log_sum(values: list[float]) -> float:
    """Logarithm of the sum of exponentials."""
    if len(values) == 1:
        return values[0]
    if not values:
        return -math.inf
    top = max(values)
    return top if top == -math.inf else top + math.log(sum([math.exp(v - top) for v in values]))


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case: white space and case of bytes are those of ASCII."""
    return text.encode().lower().split()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in one, two or four bytes each, after one that says how many."""
    width = next(w for w in (1, 2, 4) if not len(values) or int(values.max()) < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def in_training(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS != HELD_OUT


def blocks(docs: DataFrame) -> DataFrame:
    """One row per document, with indexes into its block's words, and one per block, with those.

    Indexes are ascending and stored as differences, with their counts, in as few bytes as fit.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", docs["text"].cast("string").alias(free_name(docs, "text__")))
    id_arrow = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    kinds = [
        ("block", pa.int64()), ("doc_id", id_arrow), ("held_out", pa.bool_()), ("n_words", pa.int64()),
        ("at", pa.binary()), ("times", pa.binary()), ("words", pa.list_(pa.string())), ("trained", pa.list_(pa.int64())),
    ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BLOCK_SHIFT
        index: dict[bytes, int] = {}
        trained: list[tuple[np.ndarray, np.ndarray]] = []
        rows, chars = [], 0

        def finish() -> pa.RecordBatch:
            at, times = map(np.concatenate, zip(EMPTY, *trained, strict=True))
            counts = np.bincount(at, times, minlength=len(index)).astype(np.int64)
            return batch_of([*rows, (block, None, None, None, None, None, [w.decode() for w in index], counts)])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, text = doc.as_py(), text.as_py() or ""
                words = words_of(text)
                tally = Counter(words)
                for w in tally:
                    if w not in index:
                        index[w] = len(index)
                at = np.fromiter(map(index.__getitem__, tally), dtype=np.int64, count=len(tally))
                times = np.fromiter(tally.values(), dtype=np.int64, count=len(tally))
                order = np.argsort(at)
                at, times = at[order], times[order]
                training = in_training(doc)
                if training:
                    trained.append((at, times))
                rows.append((block, doc, not training, len(words), packed(np.diff(at, prepend=0)), packed(times), None, None))
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield finish()
                    block, index, trained, rows, chars = block + 1, {}, [], [], 0
        if rows:
            yield finish()

    return own.mapInArrow(
        encoded,
        f"block long, doc_id {id_type}, held_out boolean, n_words long, at binary, times binary, "
        "words array<string>, trained array<long>",
    )


def fitted(vocabulary: DataFrame, pieces: list[str], rounds: int) -> np.ndarray:
    """Natural-log probabilities of the pieces, fitted to the distinct training words."""
    rank = np.arange(len(pieces), dtype=float)
    weight = np.where([bool(p) for p in pieces], 1 / np.maximum(rank - FIRST_RANK + 2, 2), 0.0)
    log_p = normalised(weight)
    for _ in range(rounds):

        def expected(batches: Iterator[pd.DataFrame], log_p: np.ndarray = log_p) -> Iterator[pd.DataFrame]:
            lattice, totals = Lattice(pieces, log_p), np.zeros(len(pieces))
            for batch in in_portions(batches):
                lattice.expect_all(batch["word"].tolist(), totals)
            used = np.flatnonzero(totals)
            yield pd.DataFrame({"piece": used, "uses": totals[used]})

        sums = vocabulary.where("count > 0").select("word").mapInPandas(expected, "piece long, uses double")
        totals = np.zeros(len(pieces))
        for piece, uses in sums.groupBy("piece").agg(F.sum("uses")).collect():  # one row per piece at most
            totals[piece] = uses
        log_p = normalised(np.where(weight > 0, totals + SMOOTHING, 0.0))
    return log_p


def normalised(weight: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(weight / weight.sum())


def scored(docs: DataFrame, vocabulary_path: str, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score.

    ``base_score`` is the add-one unigram model over words, in log10 like ``score``;
    ``lattice_score`` is that of the pieces alone, without the arcs of whole words.
    """
    with Scratch(docs.sparkSession, "lattice") as scratch:
        return materialise(_scored(docs, vocabulary_path, rounds, scratch))


def _scored(docs: DataFrame, vocabulary_path: str, rounds: int, scratch: Scratch) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kept = scratch.table(blocks(docs))
    texts = kept.where("words IS NULL").drop("words", "trained")
    entries = kept.where("words IS NOT NULL").select("block", F.posexplode(F.arrays_zip("words", "trained")).alias("at", "w"))
    entries = entries.select("block", "at", F.col("w.words").alias("word"), F.col("w.trained").alias("count"))
    vocabulary = scratch.table(entries.groupBy("word").agg(F.sum("count").alias("count")))
    sums = [F.sum("count"), F.count_if(F.col("count") > 0), F.count_if(F.col("count") == 1)]
    totals = vocabulary.agg(*sums).first()
    ends = texts.where("NOT held_out").count()
    n, v = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    new = (totals[2] + 0.5) / (n + 1)  # the chance of a word that the training texts do not have
    pieces = pieces_of(vocabulary_path)
    log_p = fitted(vocabulary, pieces, rounds)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(pieces, log_p)
        for batch in in_portions(batches):
            pure = lattice.marginals(batch["word"].tolist())
            with np.errstate(divide="ignore"):
                whole = np.log((1 - new) * batch["count"].to_numpy(dtype=float) / max(n, 1))
            log10 = np.logaddexp(math.log(new) + pure, whole) / math.log(10)
            yield batch.assign(log10=log10, pure=pure / math.log(10))

    words = vocabulary.mapInPandas(score, "word string, count long, log10 double, pure double")
    figures = entries.select("block", "at", "word").join(words, "word").select(F.col("block").alias("of"), "at", "count", "log10", "pure")
    end_base = math.log10((ends + 1) / (n + v + 1))
    end_score = math.log10((1 - new) * (ends + 0.5) / (n + 1))
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "lattice_score"]

    def summed(documents: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        size = int(words["at"].max()) + 1 if len(words) else 0
        count, log10, pure = np.zeros(size, dtype=np.int64), np.zeros(size), np.zeros(size)
        count[words["at"]], log10[words["at"]], pure[words["at"]] = words["count"], words["log10"], words["pure"]
        base = np.log10((count + 1) / (n + v + 1))
        rows = []
        for row in documents.itertuples(index=False):
            at, times = np.cumsum(unpacked(row.at)), unpacked(row.times)
            known = int(times[count[at] > 0].sum()) + (ends > 0)
            rows.append((
                row.doc_id, bool(row.held_out), int(row.n_words) + 1, known, n, float(times @ base[at]) + end_base,
                float(times @ log10[at]) + end_score, float(times @ pure[at]) + end_score,
            ))
        return pd.DataFrame(rows, columns=columns)

    return texts.groupBy("block").cogroup(figures.groupBy("of")).applyInPandas(
        summed,
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, lattice_score double",
    )
