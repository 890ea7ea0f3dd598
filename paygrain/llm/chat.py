"""Render conversations, encode them once, and mask the losses by offsets.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>``. The three marks are added
tokens, so text is never merged with them. A control string inside a role or text gets a
backslash after its first character, and one more where it has some already; taking one away
restores it. The whole conversation is encoded at once; the spans of the assistant's texts, which
are in order, are cut with the token offsets by binary search, and the tokens inside count.

Rows of a conversation are ordered by turn, then role and text, nulls first. Defined cases: a
null text or role is empty; a null ``conv_id`` is a conversation; repeated rows are turns of
their own; an empty table gives no conversations. A conversation is one record of the result and
is held in memory by one task while it is rendered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
RENDERED = (
    "formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"
)
AT_ONCE = 64


def control_pattern(controls: Sequence[str]) -> re.Pattern:
    """A control string, possibly with backslashes after its first character."""
    return re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in sorted(controls, key=len)[::-1]))


def escape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(turns: Sequence[tuple[str, str]], pattern: re.Pattern) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of the texts that count."""
    parts, spans, length = [], [], 0
    for role, text in turns:
        head, body = START + escape(role, pattern) + SEPARATOR, escape(text, pattern)
        start = length + len(head)
        length = start + len(body) + len(END)
        parts += [head, body, END]
        if role == LOSS_ROLE:
            spans.append((start, start + len(body)))
    return "".join(parts), spans


def mask(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """Tokens that lie in one of the spans; tokens and spans are in order."""
    marked = np.zeros(len(starts), dtype=bool)
    if spans:
        low, high = np.array(spans).T
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        for a, b in zip(first, last, strict=True):
            marked[a:b] = True
    return marked


def turns_of(formatted: str, pattern: re.Pattern) -> list[tuple[str, str]]:
    """Read the turns back from a formatted conversation."""
    found = []
    for turn in formatted.split(END)[:-1]:
        role, text = turn.removeprefix(START).split(SEPARATOR)
        found.append((unescape(role, pattern), unescape(text, pattern)))
    return found


def loss_text(formatted: str, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray, pattern: re.Pattern) -> str:
    """The text under the mask, unescaped. Tokens that share a character are read as one."""
    runs: list[list[int]] = []
    for a, b in zip(starts[marked].tolist(), ends[marked].tolist(), strict=True):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return "".join(unescape(formatted[a:b], pattern) for a, b in runs)


def chat_tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, with the marks of the template as tokens of their own."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(mark, normalized=False, special=True) for mark in (START, SEPARATOR, END)])
    return tokenizer


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, controls: Sequence[str] = CONTROL
) -> DataFrame:
    """One row per conversation: conv_id, formatted text, token ids and offsets, loss mask.

    Offsets count code points of the formatted text.
    """
    turn = F.struct("turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    id_type = conversations.schema["conv_id"].dataType.simpleString()

    def rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern, tokenizer = control_pattern(controls), chat_tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                part = batch.iloc[at : at + AT_ONCE]
                made = [render(list(zip(r, t, strict=True)), pattern) for r, t in zip(part["roles"], part["texts"], strict=True)]
                rows = []
                for (text, spans), code in zip(
                    made, tokenizer.encode_batch([m[0] for m in made], add_special_tokens=False), strict=True
                ):
                    starts, ends = np.array(code.offsets, dtype=np.int32).reshape(-1, 2).T
                    rows.append((text, code.ids, starts, ends, mask(starts, ends, spans)))
                columns = ["formatted", "token_ids", "token_starts", "token_ends", "loss_mask"]
                yield pd.concat([part[["conv_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=columns)], axis=1)

    return whole.mapInPandas(rendered, f"conv_id {id_type}, {RENDERED}")


def read_back(rendered: DataFrame, controls: Sequence[str] = CONTROL) -> DataFrame:
    """Turns and loss text of formatted conversations, from nothing but the rendered rows."""
    id_type = rendered.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = control_pattern(controls)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                turns = turns_of(row.formatted, pattern)
                under = loss_text(row.formatted, row.token_starts, row.token_ends, row.loss_mask, pattern)
                rows.append((row.conv_id, [t[0] for t in turns], [t[1] for t in turns], under, len(row.formatted)))
            yield pd.DataFrame(rows, columns=["conv_id", "roles", "texts", "loss_text", "formatted_chars"])

    return rendered.mapInPandas(
        read, f"conv_id {id_type}, roles array<string>, texts array<string>, loss_text string, formatted_chars long"
    )
