"""Chat formatting with offset-aligned loss masks (operator 4).

A conversation is rendered as one text, whose turns are known as sorted spans of code points. The whole text is encoded
once with offsets; a binary search of the token offsets in the sorted spans of the assistant texts gives the loss mask.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. Inside roles and texts ``<|`` becomes ``<\\|``, and so that
this can be undone, ``<`` with backslashes before ``|`` gets one backslash more. No text can open or close a turn.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import text_or_empty, tokenizer_file

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"
TO_ESCAPE, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    """``<``, any backslashes and ``|`` get one backslash more: ``<|`` never stays, and nothing becomes ambiguous."""
    return TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the texts under the loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + MIDDLE, escape(text)
        if role == LOSS_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside turns")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text outside turns")
    return turns


def open_tokenizer(file: str):
    """Byte-level BPE with the template's marks as tokens of their own and offsets that keep leading spaces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors
    tokenizer = Tokenizer.from_file(file)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, MIDDLE, END)])
    return tokenizer


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether a token (sorted ``start, end`` rows) lies in one of the sorted spans: binary search, no scan."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    starts, ends = np.array(spans).T
    at = np.searchsorted(starts, offsets[:, 0], side="right") - 1
    return (at >= 0) & (offsets[:, 1] <= ends[at]) & (offsets[:, 1] > offsets[:, 0])


def masked_texts(formatted: str, offsets: np.ndarray, mask: np.ndarray, spans: list[tuple[int, int]]) -> list[str]:
    """Text under the mask, by loss span, unescaped. Tokens that share a character (parts of its bytes) give it once."""
    taken = offsets[mask]
    if not len(taken):
        return []
    starts = np.array([s for s, _ in spans])
    span = np.searchsorted(starts, taken[:, 0], side="right") - 1
    begins = np.maximum(taken[:, 0], np.concatenate([[0], np.maximum.accumulate(taken[:, 1])[:-1]]))
    parts: list = [[] for _ in spans]
    for i, a, b in zip(span.tolist(), begins.tolist(), taken[:, 1].tolist()):
        parts[i].append(formatted[a:b])
    return [unescape("".join(p)) for p in parts]


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Conversations of a partition sorted by ``conv_id, turn``: (id, [(role, text), ...])."""
    held, turns = None, []
    for batch in batches:
        for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
            conv = None if pd.isna(conv) else int(conv)
            if turns and conv != held:
                yield held, turns
                turns = []
            held = conv
            turns.append((role, text))
    if turns:
        yield held, turns


FORMATTED = "conv_id long, formatted string, ids array<int>, loss_mask array<boolean>, spans array<struct<start:int,end:int>>, masked array<string>"


def format_chats(rows: DataFrame, file: str | None = None, batch: int = 64) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text``; other columns ignored).

    ``formatted``: the rendered text; ``ids``: its tokens; ``loss_mask``: per token; ``spans``: of the assistant texts;
    ``masked``: the text under the mask by span. Turns are ordered by ``turn``, ties by role and text, null turns first; null roles
    and texts count as empty; rows with null ``conv_id`` are one conversation. An empty table gives no rows. A
    conversation is one unit of work: its text is encoded as a whole, so it has to fit into a task.
    """
    name = file or tokenizer_file("byte_bpe_50k.json")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, held = open_tokenizer(name), []

        def out():
            rendered = [render(t) for _, t in held]
            encoded = tokenizer.encode_batch([r[0] for r in rendered], add_special_tokens=False)
            rows = []
            for (conv, _), (text, spans), code in zip(held, rendered, encoded):
                offsets = np.array(code.offsets, dtype=np.int64).reshape(-1, 2)
                mask = loss_mask(offsets, spans)
                rows.append((conv, text, code.ids, mask.tolist(), [{"start": s, "end": e} for s, e in spans],
                             masked_texts(text, offsets, mask, spans)))
            frame = pd.DataFrame(rows, columns=["conv_id", "formatted", "ids", "loss_mask", "spans", "masked"])
            return frame.assign(conv_id=pd.array(frame["conv_id"], "Int64"))
        for conversation in _conversations(batches):
            held.append(conversation)
            if len(held) == batch:
                yield out()
                held = []
        if held:
            yield out()
    narrow = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         text_or_empty("role").alias("role"), text_or_empty().alias("text"))
    return (narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
            .mapInPandas(run, FORMATTED))


def digests(formatted: DataFrame) -> DataFrame:
    """Read each formatted conversation back and count and digest what comes out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, text, masked in zip(batch["conv_id"], batch["formatted"], batch["masked"]):
                turns = read_back(text)
                loss = "".join(masked)
                rows.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield out.assign(conv_id=pd.array([None if pd.isna(c) else int(c) for c in out["conv_id"]], "Int64"))
    return formatted.select("conv_id", "formatted", "masked").mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
