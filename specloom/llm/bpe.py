"""Byte-level BPE encoding and decoding with recursive queries (operator 7).

Each Python worker has a DuckDB database in memory with the merge table (left id, right id, merged id = rank). Words not met
before become token-position rows, each with its neighbour; a recursive query joins them with the merge table and contracts
each word's leftmost pair of least rank until none is left. Decoding joins ids with the vocabulary and concatenates the bytes by
ordered aggregation. Spark deals out the documents; nothing is shuffled.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import WordCache, text_or_empty, tokenizer_file

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG_WORD = 512  # bytes; longer words are contracted in the same order with a heap, as each step of the query reads all rows
WORDS = 50_000  # words per recursive query
PART = 1 << 22  # characters of texts coded at once

ENCODE = """
WITH RECURSIVE state(step, word, pos, token, next_pos, next_token) AS (
  SELECT 0, word, pos, token, lead(pos) OVER w, lead(token) OVER w FROM start WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT word, min((merged::BIGINT << 32) | (pos << 16) | next_pos) AS pick
     FROM state JOIN merges ON token = left_id AND next_token = right_id GROUP BY word),
   gone AS MATERIALIZED (
     SELECT word, (pick >> 32)::INTEGER AS merged, ((pick >> 16) & 65535)::INTEGER AS spot, pos AS dropped, next_pos AS far_pos, next_token AS far_token
     FROM state JOIN best USING (word) WHERE pos = pick & 65535)
   SELECT step + 1, word, pos, CASE WHEN pos = spot THEN merged ELSE token END, CASE WHEN pos = spot THEN far_pos ELSE next_pos END,
     CASE WHEN pos = spot THEN far_token WHEN next_pos = spot THEN merged ELSE next_token END
   FROM state JOIN gone USING (word) WHERE pos <> dropped))
SELECT word, token
FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
ORDER BY word, pos"""

DECODE = """
SELECT part, string_agg(bytes, '' ORDER BY pos) AS text FROM ids JOIN vocabulary USING (id) GROUP BY part ORDER BY part"""
PARTS = 200  # parts concatenated in one group of the decoding query, with marks between them


def load_ranks(file: str) -> dict[bytes, int]:
    with open(file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RecursiveBpe:
    """Encoder and decoder of one task."""

    def __init__(self, file: str, half_size: int = 550_000):
        import duckdb
        import public_tokenizers
        import regex
        self.ranks = load_ranks(file)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.other_space = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        self.cut = re.compile(rf"(?<=[^ \n{self.other_space.pattern[1:-1]}]) ")
        self.plain = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+[.,]?").fullmatch  # a word of Latin letters, also with a stop behind
        self.bytes_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        merges = [(left, right, rank) for token, rank in self.ranks.items() for cut in range(1, len(token))
                  if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None]
        self._table("merges", dict(zip(("left_id", "right_id", "merged"), np.array(merges, dtype=np.int32).T)))
        self._table("vocabulary", {"id": np.array(list(self.ranks.values()), dtype=np.int32), "bytes": [t.hex() for t in self.ranks]})
        self.mark = max(self.ranks.values()) + 1
        self.db.execute("INSERT INTO vocabulary VALUES (?, '.')", [self.mark])
        starts_word = np.zeros(max(self.ranks.values()) + 1, dtype=bool)
        starts_word[[i for token, i in self.ranks.items() if token[:1] == b" "]] = True
        self.starts_word = starts_word
        self.words = WordCache(self.encode_words, half_size)
        self.first = WordCache(self.encode_spans, half_size // 20)  # spans from the start of a text
        self.later = WordCache(lambda words: self.encode_spans([" " + w for w in words]), half_size // 2)  # spans behind a space
        self.parts = WordCache(self.decode_parts, half_size // 2)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian 32 bit) of each word: its rank if it has one, else by the recursive query."""
        words = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = map(self.ranks.get, words)
        out = [None if rank is None else rank.to_bytes(4, "little") for rank in whole]
        short = [i for i, w in enumerate(words) if out[i] is None and len(w) <= LONG_WORD]
        for at in range(0, len(short), WORDS):
            part = short[at:at + WORDS]
            sizes = np.array([len(words[i]) for i in part], dtype=np.int32)
            pos = np.arange(sizes.sum(), dtype=np.int32) - np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, sizes)
            token = self.bytes_id[np.frombuffer(b"".join(words[i] for i in part), dtype=np.uint8)]
            self.db.register("start", pa.table({"word": np.repeat(np.arange(len(part), dtype=np.int32), sizes), "pos": pos, "token": token}))
            ids = self.db.sql(ENCODE).to_arrow_table()
            ends = (4 * np.searchsorted(ids.column("word").to_numpy(), np.arange(len(part) + 1))).tolist()
            flat = ids.column("token").to_numpy().astype("<i4").tobytes()
            for i, s, e in zip(part, ends, ends[1:]):
                out[i] = flat[s:e]
            self.db.unregister("start")
        for i, w in enumerate(words):
            if out[i] is None:
                out[i] = self._long_word(w)
        return out

    def _long_word(self, word: bytes) -> bytes:
        """The same contraction (least rank first, leftmost of equal ones) with a heap over a linked list."""
        tokens, following, before = [bytes([b]) for b in word], list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list = []

        def offer(i):
            j = following[i]
            if j < len(tokens) and (rank := self.ranks.get(tokens[i] + tokens[j])) is not None:
                heapq.heappush(heap, (rank, i, tokens[i], tokens[j]))
        for i in range(len(tokens)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            if tokens[i] is not left or (j := following[i]) >= len(tokens) or tokens[j] is not right:
                continue  # one of the two was contracted meanwhile
            tokens[i], tokens[j], following[i] = left + right, None, following[j]
            if following[i] < len(tokens):
                before[following[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([self.ranks[t] for t in tokens if t is not None], dtype="<i4").tobytes()

    def encode_spans(self, spans: list[str]) -> list[bytes]:
        """Ids (little-endian 32 bit) of spans that begin and end where a match of the pattern does."""
        # most are one word, or a word and a stop, and those are matches of the pattern
        split = [self.pattern.findall(s) if not self.plain(s) else (s[:-1], s[-1]) if s[-1] in ".," else (s,) for s in spans]
        self.words.ensure([[w for s in split for w in s]])
        known = self.words.young
        return [known[s[0]] if len(s) == 1 else known[s[0]] + known[s[1]] if len(s) == 2 else b"".join(map(known.__getitem__, s)) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. A match begins at each space behind a character that is no white space, so the spans between
        such spaces are encoded apart and kept. A span that stands more than once is looked up once."""
        plain, odd, order = [], [], np.empty(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            mine = odd if "  " in text or " \n" in text or "\n " in text or self.other_space.search(text) else plain
            order[i] = len(mine) if mine is plain else -1 - len(mine)
            mine.append(text)
        order = np.where(order < 0, len(plain) - 1 - order, order)
        lists = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        split = [self.cut.split(text) for text in odd]
        spans = pa.concat_arrays([lists.flatten(), pa.array([w for s in split for w in s], pa.large_string())]).dictionary_encode()
        starts = np.concatenate([[0], np.cumsum([*pc.list_value_length(lists).to_numpy(zero_copy_only=False), *map(len, split)])]).astype(np.int64)
        which, head = spans.indices.to_numpy(), np.zeros(len(spans), dtype=bool)
        head[starts[:-1]] = True
        slots, coded = np.zeros((2, len(spans.dictionary)), dtype=np.int64), []
        for slot, mask, cache in zip(slots, (head, ~head), (self.first, self.later)):
            wanted = np.flatnonzero(np.bincount(which[mask], minlength=len(slot)))
            slot[wanted] = np.arange(len(coded), len(coded) + len(wanted))
            coded += cache.values(spans.dictionary.take(pa.array(wanted)).to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(coded, pa.large_binary()).take(pa.array(np.where(head, slots[0, which], slots[1, which])))
        out = joined(ids, starts)
        return [out[i] for i in order]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids; unknown ids raise an error. Sequences are cut before tokens that begin with a
        space, and parts that were decoded before are kept. A part that stands more than once is looked up once."""
        flat = b"".join(ids)
        tokens = np.frombuffer(flat, dtype="<i4")
        if len(tokens) and not (0 <= tokens.min() and tokens.max() < len(self.starts_word)):
            raise ValueError("an id outside the vocabulary")
        starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64)
        begins = np.append(self.starts_word[tokens], True)
        begins[starts] = True
        cuts = np.flatnonzero(begins)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(4 * cuts), pa.py_buffer(flat)]).dictionary_encode()
        texts = self.parts.values(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        return joined(pa.array(texts, pa.large_binary()).take(parts.indices), np.searchsorted(cuts, starts))

    def decode_parts(self, parts: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids by ordered aggregation."""
        mark = np.array([self.mark], dtype="<i4").tobytes()
        out: list = []
        for at in range(0, len(parts), PARTS * 500):
            groups = [mark.join(parts[i:i + PARTS]) for i in range(at, min(at + PARTS * 500, len(parts)), PARTS)]
            n = np.array([len(g) // 4 for g in groups], dtype=np.int32)
            pos = np.arange(n.sum(), dtype=np.int32) - np.repeat(np.cumsum(n, dtype=np.int32) - n, n)
            self.db.register("ids", pa.table({"part": np.repeat(np.arange(len(n), dtype=np.int32), n), "pos": pos,
                                              "id": np.frombuffer(b"".join(groups), dtype="<i4")}))
            text = dict(self.db.sql(DECODE).fetchall())
            out += [bytes.fromhex(x) for g in range(len(groups)) for x in text.get(g, "").split(".")]
            self.db.unregister("ids")
        return out


def joined(values: pa.LargeBinaryArray, starts: np.ndarray) -> list[bytes]:
    """The values from each of ``starts`` to the next, one behind the other; they lie so in memory."""
    if not len(values):
        return [b""] * (len(starts) - 1)
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[values.offset + starts].tolist()
    view = memoryview(data or b"")
    return [view[s:e].tobytes() for s, e in zip(ends, ends[1:])]


def parts_of(rows: list) -> Iterator[list]:
    """Rows in parts of bounded total length (at least one row), so that the words of few texts are held at once."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row) > PART:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row)
    if part:
        yield part


@functools.lru_cache(maxsize=2)
def task_coder(file: str) -> RecursiveBpe:
    """The coder of a Python worker: its database and the words it knows serve all its tasks."""
    return RecursiveBpe(file)


def _encode_batches(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = task_coder(file)
        for batch in batches:
            ids = [x for texts in parts_of(batch.column("text").to_pylist()) for x in coder.encode(texts)]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])
    return run


def _decode_batches(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = task_coder(file)
        for batch in batches:
            ids = [np.array(x or (), dtype="<i4").tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for part in parts_of(ids) for x in coder.decode(part)], pa.binary())], ["doc_id", "text"])
    return run


def _round_trip_batches(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = task_coder(file)
        names = np.array([str(i) for i in range(len(coder.ranks))], dtype=object)
        for batch in batches:
            cols: tuple = ([], [], [])
            for texts in parts_of(batch.column("text").to_pylist()):
                ids = coder.encode(texts)
                for x, text in zip(ids, coder.decode(ids)):
                    cols[0].append(len(x) // 4)
                    cols[1].append(hashlib.sha256(",".join(names[np.frombuffer(x, dtype="<i4")]).encode()).hexdigest())
                    cols[2].append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(docs: DataFrame, file: str | None = None) -> DataFrame:
    """``doc_id, ids`` per row of ``docs`` (``doc_id, text``; other columns ignored), as the tiktoken library encodes.

    Null and empty texts give an empty list; ``doc_id`` may be null or repeated; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_encode_batches(file or tokenizer_file(RANKS)), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, file: str | None = None) -> DataFrame:
    """``doc_id, text`` (binary) per row of ``tokens`` (``doc_id, ids``); a null or empty list gives no bytes."""
    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode_batches(file or tokenizer_file(RANKS)), "doc_id long, text binary")


def digests(docs: DataFrame, file: str | None = None) -> DataFrame:
    """Counts and digests of encoding and decoding each row of ``docs``; both steps run where the text is."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_round_trip_batches(file or tokenizer_file(RANKS)),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
