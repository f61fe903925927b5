"""Harmonic packing of tokenised documents into sequences (operator 9).

Class k holds pieces of at most ``capacity // k`` tokens and more than class k + 1 takes; k of them fill a sequence. A
document is cut so that its pieces nearly fill their slots: whole sequences first, then the largest slot that the rest
fills completely, until the rest is short (``cut_above``); this takes few cuts, as rests shrink quadratically.
Each worker numbers its pieces per class; with the workers' counts per class a piece's rank gives its sequence and slot, so
all sequences of a class but the last hold the fixed number of pieces and no worker waits for another. The pieces of
the last sequences (fewer than the sum of all k, whatever the input) are packed once more, largest first.
"""

from __future__ import annotations

import array
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from specloom.llm.common import WordCache, materialize, text_or_empty, tokenizer_file

CAPACITY = 2048
CUT_ABOVE = 128  # rests longer than this are cut again
END_ID = 1
# white space of str.split that the tokenizer may treat otherwise; texts with it are cut at plain white space only
ODD_SPACES = r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def pieces(length: int, capacity: int = CAPACITY, cut_above: int = CUT_ABOVE) -> list[int]:
    """Lengths of the pieces of a document with ``length`` tokens, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest > cut_above:
        slot = capacity // (capacity // rest)  # the slot the rest would be put in
        if rest < slot:
            slot = capacity // (capacity // rest + 1)  # the next smaller one is filled completely
        out.append(slot)
        rest -= slot
    return out + [rest] * (rest > 0)


# words of Latin letters (but dotted capital I, which lowers to two characters)
PLAIN = r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"


@functools.lru_cache(maxsize=2)
def chunk_encoder(file: str, half_size: int = 500_000):
    """Texts to ids (bytes of little-endian 32-bit numbers), equal to encoding whole texts by ``tokenizers``.

    The vocabulary's pre-tokens never contain white space, so runs between white space are encoded alone and kept. A plain
    word and the stop behind it are pre-tokens of their own, for which the model of the tokenizer is called directly, with
    the lower-case word in the byte alphabet. The encoder and what it keeps serve all tasks of a Python worker.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer, odd, plain = Tokenizer.from_file(file), re.compile(ODD_SPACES), re.compile(PLAIN).fullmatch

    def ids(texts):
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(x):
        return array.array("I", x).tobytes()
    tokenize = tokenizer.model.tokenize
    # the byte alphabet: printable Latin-1 characters stand for themselves, the others for code points from 256 on
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    alphabet = dict(zip((b for b in range(256) if b not in printable), range(256, 512)))

    def fill_words(words):
        return [packed([t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(alphabet))]) for w in words]
    stops = {c: packed(ids([c])[0]) for c in ".,"}

    def fill(chunks):
        words, ends, hard, direct = [], [], [], []  # side by side: many small tuples would keep the garbage collector busy
        for c in chunks:
            word = c[:-1] if (end := stops.get(c[-1:], b"")) else c
            if word.isalpha() and (word.isascii() or plain(word)):
                word = word.lower()
                if word == c:
                    direct.append(c)
            else:
                hard.append(c)
                word = None
            words.append(word)
            ends.append(end)
        known = dict(zip(direct, fill_words(direct)))
        others = set(words).difference(known, (None,))
        known.update(cache.held(others))
        others = list(others.difference(known))
        new = dict(zip(others, fill_words(others)))
        cache.young.update(new)  # a lower-case word alone is a chunk, too
        known.update(new)
        rest = map(packed, ids(hard))
        return [next(rest) if w is None else known[w] + end for w, end in zip(words, ends)]
    cache = WordCache(fill, half_size)

    def chunks(text):
        return text.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if odd.search(text) else text.split()

    def encode(texts):
        return list(map(b"".join, cache.lists(map(chunks, texts))))
    return encode


def _piece_batches(file: str, capacity: int, cut_above: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker = chunk_encoder(file), TaskContext.get().partitionId()
        used: dict = {}  # pieces of this worker per class
        for batch in batches:
            rows, cols = [], {n: [] for n in ("start", "length", "ids_crc32", "doc_tokens", "class", "rank")}
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                for i, ids in enumerate(encode(texts[at:at + 256]), at):
                    ids += end
                    start, total = 0, len(ids) // 4
                    for n in pieces(total, capacity, cut_above):
                        k = capacity // n
                        rank = used[k] = used.get(k, -1) + 1
                        for name, v in zip(cols, (start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total, k, rank)):
                            cols[name].append(v)
                        rows.append(i)
                        start += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(v, pa.int64()) for v in cols.values()),
                 pa.array([worker] * len(rows), pa.int64())], ["doc_id", *cols, "worker"])
    return run


def _pack_rest(capacity: int):
    """The pieces of unfinished sequences, largest first into the first sequence with room."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "class", "rank"], ascending=[False, True, True], kind="stable")
        room: list = []
        place = []
        for n in rows["length"]:
            at = next((i for i, r in enumerate(room) if r >= n), len(room))
            if at == len(room):
                room.append(capacity)
            room[at] -= n
            place.append(at)
        return rows.assign(sequence_id=place)[["class", "rank", "sequence_id"]]
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, cut_above: int = CUT_ABOVE, file: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id, text``; other columns ignored), see the contract of the query.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Null text is empty: one piece that holds the
    end id only. Rows with equal or null ``doc_id`` are packed each on its own. An empty table gives no rows.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        _piece_batches(file or tokenizer_file("word_bpe_49k.json"), capacity, cut_above, end_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class long, rank long, worker long")
    cut = materialize(cut)
    counts = cut.groupBy("class", "worker").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    before = materialize(counts.select(
        "class", "worker", (F.sum("n").over(by_class.orderBy("worker")) - F.col("n")).alias("before"), F.sum("n").over(by_class).alias("all")))
    ranked = (cut.join(before, ["class", "worker"]).withColumn("rank", F.col("rank") + F.col("before"))
              .withColumn("whole", F.col("rank") < F.col("all") - F.col("all") % F.col("class")))
    # sequences of a class are numbered from a multiple of all classes' counts apart: id = class + (capacity + 1) * number
    whole = ranked.where("whole").withColumn("sequence_id", F.col("class") + (capacity + 1) * F.expr("rank div class"))
    rest = ranked.where("not whole")
    # at most k - 1 pieces of each class k, at most 2 * sqrt(capacity) + cut_above classes: one bounded group
    placed = (rest.select("class", "rank", "length").groupBy(F.lit(0).alias("one"))
              .applyInPandas(lambda rows: _pack_rest(capacity)(rows), "class long, rank long, sequence_id long"))
    rest = rest.join(placed, ["class", "rank"]).withColumn("sequence_id", (capacity + 1) * F.col("sequence_id"))
    in_sequence = Window.partitionBy("sequence_id").orderBy("class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return (whole.unionByName(rest).withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0)))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
