"""Phrase collocations by multikey quicksort of suffix pointers (operator 11).

Three passes over the texts. The first counts words, the second pairs of frequent words by their hashes: these counts decide where
the suffixes that begin with a pair go, and suffixes of an infrequent pair go nowhere. The third cuts suffixes of up to four words, folds equal ones
per task and routes them by language and leading words into buckets of bounded size. A bucket's suffix pointers are sorted by three-way
partitioning word by word; the size of an equal partition is the count of its words, partitions below the threshold are given up.
A pair with too many occurrences for one bucket is routed by more leading words: its phrases of two, three and four words are suffixes of their
own, equal ones folded per task.

What tasks must know of all counts is held in bit tables of fixed size over hashes, so its size does not grow with the
corpus; a hash that two keys share costs a count that is thrown away later, never a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.llm.common import materialize, text_or_empty

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a candidate
TOP = 2000
#: a longer candidate with so many hundredths of the occurrences replaces the shorter one
COVERED = 80
CHUNK = 4 << 20  # bytes of text that a task cuts at once
BUCKET = 200_000  # occurrences that one bucket is meant to hold
HEAVY = BUCKET // 4  # occurrences of a pair that is routed by more words
WORD_BITS, PAIR_BITS, HEAVY_BITS = 27, 27, 24  # sizes of the bit tables, as powers of two: 16, 16 and 2 MB
BLOCK_BITS = 15  # bits in one row of a bitmap aggregate
PART_BITS, KEY_BITS = 12, 22  # of a pair's hash: the part of the pairs it is counted with, its key there
COMPACT = 1 << 21  # counts that are held before equal keys are added up

_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_TOKENS = re.compile(rb"[^ \n]+|\n")
END = b"\n"  # stands after every piece; no word


# words of a chunk -----------------------------------------------------------------------------------------------------

def chunks(texts: Iterator[tuple[str, bytes]], size: int) -> Iterator[tuple[str, bytes]]:
    """Texts of a language in lower case, pieces parted by line feeds, in chunks of about ``size`` bytes that end where a piece ends.

    What waits for a chunk to fill is bounded over all languages.
    """
    held: dict[str, list[bytes]] = {}
    length: dict[str, int] = {}
    for lang, text in texts:
        text, at = text.translate(_TABLE), 0
        while at < len(text):
            end = at + size - length.get(lang, 0)
            cut = len(text) if end >= len(text) else text.find(END, end) + 1 or len(text)
            held.setdefault(lang, []).append(text[at:cut])
            length[lang] = length.get(lang, 0) + cut - at
            at = cut
            full = lang if length[lang] >= size else max(length, key=length.get) if sum(length.values()) > 4 * size else None
            if full is not None:
                del length[full]
                yield full, END.join(held.pop(full)) + END
    for lang in sorted(held):
        yield lang, END.join(held[lang]) + END


class Words:
    """The words of a chunk as codes; ``end`` is the code of a piece's end."""

    def __init__(self, chunk: bytes, lang: str):
        tokens = pa.array(_TOKENS.findall(chunk), pa.binary()).dictionary_encode()
        self.words, self.codes = tokens.dictionary, tokens.indices.to_numpy()
        self.end = self.words.index(END).as_py()
        self.counts = np.bincount(self.codes, minlength=len(self.words))
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8"), 42)
        self.marks = self.hashes(self.words)

    def hashes(self, phrases: pa.Array) -> np.ndarray:
        """As ``xxhash64(lang, phrase)`` of Spark."""
        seed, digest = self.seed, xxhash.xxh64_intdigest
        return np.fromiter((digest(p, seed) for p in phrases.to_pylist()), dtype=np.uint64, count=len(phrases))

    def frequent(self, table: np.ndarray) -> np.ndarray:
        """Whether a code is a word of which the bit table does not know that it is infrequent."""
        out = has(table, self.marks & np.uint64(8 * len(table) - 1))
        out[self.end] = False
        return out

    def joined(self, columns: list[np.ndarray]) -> pa.Array:
        """Phrases of the words in ``columns`` (codes; -1: no word)."""
        parts = [pc.take(self.words, pa.array(c, pa.int32(), mask=c < 0)) for c in columns]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()), null_handling="skip")

    def pairs(self, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of neighbouring frequent words: their places, for each the number of its pair, and the two words of every pair."""
        ok = good[self.codes]
        places = np.flatnonzero(ok[:-1] & ok[1:])
        keys = self.codes[places].astype(np.int64) * len(self.words) + self.codes[places + 1]
        distinct, number = np.unique(keys, return_inverse=True)
        return places, number, (distinct // len(self.words)).astype(np.int32), (distinct % len(self.words)).astype(np.int32)


    def pair_hashes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Hashes of pairs (and their language) from those of the words."""
        x = self.marks[first] * np.uint64(0x9E3779B97F4A7C15) ^ (self.marks[second] + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def has(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Bits of ``table`` (uint8, little-endian bits)."""
    at = places.astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _by_chunk(size: int, work, names: list[str]):
    """``work(lang, Words)`` gives columns; chunks hold texts of one language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for batch in batches:
                for at in range(0, len(batch), 500):
                    part = batch.slice(at, 500)
                    yield from zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist())
        for lang, chunk in chunks(texts(), size):
            columns = work(lang, Words(chunk, lang))
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *columns], ["lang", *names])
    return run


def _text(phrases: pa.Array) -> pa.Array:
    return phrases.cast(pa.string())


def _count_words(size: int):
    def work(lang: str, words: Words):
        some = np.flatnonzero(np.arange(len(words.words)) != words.end)
        return [_text(words.words.take(pa.array(some))), pa.array(words.counts[some], pa.int64())]
    return _by_chunk(size, work, ["phrase", "n"])


def _count_pairs(size: int, frequent):
    def work(lang: str, words: Words):
        _, number, first, second = words.pairs(words.frequent(frequent.value))
        hashes, n = words.pair_hashes(first, second), np.bincount(number, minlength=len(first)).astype(np.uint32)
        order = np.argsort(hashes)
        parts, n = top(hashes[order], PART_BITS), n[order]
        keys = (top(hashes[order], PART_BITS + KEY_BITS) & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
        begins = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, dtype=np.int64)
        spans = list(zip(begins.tolist(), [*begins[1:].tolist(), len(parts)]))
        return [pa.array(parts[begins].astype(np.int64), pa.int64()), pa.array([keys[s:e].tobytes() for s, e in spans], pa.binary()),
                pa.array([n[s:e].tobytes() for s, e in spans], pa.binary())]
    return _by_chunk(size, work, ["part", "keys", "counts"])


def _sum_pairs(least: int):
    """Rows in order of their part in; hashes of pairs with at least ``least`` occurrences out. Equal keys are added up as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, counts, held = None, [], [], 0

        def added():
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            return distinct, np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)

        def ended():
            k, n = added()
            k, n = k[n >= least].astype(np.int64), n[n >= least]
            return pa.RecordBatch.from_arrays([pa.array((part << KEY_BITS) + k, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])
        for batch in batches:
            for p, k, n in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts"))):
                if keys and p != part:
                    yield ended()
                    keys, counts, held = [], [], 0
                part = p
                keys.append(np.frombuffer(k, dtype=np.uint32))
                counts.append(np.frombuffer(n, dtype=np.uint32))
                held += len(keys[-1])
                if held > COMPACT:
                    k, n = added()
                    keys, counts, held = [k], [n], min(len(k), COMPACT // 2)
        if keys:
            yield ended()
    return run


def _suffixes(size: int, buckets: int, longest: int, frequent, leading, heavy):
    """Suffixes from frequent pairs on, cut before the first infrequent pair, equal ones folded; with the bucket they go to."""
    def work(lang: str, words: Words):
        places, number, first, second = words.pairs(words.frequent(frequent.value))
        hashes = words.pair_hashes(first, second)
        known, crowded = (has(t.value, top(hashes, (8 * len(t.value)).bit_length() - 1)) for t in (leading, heavy))
        places, number = places[known[number]], number[known[number]]
        starts = np.zeros(len(words.codes) + longest, dtype=bool)
        starts[places] = True
        columns, alive = [words.codes[places], words.codes[places + 1]], np.ones(len(places), dtype=bool)
        for k in range(2, longest):
            alive = alive & starts[places + k - 1]
            columns.append(np.where(alive, words.codes[np.minimum(places + k, len(words.codes) - 1)], -1))
        table = np.stack(columns, axis=1) if len(places) else np.zeros((0, longest), dtype=np.int32)
        many = crowded[number]
        parts = [(table[~many], number[~many], False)]
        for k in range(2, longest + 1):  # phrases of a crowded pair, each with a number of its own
            part = table[many & (table[:, k - 1] >= 0)].copy()
            part[:, k:] = -1
            parts.append((part, None, True))
        out = []
        for part, own, deep in parts:
            if not len(part):
                continue
            rows, at, n = np.unique(part, axis=0, return_index=True, return_counts=True)
            phrase = words.joined(list(rows.T.astype(np.int32)))
            route = words.hashes(phrase) if deep else hashes[own[at]]
            out.append((phrase, n, (route >> np.uint64(20)) % np.uint64(buckets), np.full(len(rows), deep)))
        if not out:
            return [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.bool_())]
        return [_text(pa.concat_arrays([o[0] for o in out])), pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
                pa.array(np.concatenate([o[2] for o in out]).astype(np.int64), pa.int64()), pa.array(np.concatenate([o[3] for o in out]))]
    return _by_chunk(size, work, ["phrase", "n", "bucket", "deep"])


# sorting --------------------------------------------------------------------------------------------------------------

def multikey(symbols: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Three-way quicksort of the pointers to the rows of ``symbols`` (a column per depth, -1: ended), each standing for ``weights`` suffixes.

    Yields (pointer, depth, size) of every equal partition of at least ``least`` suffixes: the first ``depth`` symbols of
    ``pointer`` occur ``size`` times. Smaller partitions are given up, equal ones are partitioned by the next symbol.
    """
    stack = [(np.arange(len(weights)), 0)]
    while stack:
        pointers, depth = stack.pop()
        if weights[pointers].sum() < least:
            continue
        keys = symbols[depth][pointers]
        pivot = keys[len(keys) // 2]
        equal, below = keys == pivot, keys < pivot
        same = pointers[equal]
        if len(same) < len(pointers):
            stack.append((pointers[below], depth))
            stack.append((pointers[~(equal | below)], depth))
        if pivot >= 0:
            size = int(weights[same].sum())
            if size >= least:
                yield int(same[0]), depth + 1, size
                if depth + 1 < len(symbols):
                    stack.append((same, depth + 1))


def _sort_bucket(rows: pa.Table, least: int, longest: int) -> pa.RecordBatch:
    langs, phrases = rows["lang"].to_pylist(), rows["phrase"].to_pylist()
    weights = np.asarray(rows["n"])
    found = []
    deep = np.asarray(rows["deep"])
    for kind in (False, True):
        mine = np.flatnonzero(deep == kind)
        # the language is part of the first word; phrases of a crowded pair are one symbol
        split = [((langs[i], phrases[i]),) if kind else ((langs[i], w[0]), *w[1:]) for i in mine.tolist() for w in (phrases[i].split(" "),)]
        symbols = []
        for depth in range(1 if kind else longest):
            column = [w[depth] if depth < len(w) else None for w in split]
            order = {w: k for k, w in enumerate(sorted({w for w in column if w is not None}))}
            order[None] = -1
            symbols.append(np.fromiter((order[w] for w in column), dtype=np.int64, count=len(column)))
        for at, depth, size in multikey(symbols, weights[mine], least):
            i = int(mine[at])
            if kind:
                found.append((langs[i], phrases[i], size))
            elif depth > 1:
                found.append((langs[i], " ".join(phrases[i].split(" ")[:depth]), size))
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()),
                                       pa.array([f[2] for f in found], pa.int64())], ["lang", "phrase", "n"])


def _sort_batches(least: int, longest: int):
    """Rows in order of their bucket in; counts of frequent phrases out, one bucket in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            numbers = np.asarray(batch.column("bucket"))
            begins = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]]) if len(numbers) else [0]
            for s, e in zip(begins, begins[1:]):
                if held and numbers[s] != last:
                    yield _sort_bucket(pa.Table.from_batches(held), least, longest)
                    held = []
                held.append(batch.slice(s, e - s))
                last = numbers[s]
        if held:
            yield _sort_bucket(pa.Table.from_batches(held), least, longest)
    return run


# Spark ----------------------------------------------------------------------------------------------------------------

def bit_table(rows: DataFrame, place: Column, bits: int) -> np.ndarray:
    """A table of ``2 ** bits`` bits, those at the ``place`` of a row set.

    Bitmaps are made and merged by Spark; what reaches the driver has a fixed size.
    """
    rows = rows.select(F.shiftright(place, BLOCK_BITS).alias("block"), place.bitwiseAND((1 << BLOCK_BITS) - 1).alias("bit"))
    rows = rows.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    for r in rows.collect():
        out[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk: int = CHUNK, bucket: int = BUCKET, heavy: int = HEAVY,
                  bits: tuple[int, int, int] = (WORD_BITS, PAIR_BITS, HEAVY_BITS)) -> tuple[DataFrame, DataFrame]:
    """Two tables ``lang, phrase, n``: all words, and the phrases of 2 to ``longest`` words with at least ``least`` occurrences."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    total = F.sum("n").cast("long").alias("n")
    words = materialize(rows.mapInArrow(_count_words(chunk), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(total))
    low = F.pmod(F.xxhash64("lang", "phrase"), F.lit(1 << bits[0]))
    frequent = spark.sparkContext.broadcast(bit_table(words.where(F.col("n") >= least), low, bits[0]))
    pairs = rows.mapInArrow(_count_pairs(chunk, frequent), "lang string, part long, keys binary, counts binary").drop("lang")
    pairs = materialize(pairs.repartition("part").sortWithinPartitions("part").mapInArrow(_sum_pairs(least), "key long, n long"))
    high = [F.shiftright("key", PART_BITS + KEY_BITS - b) for b in bits[1:]]
    leading = spark.sparkContext.broadcast(bit_table(pairs, high[0], bits[1]))
    crowded = spark.sparkContext.broadcast(bit_table(pairs.where(F.col("n") > heavy), high[1], bits[2]))
    buckets = max(1, -(-(pairs.agg(F.sum("n").alias("n")).first()["n"] or 0) // bucket))
    suffixes = rows.mapInArrow(_suffixes(chunk, buckets, longest, frequent, leading, crowded), "lang string, phrase string, n long, bucket long, deep boolean")
    counts = suffixes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sort_batches(least, longest), "lang string, phrase string, n long")
    return words, materialize(counts)


def scored(words: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every candidate: the cut with the lowest score, ties to the shortest first part."""
    split = F.split("phrase", " ")
    cuts = counts.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size(split) - 1)).alias("k"))
    left, right = F.array_join(F.slice(split, F.lit(1), F.col("k")), " "), F.array_join(F.slice(split, F.col("k") + 1, F.size(split) - F.col("k")), " ")
    sides = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("first"), left.alias("part")), F.struct(F.lit(False).alias("first"), right.alias("part")))).alias("side"))
    sides = sides.select("lang", "phrase", "a", "k", "side.first", "side.part")
    # every part of a candidate is as frequent as the candidate
    known = words.unionByName(counts).select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    sides = sides.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    # decimals: the product may pass 64 bits
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    best = sides.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")


def uncovered(found: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates without those whose words lie inside a longer one with enough of their occurrences."""
    split = F.split("phrase", " ")
    size = F.size(split)
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(
        F.sequence(F.lit(1), size - k + 1), lambda at: F.array_join(F.slice(split, at, k), " "))))
    longer = found.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(spans)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    gone = F.expr(f"CAST(longer AS DECIMAL(19,0)) * 100 >= CAST(a AS DECIMAL(19,0)) * {int(covered)}")
    return found.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~gone).drop("longer")


def collocations(docs: DataFrame, top: int = TOP, **settings) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: per language the ``top`` phrases of ``docs`` (``text, lang``; other columns are ignored).

    A null text is empty, a null language is ``und`` (and counts with rows that say so). Repeated rows count as often as
    they stand there. A language without candidates and an empty table give no rows; texts without words add nothing. Texts are
    cut at the ends of their pieces, so memory is bounded by the longest piece. Ties go to more occurrences, then to the
    lesser phrase by its bytes.
    """
    words, counts = phrase_counts(docs, **settings)
    kept = uncovered(scored(words, counts))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
