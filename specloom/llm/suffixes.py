"""Repeated byte strings by two-stage suffix sorting (operator 10).

A string of ``length`` bytes is routed by the least hash of its k-grams, so equal strings meet wherever they stand. Neighbouring
strings with the same least hash form a run, which needs one row and one slice of text. Equal slices of a map task are
folded before the shuffle, and of equal slices overall only the first needs a look inside. Slices of a hash that differ
are fetched and suffix-sorted together in two stages: suffixes smaller than their successors are sorted directly, the
rest is induced from them bucket by bucket; then common prefixes of neighbours tell the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from specloom.llm.common import materialize, text_or_empty

LENGTH = 100  # bytes of a repeated string
GRAM = 32  # bytes of a k-gram: a power of two
PIECE = 1 << 20  # bytes of text hashed at once
CHUNK = 1 << 17  # bytes of slices sorted at once, unless one hash has more
CROWDED = 8192  # different slices of one hash from which they are dealt out string by string
SEEN = 1 << 17  # strings of crowded hashes that a task remembers, twice
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def least_hashes(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes: the least hash of its k-grams, and whether it is attained twice."""
    with np.errstate(over="ignore"):
        h, power, size = text.astype(np.uint64) + np.uint64(1), BASE, 1
        while size < gram:
            h = h[:-size] * power + h[size:]
            power, size = power * power, 2 * size
        h ^= h >> np.uint64(29)
        h *= MIX
        h ^= h >> np.uint64(32)
    # disjoint blocks of doubling size cover the grams of a string, so a tie means two places
    wanted, size, least, tie = length - gram + 1, 1, h, np.zeros(len(h), dtype=bool)
    out = None
    at = 0
    while True:
        if wanted & size:
            if out is None:
                out = (least, tie)
            else:
                out = _smaller(*out, least[at:], tie[at:])
            at += size
        if at == wanted:
            return out
        least, tie = _smaller(least, tie, least[size:], tie[size:])
        size *= 2


def _smaller(a, a_tie, b, b_tie):
    n = min(len(a), len(b))
    a, a_tie, b, b_tie = a[:n], a_tie[:n], b[:n], b_tie[:n]
    return np.minimum(a, b), np.where(a == b, True, np.where(a < b, a_tie, b_tie))


def _runs(texts: list[bytes], length: int, gram: int):
    """Runs of all texts: (text number, start, strings, least hash, slice hash, whether a string may repeat inside)."""
    sizes = np.array([len(t) for t in texts])
    data = b"".join(texts)
    least, tie = least_hashes(np.frombuffer(data, dtype=np.uint8), length, gram)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    whole = np.flatnonzero(np.arange(len(least)) + length <= ends[owner])
    least, tie, owner = least[whole], tie[whole], owner[whole]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])]))
    count = np.diff(np.append(first, len(least)))
    begin, doc = whole[first], owner[first]
    digest = xxhash.xxh64_intdigest
    slices = np.array([digest(data[s:e]) for s, e in zip(begin.tolist(), (begin + count + length - 1).tolist())], dtype=np.uint64)
    inside = (np.add.reduceat(tie, first) > 0) | (count > length - gram + 1)
    return doc, begin - (ends - sizes)[doc], count, least[first], slices, inside


RUNS = ["key", "doc", "start", "count", "slice", "inside", "sure"]


def _batch(names, arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names)


def _run_batches(length: int, gram: int):
    """Map side: one row per different slice; later equal slices of the batch are sure to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
            found, held, held_docs, size = [], [], [], 0
            for doc, text in zip([*docs.tolist(), None], [*texts, None]):
                if text is not None and len(text) >= length:
                    held.append(text)
                    held_docs.append(doc)
                    size += len(text)
                if held and (text is None or size >= PIECE):
                    number, *rest = _runs(held, length, gram)
                    found.append((np.array(held_docs)[number], *rest))
                    held, held_docs, size = [], [], 0
            if not found:
                continue
            doc, start, count, least, piece, inside = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((start, doc, piece, least))
            doc, start, count, least, piece, inside = (c[order] for c in (doc, start, count, least, piece, inside))
            sure = np.concatenate([[False], (least[1:] == least[:-1]) & (piece[1:] == piece[:-1])])
            # sure rows need no company: they are routed by their place, all others by their least hash
            key = np.where(sure, (doc.astype(np.uint64) * BASE) ^ start.astype(np.uint64), least)
            yield _batch(RUNS, [key.view(np.int64), doc, start.astype(np.int32), count.astype(np.int32), piece.view(np.int64), inside, sure])
    return run


def _concat(batches) -> dict:
    held = [b for b in batches if b.num_rows]
    if not held:
        return {}
    table = pa.Table.from_batches(held).combine_chunks()
    return {n: table.column(n).to_numpy() for n in table.column_names}


def _fold_batches(length: int, crowded: int):
    """Reduce side: ``doc, start, end, least, apart``: a repeated range (least null) or a slice that has to be looked into.

    ``apart``: its hash has so many different slices that they are not sorted together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _concat(batches)
        if not c:
            return
        order = np.lexsort((c["start"], c["doc"], c["slice"], c["key"]))
        sure = c["sure"][order]
        doc, start, end = c["doc"][order], c["start"][order], (c["start"] + c["count"] + (length - 1))[order]
        yield out(doc[sure], start[sure], end[sure], None, sure[sure])
        order = order[~sure]
        if not len(order):
            return
        doc, start, end = doc[~sure], start[~sure], end[~sure]
        least, piece, inside = c["key"][order], c["slice"][order], c["inside"][order]
        new_least = np.concatenate([[True], least[1:] != least[:-1]])
        new_slice = new_least | np.concatenate([[True], piece[1:] != piece[:-1]])
        yield out(doc[~new_slice], start[~new_slice], end[~new_slice], None, new_slice[~new_slice])
        group = np.cumsum(new_least) - 1
        different = np.bincount(group, weights=new_slice)
        several = (different > 1) | (np.bincount(group, weights=inside) > 0)
        look = new_slice & several[group]
        yield out(doc[look], start[look], end[look], least[look], (different > crowded)[group[look]])

    def out(doc, start, end, least, apart):
        least = pa.array(least) if least is not None else pa.nulls(len(doc), pa.int64())
        return _batch(["doc", "start", "end", "least", "apart"], [doc, start, end.astype(np.int32), least, apart])
    return run


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the suffixes in order of their first ``depth`` bytes at least (two-stage sorting).

    The last byte must be less than all others or equal only to other separators.
    """
    n = len(text)
    differs = np.flatnonzero(np.append(text[:-1] != text[1:], True))
    following = differs[np.searchsorted(differs, np.arange(n))]  # end of the run of equal bytes
    small = np.append(text[:-1] < text[1:], True)[following]
    data, direct = text.tobytes(), np.flatnonzero(small)
    keys = [data[i:i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)]
    rest = np.flatnonzero(~small)
    many_rest, many = np.bincount(text[rest], minlength=256), np.bincount(text, minlength=256)
    begins = np.cumsum(many) - many
    rank = np.full(n, -1, dtype=np.int64)
    first = text[direct]
    many_direct = many - many_rest
    rank[direct] = begins[first] + many_rest[first] + np.arange(len(direct)) - (np.cumsum(many_direct) - many_direct)[first]
    if len(rest):
        # of a bucket, those with fewer equal bytes ahead come first; each is placed by the rank of its successor
        ahead = following[rest] - rest
        rest = rest[np.lexsort((ahead, text[rest]))]
        label = text[rest].astype(np.int64) * (n + 1) + following[rest] - rest
        starts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        used = begins.copy()
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(rest)]):
            part = rest[s:e]
            part = part[np.argsort(rank[part + 1], kind="stable")]
            byte = text[part[0]]
            rank[part] = used[byte] + np.arange(e - s)
            used[byte] += e - s
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefix_at_least(data: bytes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` share ``length`` bytes, eight at a time."""
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    same, at = np.ones(len(a), dtype=bool), np.arange(len(a))
    for step in [*range(0, length - 7, 8), length - 8]:
        ok = words[a[at] + step] == words[b[at] + step]
        same[at[~ok]] = False
        at = at[ok]
    return same


def repeated_ranges(slices: list[bytes], doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges (doc, start, end) of the strings of ``length`` bytes in ``slices`` that an earlier place repeats.

    ``doc, start``: where each slice stands. The earliest of equal strings is left out.
    """
    sizes = np.array([len(s) for s in slices])
    # bytes move up by one so that zero can part the slices; UTF-8 never uses 255
    text = np.frombuffer(b"\xff".join(slices) + b"\xff", dtype=np.uint8) + np.uint8(1)
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(slices)), sizes + 1)
    offset = np.arange(len(text)) - begin[owner]
    order = suffix_order(text, length)
    order = order[(offset <= sizes[owner] - length)[order]]
    if len(order) < 2:
        return doc[:0], start[:0], start[:0]
    same = common_prefix_at_least(text.tobytes() + bytes(8), order[:-1], order[1:], length)
    group = np.cumsum(np.concatenate([[0], ~same]))
    place, where = doc[owner[order]], start[owner[order]] + offset[order]
    by = np.lexsort((where, place, group))
    later = np.concatenate([[False], group[by][1:] == group[by][:-1]])
    by = by[later]
    place, where = place[by], where[by]
    by = np.lexsort((where, place))
    place, where = place[by], where[by]
    if not len(place):
        return place, where, where
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (where[1:] > where[:-1] + length)]))
    return place[head], where[head], where[np.append(head[1:], len(where)) - 1] + length


def _sort_batches(length: int):
    """Slices sorted by least hash in; repeated ranges out, chunk by chunk of whole hashes. Ranges (no ``piece``) pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, docs, starts, size, last = [], [], [], 0, None
        for batch in batches:
            ranges = batch.filter(pc.is_null(batch.column("piece")))
            if ranges.num_rows:
                yield ranges.select(["doc", "start", "end"])
            batch = batch.filter(pc.is_valid(batch.column("piece")))
            for least, doc, start, piece in zip(*(batch.column(n).to_pylist() for n in ("least", "doc", "start", "piece"))):
                if size >= CHUNK and least != last:
                    yield out(slices, docs, starts)
                    slices, docs, starts, size = [], [], [], 0
                slices.append(piece)
                docs.append(doc)
                starts.append(start)
                size, last = size + len(piece), least
        if slices:
            yield out(slices, docs, starts)

    def out(slices, docs, starts):
        doc, start, end = repeated_ranges(slices, np.array(docs, dtype=np.int64), np.array(starts, dtype=np.int64), length)
        return _batch(["doc", "start", "end"], [doc, start.astype(np.int32), end.astype(np.int32)])
    return run


class Seen:
    """Least place met so far of each string; of bounded size, two generations."""

    def __init__(self, half_size: int = SEEN):
        self.half_size, self.young, self.old = half_size, {}, {}

    def repeats(self, string: bytes, place: tuple[int, int]) -> bool:
        """Whether a smaller place of the string is known; otherwise this one is remembered."""
        least = self.young.get(string)
        if least is None:
            least = self.old.get(string)
            if len(self.young) >= self.half_size:
                self.old, self.young = self.young, {}
            self.young[string] = place if least is None else min(place, least)
        elif place < least:
            self.young[string] = place
        return least is not None and least < place


def _cut_batches(length: int):
    """Texts with the slices asked for in; one row per slice out, or a repeated range (``end``, no ``piece``).

    Slices of a crowded hash are cut into their strings, each dealt out by a hash of its own: equal ones still meet, and a
    line that very many different texts surround doesn't gather in one task. Of equal strings only those that no smaller place
    of the task is known for travel, one of each as a rule; the others are repeated ranges at once and go by their place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Seen()
        for batch in batches:
            rows, size = ([], [], [], [], []), 0

            def add(*row):
                for col, v in zip(rows, row):
                    col.append(v)
            for doc, text, asked in zip(*(batch.column(n).to_pylist() for n in ("doc", "text", "asked"))):
                for a in asked:
                    s, e = a["start"], a["end"]
                    if not a["apart"]:
                        add(a["least"], doc, s, text[s:e], None)
                        size += e - s
                        continue
                    sure = None  # where the repeated strings at hand begin
                    for b in range(s, e - length + 2):
                        piece = text[b:b + length] if b <= e - length else None
                        if piece is not None and known.repeats(piece, (doc, b)):
                            sure = b if sure is None else sure
                            continue
                        if sure is not None:
                            add(_hashed(b"%d %d" % (doc, sure)), doc, sure, None, b - 1 + length)
                            sure = None
                        if piece is not None:
                            add(_hashed(piece), doc, b, piece, None)
                            size += length
                if size > PIECE:
                    yield out(rows)
                    rows, size = ([], [], [], [], []), 0
            yield out(rows)

    def out(rows):
        return _batch(["least", "doc", "start", "piece", "end"], [
            pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()))])
    return run


def _hashed(data: bytes) -> int:
    return int.from_bytes(xxhash.xxh64_digest(data), "big", signed=True)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges as maximal ones; ranges that touch are one."""
    out: list = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for s, e in removed:
        parts.append(text[at:s])
        at = e
    return b"".join([*parts, text[at:]])


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = ([], [], [], [], [])
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            removed = merged([(r["start"], r["end"]) for r in ranges or ()])
            for col, v in zip(cols, (len(text), sum(e - s for s, e in removed), len(removed), hashlib.sha256(_kept(text, removed)).hexdigest(),
                                     [{"start": s, "end": e} for s, e in removed])):
                col.append(v)
        spans = pa.array(cols[4], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        yield _batch(["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                     [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), spans])


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc, doc_id, text`` (bytes) with a ``doc`` that orders the documents, of all rows and of the different ones.

    ``doc`` is ``doc_id`` itself if that is a key."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    facts = rows.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").take(1)
    if not facts:
        rows = rows.where("doc_id is not null").select(F.col("doc_id").alias("doc"), "doc_id", "text")
        return rows, rows
    ordered = rows.select("doc_id", F.sha2("text", 256).alias("digest")).distinct().orderBy(F.asc_nulls_first("doc_id"), "digest")
    ordered = materialize(ordered.withColumn("doc", F.monotonically_increasing_id()))
    rows = rows.withColumn("digest", F.sha2("text", 256)).alias("r").join(
        ordered.alias("o"), F.col("r.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("r.digest") == F.col("o.digest")))
    rows = rows.select("o.doc", "r.doc_id", "r.text")
    return rows, rows.dropDuplicates(["doc"])


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` per row of ``docs`` (``doc_id, text``; others ignored).

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier (smaller ``doc_id``, or the same document
    before). Null texts count as empty; texts shorter than ``length`` lose nothing. A null ``doc_id`` is smaller than any other; rows of one
    ``doc_id`` are documents in the order of their texts' digests, and rows equal in both have one result. No rows if empty.
    """
    rows, different = _numbered(docs)
    runs = different.select("doc", "text").mapInArrow(
        _run_batches(length, gram), "key long, doc long, start int, count int, slice long, inside boolean, sure boolean")
    folded = runs.repartition("key").mapInArrow(_fold_batches(length, crowded), "doc long, start int, end int, least long, apart boolean")
    asked = folded.where("least is not null").groupBy("doc").agg(F.collect_list(F.struct("least", "start", "end", "apart")).alias("asked"))
    texts = rows.select("doc", "doc_id", "text")
    # the same columns and filter as in the last join, so that Spark shuffles the texts once for both
    slices = different.select("doc", "doc_id", "text").join(asked, "doc").select("doc", "doc_id", "text", "asked").mapInArrow(_cut_batches(length), "least long, doc long, start int, piece binary, end int")
    looked = (slices.repartition("least").sortWithinPartitions("least", "doc", "start")
              .mapInArrow(_sort_batches(length), "doc long, start int, end int"))
    ranges = (folded.where("least is null").select("doc", "start", "end").unionByName(looked)
              .groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges")))
    return texts.join(ranges, "doc", "left").select("doc_id", "text", "ranges").mapInArrow(
        _result_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>")
