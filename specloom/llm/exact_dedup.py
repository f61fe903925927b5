"""Exact duplicates with a cuckoo-filter index (operator 2).

An index partition holds short fingerprints of the live digests in a cuckoo filter whose slots point at the stored
keys. A lookup that hits the filter is verified against the stored key in that slot, so false hits change nothing. A
full filter is rebuilt at twice the size from its stored keys. Digests can be deleted again.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from specloom.llm.common import materialize, text_or_empty

SLOTS = 4  # fingerprints per bucket
MAX_KICKS = 200  # moves before the filter counts as full
FOLD_ROWS = 100_000  # digests a map task folds before it passes them on


class CuckooIndex:
    """Cuckoo filter over hex digests with 16-bit fingerprints; each slot names the row of its stored key."""

    def __init__(self, buckets: int = 1024):
        self.keys: list = []  # stored content: digest by row, None when deleted
        self.values: list = []
        self.free: list = []
        self.grown = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = [0] * (buckets * SLOTS)  # 0: empty
        self.rows = [0] * (buckets * SLOTS)

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _places(self, digest: str) -> tuple[int, int, int]:
        mixed = xxhash.xxh3_64_intdigest(digest)
        mark, first = (mixed & 0xFFFF) or 1, (mixed >> 16) & self.mask
        return mark, first, first ^ self._shift(mark)

    def _shift(self, mark: int) -> int:
        return (mark * 0x5BD1E995 & 0xFFFFFFFF) >> 3 & self.mask

    def find(self, digest: str) -> int:
        """Row of the stored key, -1 if not live. Filter hits are verified against the stored keys."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.keys[self.rows[slot]] == digest:
                    return self.rows[slot]
        return -1

    def insert(self, digest: str, value) -> int:
        """Store a digest that is not live."""
        row = self.free.pop() if self.free else len(self.keys)
        if row == len(self.keys):
            self.keys.append(digest)
            self.values.append(value)
        else:
            self.keys[row], self.values[row] = digest, value
        if not self._place(row):
            self._grow()
        return row

    def _put(self, bucket: int, mark: int, row: int) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.marks[slot]:
                self.marks[slot], self.rows[slot] = mark, row
                return True
        return False

    def _place(self, row: int) -> bool:
        mark, first, second = self._places(self.keys[row])
        if self._put(first, mark, row) or self._put(second, mark, row):
            return True
        moves, bucket = random.Random(row), second
        for _ in range(MAX_KICKS):
            slot = bucket * SLOTS + moves.randrange(SLOTS)
            mark, self.marks[slot] = self.marks[slot], mark
            row, self.rows[slot] = self.rows[slot], row
            bucket ^= self._shift(mark)
            if self._put(bucket, mark, row):
                return True
        return False  # the row in hand has no slot: the caller rebuilds from the stored keys

    def _grow(self) -> None:
        """Overflow: twice the buckets, filled from the stored keys (again, should they not fit)."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.grown += 1
            self._clear(buckets)
            if all(self._place(row) for row, key in enumerate(self.keys) if key is not None):
                return

    def delete(self, digest: str) -> bool:
        """Remove a live digest; False if it is not live."""
        row = self.find(digest)
        if row < 0:
            return False
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.rows[slot] == row:
                    self.marks[slot] = 0
                    self.keys[row], self.values[row] = None, None
                    self.free.append(row)
                    return True
        raise AssertionError("a found key has a slot")

    def live(self) -> Iterator[tuple]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def _larger(a, b):
    return b if a is None else a if b is None else max(a, b)


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Map side: one row per digest and task (or per FOLD_ROWS digests), so copies meet before the shuffle."""
    held: dict = {}

    def out():
        return pd.DataFrame({"digest": list(held), "keep_id": pd.array([v[0] for v in held.values()], "Int64"),
                             "group_size": [v[1] for v in held.values()]})
    for batch in batches:
        for digest, doc, n in zip(batch["digest"], batch["keep_id"], batch["group_size"]):
            doc = None if pd.isna(doc) else int(doc)
            old = held.get(digest)
            held[digest] = (doc, n) if old is None else (_larger(old[0], doc), old[1] + n)
        if len(held) >= FOLD_ROWS:
            yield out()
            held.clear()
    if held:
        yield out()


def _index_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One index partition: additions and deletions of digests against a cuckoo index; yields the live keys."""
    index = CuckooIndex()
    for batch in batches:
        for digest, doc, n in zip(batch["digest"], batch["keep_id"], batch["group_size"]):
            if n < 0:
                index.delete(digest)
                continue
            doc, row = None if pd.isna(doc) else int(doc), index.find(digest)
            if row < 0:
                index.insert(digest, (doc, int(n)))
            else:
                keep, size = index.values[row]
                index.values[row] = (_larger(keep, doc), size + int(n))
    live = list(index.live())
    for at in range(0, len(live), FOLD_ROWS):
        part = live[at:at + FOLD_ROWS]
        yield pd.DataFrame({"digest": [k for k, _ in part], "keep_id": pd.array([v[0] for _, v in part], "Int64"),
                            "group_size": [v[1] for _, v in part]})


KEYS = "digest string, keep_id long, group_size long"


def live_digests(rows: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """``digest, keep_id, group_size`` of the live digests of ``rows`` (``digest, keep_id``: one row per document).

    ``deleted`` (``digest``) lists digests that are removed from the index again after all insertions. A deleted digest
    that is not live changes nothing. Of a digest's rows the largest id is kept; a null id only if there is no other.
    """
    added = rows.select(F.col("digest"), F.col("keep_id").cast("long"), F.lit(1).cast("long").alias("group_size")).mapInPandas(_fold, KEYS)
    if deleted is None:
        return added.repartition("digest").mapInPandas(_index_partition, KEYS)
    gone = deleted.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(-1).cast("long").alias("group_size"))
    return added.unionByName(gone).repartition("digest").sortWithinPartitions(F.desc("group_size")).mapInPandas(_index_partition, KEYS)


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs`` (``doc_id, text``; other columns ignored).

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest ``doc_id`` stays. A
    null ``doc_id`` is smaller than any other: such rows stay only in groups without ids, where all rows are kept,
    as they can't be told apart; so does every row that repeats the kept id. An empty table gives no rows.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(text_or_empty()).alias("digest")))
    groups = live_digests(rows.select("digest", F.col("doc_id").alias("keep_id")))
    return (rows.join(groups, "digest")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents whose text no row with a larger ``doc_id`` repeats, with all their columns.

    Id and text decide together: of two texts under one id each stays only if it is the last of its own copies. Null texts are
    empty ones, rows that repeat a kept id and text all stay, an empty table gives no rows.
    """
    groups = exact_groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = text_digest(text_or_empty("row.text")) == F.col("text_sha256")
    return rows.join(groups, same & F.col("row.doc_id").cast("long").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
