"""SimHash near-duplicates with a Gray-order hierarchical index (operator 5).

Fingerprints that differ in at most d bits agree on two of d + 2 blocks. The upper nodes of the index are the choices of two
agreeing blocks (a mask) with their bit pattern; for two bits a fingerprint lies below six of them, each of 32 bits. A node
with many members is factored once more by the same rule on its free bits: for two bits no node then holds more than 2^16.
Below a node, members are sorted by the rank of their free bits in Gray code and consecutive ones are factored into
inner nodes that hold the bits all of them share. A search descends with the differences counted so far and leaves out
a whole group as soon as they exceed two. Only a spanning forest of each node's links leaves the task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import materialize, text_or_empty
from specloom.llm.graph import components
from specloom.llm.near_copies import near_links

SHINGLE = 3  # words, by the contract of the query
SEED = 42
DISTANCE = 2
NEAR_SHINGLE = 5  # words, in the near_dedup stage of the pipeline
NEAR_DISTANCE = 3  # bits, there: upper nodes of 25 bits, so that few different texts meet
FANOUT = 8  # children of an inner node
SPLIT_ABOVE = 2048  # members from which an upper node is factored once more


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the XXH64 hashes of the word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z only, splits at 20 and 09-0D only
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in joined], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of each row; null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_fingerprint_batches(shingle), "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over distinct fingerprints: level 0 are the codes in Gray order, each upper level factors FANOUT nodes.

    A node is (mask, bits): the bits in which all codes below it agree and that no node above it has already tested.
    """

    def __init__(self, codes: np.ndarray, tested: int = 0):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        agree, bits = [np.full(len(codes), every)], [self.codes]
        while len(bits[-1]) > FANOUT:
            starts = np.arange(0, len(bits[-1]), FANOUT)
            all_ones, any_one = np.bitwise_and.reduceat(bits[-1], starts), np.bitwise_or.reduceat(bits[-1], starts)
            agree.append(np.bitwise_and.reduceat(agree[-1], starts) & ~(all_ones ^ any_one))
            bits.append(all_ones)
        above = np.full(len(bits[-1]), np.uint64(tested))
        self.levels = []  # from the top: masks and bits to test
        for level in range(len(bits) - 1, -1, -1):
            self.levels.append((agree[level] & ~above, bits[level]))
            above = np.repeat(agree[level] | above, FANOUT)[:len(bits[level - 1])] if level else above

    def search(self, queries: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, code in Gray order) within ``distance`` bits; groups beyond it are left out as a whole."""
        mask, bits = self.levels[0]
        q = np.repeat(np.arange(len(queries)), len(bits))
        node = np.tile(np.arange(len(bits)), len(queries))
        apart = np.bitwise_count((queries[q] ^ bits[node]) & mask[node]).astype(np.int8)
        for mask, bits in self.levels[1:]:
            near = apart <= distance
            q, node, apart = q[near], node[near], apart[near]
            first = node * FANOUT
            n = np.minimum(first + FANOUT, len(bits)) - first
            q, apart = np.repeat(q, n), np.repeat(apart, n)
            node = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            apart = apart + np.bitwise_count((queries[q] ^ bits[node]) & mask[node]).astype(np.int8)
        near = apart <= distance
        return q[near], node[near]


def forest(a: np.ndarray, b: np.ndarray, parent: dict) -> None:
    """Union-find step over links ``a[i] - b[i]``; roots are smallest ids."""
    for x, y in zip(a.tolist(), b.tolist()):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        while (up := parent.setdefault(y, y)) != y:
            parent[y] = y = parent[up]
        if x != y:
            parent[max(x, y)] = min(x, y)


def _node_links(codes: np.ndarray, ids: np.ndarray, mask: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among the members of one upper node."""
    if len(codes) == 2:
        ok = int(codes[0] ^ codes[1]).bit_count() <= distance
        return (ids[:1], ids[1:]) if ok else (ids[:0], ids[:0])
    index = GrayIndex(codes, mask)
    ids = ids[np.argsort(gray_rank(codes), kind="stable")]
    parent: dict = {}
    for at in range(0, len(codes), 512):
        q, hit = index.search(index.codes[at:at + 512], distance)
        q = q + at
        later = q < hit
        forest(ids[q[later]], ids[hit[later]], parent)
    links = [(x, y) for x, y in parent.items() if x != y]
    return np.array([x for x, _ in links], dtype=np.int64), np.array([y for _, y in links], dtype=np.int64)


def _partition_links(distance: int):
    """Rows ``mask, bits, fp, node_id`` sorted by node in; a forest of links per node out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            mask, bits = batch["mask"].to_numpy(), batch["bits"].to_numpy()
            starts = np.concatenate([[0], np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1])
            held = batch.iloc[starts[-1]:]  # the last node may go on
            yield links_of(batch.iloc[:starts[-1]], starts[:-1])
        if held is not None:
            yield links_of(held.reset_index(drop=True), np.array([0]))

    def links_of(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ends = np.append(starts[1:], len(rows))
        codes, ids, mask = rows["fp"].to_numpy().view(np.uint64), rows["node_id"].to_numpy(), rows["mask"].to_numpy().view(np.uint64)
        found = [_node_links(codes[s:e], ids[s:e], int(mask[s]), distance) for s, e in zip(starts, ends) if e - s > 1]
        empty = np.array([], dtype=np.int64)
        return pd.DataFrame({"src": np.concatenate([empty, *(f[0] for f in found)]), "dst": np.concatenate([empty, *(f[1] for f in found)])})
    return run


def _masks(distance: int, within: int = 0) -> list[int]:
    """Masks of which one agrees for any two codes at most ``distance`` bits apart that agree on ``within``."""
    free = np.array_split([i for i in range(64) if not within >> i & 1], distance + 2)
    blocks = [sum(1 << int(i) for i in block) for block in free]
    return [within | a | b for a, b in itertools.combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def similar_links(nodes: DataFrame, distance: int = DISTANCE, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """``src, dst``: links that connect just the distinct fingerprints (``fp, node_id``) within ``distance`` bits."""
    if not 0 <= distance <= 8:
        raise ValueError("upper nodes of a larger distance would share too few bits")
    masks = _masks(distance)
    below = nodes.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])))
    below = below.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = below.groupBy("mask", "bits").agg(F.count("*").alias("members")).where("members > 1")
    rows = materialize(below.join(sizes, ["mask", "bits"]))
    second = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in _masks(distance, m)]))])
    small = rows.where(F.col("members") <= split_above).select("mask", "bits", "fp", "node_id")
    large = (rows.where(F.col("members") > split_above).withColumn("mask", F.explode(second[F.col("mask")]))
             .withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))).select("mask", "bits", "fp", "node_id"))
    return (small.unionByName(large).repartition("mask", "bits").sortWithinPartitions("mask", "bits")
            .mapInPandas(_partition_links(distance), "src long, dst long"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs`` (``doc_id, text``; other columns ignored).

    A text with fewer words than a shingle is one shingle, one without words (empty, null) has fingerprint zero; both
    link like any other. ``component_id`` is the smallest ``doc_id`` reachable; a null ``doc_id`` never is one unless its
    fingerprint has no other id, and then its component is null and links with nothing. An empty table gives no rows.
    """
    marks = materialize(fingerprints(docs, shingle))
    nodes = marks.groupBy("fp").agg(F.min("doc_id").alias("node_id"))
    found = components(similar_links(nodes.where("node_id is not null"), distance))
    named = (nodes.join(found.withColumnRenamed("node", "node_id"), "node_id", "left")
             .select("fp", F.coalesce("component", "node_id").alias("component_id")))
    return (marks.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def near_buckets(docs: DataFrame, distance: int = NEAR_DISTANCE) -> DataFrame:
    """``node_id, key``: documents whose fingerprints of five-word shingles the index links, one key per group of two or more."""
    marks = materialize(fingerprints(docs.where("doc_id is not null"), NEAR_SHINGLE))
    nodes = marks.groupBy("fp").agg(F.min("doc_id").alias("node_id"), F.count("*").alias("n"))
    found = components(similar_links(nodes.select("fp", "node_id"), distance)).withColumnRenamed("node", "node_id")
    named = nodes.join(found, "node_id", "left").select("fp", "n", F.coalesce("component", "node_id").alias("group"))
    several = named.groupBy("group").agg(F.sum("n").alias("members")).where("members > 1").select("group")
    named = named.join(several, "group").select("fp", F.xxhash64("group", F.lit("fingerprint")).alias("key"))
    return marks.join(named, "fp").select(F.col("doc_id").alias("node_id"), "key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document (the smallest ``doc_id``) of each group of near copies, with all columns; rows without an id stay.

    Near copies are texts whose sets of five-word shingles have a similarity of 0.8 or more. The Gray-order index groups documents by
    their fingerprints, and the members of a group are compared by their whole sets (``near_copies``): the distance of fingerprints
    alone drops nothing. At 0.8 fingerprints differ in ten bits on average, more than an index can hold, so what it leaves apart
    meets in bands of min-hashes besides, and no near copy is lost.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    found = components(near_links(docs, buckets=near_buckets(docs)))
    return rows.join(found, F.col("row.doc_id").cast("long") == F.col("node"), "left_anti").select("row.*")
