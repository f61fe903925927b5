"""Near copies by the similarity of their word shingles (near_dedup stage of the pipeline).

Two texts are linked if the Jaccard similarity of their sets of five-word shingles is at least 0.8. Candidates meet in
bands of min-hashes: rows of a band agree with chance ``similarity ** ROWS``, so a pair at 0.8 shares none of the
bands with chance 2.5e-7, one that is more similar with less. (A 64-bit SimHash of such a pair differs in ten bits on average:
no distance an index can hold finds nearly all. What the index of fingerprints finds comes as buckets of its own.) Each candidate pair is then compared by the whole
sets, in two steps that never hold a bucket as a whole:

1. Each member of a bucket meets the bucket's smallest id. Over all buckets these pairs are made distinct, so near copies that share
   most of their bands are compared once; the members of a smallest id are streamed past it in parts of bounded size.
2. The links found are united to groups. What is left of a bucket are members of different groups; they are dealt into blocks of
   bounded size, and each pair of blocks compares across groups only. Buckets with the same members are one.

A crowd of near copies is one group after step 1 and never meets block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import materialize, text_or_empty
from specloom.llm.graph import components

SHINGLE = 5  # words, as bound by the stage
SIMILARITY = 0.8
BANDS, ROWS = 50, 6
SEED = 42
PART = 1024  # shingles that are min-hashed at once
STAR = 2048  # members that are streamed past a smallest id in one part
BLOCK = 256  # members of a block, on average
BLOCK_SHINGLES = 500_000  # shingles of a block, on average
_random = np.random.Generator(np.random.PCG64(SEED))
FACTORS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIXERS = _random.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # as in simhash.fingerprint
    if len(words) < shingle:
        joined = [b" ".join(words)] if words else []
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in joined], dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band: a hash of the band's number and its min-hashes."""
    least = np.full(len(FACTORS), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(hashes), PART):
        least = np.minimum(least, (FACTORS * hashes[at:at + PART]).min(axis=1))
    least ^= least >> np.uint64(31)
    keys = (least.reshape(BANDS, ROWS) * MIXERS).sum(axis=1, dtype=np.uint64) + MIXERS[:, 0]
    return keys ^ (keys >> np.uint64(32))


def _mark_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_set(text, shingle)
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(hashes))
                keys.append(band_keys(hashes).view(np.int64) if len(hashes) else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "size", "keys"])
    return run


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of hashes have at least this Jaccard similarity."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    at = np.searchsorted(a, b)
    shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


def bucket_links(ids: np.ndarray, sets: list[np.ndarray], similarity: float, group: np.ndarray | None = None,
                 side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links among the members of one bucket, by their whole sets.

    Members of one ``group`` count as linked; with ``side``, only members of different sides are compared.
    """
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    holders, begin = owner[order], np.concatenate([[0], np.cumsum(np.bincount(flat))])
    ends = np.cumsum(sizes)
    group, out = np.arange(len(sets)) if group is None else group.copy(), []
    for i in range(len(sets) - 1):
        others = group != group[i]
        others[:i + 1] = False
        if side is not None:
            others &= side != side[i]
        if not others.any():
            continue
        mine = flat[ends[i] - sizes[i]:ends[i]]
        shared = np.bincount(np.concatenate([holders[begin[f]:begin[f + 1]] for f in mine.tolist()]), minlength=len(sets))
        near = others & (shared >= similarity * (sizes[i] + sizes - shared) - 1e-9)
        for j in np.flatnonzero(near).tolist():
            if group[j] != group[i]:
                out.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
    return out


def _links_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["src", "dst"])


def _star_batches(shingle: int, similarity: float):
    """Rows ``low, part, node_id, text`` sorted by those in, the smallest id first; its links with the others out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, centre = None, []
        for batch in batches:
            found = []
            for low, part, node, text in zip(*(batch.column(n).to_pylist() for n in ("low", "part", "node_id", "text"))):
                if (low, part) != last:
                    last, centre = (low, part), []
                mine = shingle_set(text, shingle)
                if node == low:
                    centre.append(mine)  # more than one only if texts share this id
                elif any(similar(c, mine, similarity) for c in centre):
                    found.append((low, node))
            yield _links_batch(found)
    return run


def _block_batches(shingle: int, similarity: float):
    """Rows ``key, i, j, side, node_id, comp, text`` sorted by key, i and j in; links of each pair of blocks out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, groups, sides, sets, last = [], [], [], [], None

        def close():
            if len(ids) < 2:
                return []
            i, j = last[1:]
            return bucket_links(np.array(ids), sets, similarity, np.array(groups), None if i == j else np.array(sides))
        for batch in batches:
            found = []
            for key, i, j, side, node, comp, text in zip(*(batch.column(n).to_pylist() for n in (
                    "key", "i", "j", "side", "node_id", "comp", "text"))):
                if (key, i, j) != last:
                    found += close()
                    ids, groups, sides, sets, last = [], [], [], [], (key, i, j)
                ids.append(node)
                groups.append(comp)
                sides.append(side)
                sets.append(shingle_set(text, shingle))
            yield _links_batch(found)
        yield _links_batch(close())
    return run


def near_links(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, star: int = STAR, block: int = BLOCK,
               buckets: DataFrame | None = None) -> DataFrame:
    """``src, dst``: links that connect just the ids of texts whose shingle sets are similar enough (``doc_id, text``).

    Texts without words are equal. Rows with a null ``doc_id`` link with nothing; rows of one ``doc_id`` count as linked. An empty
    table gives no rows. ``star`` and ``block`` bound what a task holds and change no result. ``buckets`` (``node_id, key``) are candidates
    found elsewhere, as those of the fingerprint index; their members are compared like those of a band.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where("doc_id is not null")
    marks = materialize(rows.mapInArrow(_mark_batches(shingle), "doc_id long, digest binary, size long, keys array<long>"))
    nodes = marks.groupBy("digest").agg(F.min("doc_id").alias("node_id"), F.count("*").alias("copies"))
    copies = marks.select("doc_id", "digest").join(nodes.where("copies > 1"), "digest").where("doc_id > node_id").select(
        F.col("doc_id").alias("src"), F.col("node_id").alias("dst"))
    first = marks.join(nodes.withColumnRenamed("node_id", "doc_id").select("digest", "doc_id"), ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"]).select("doc_id", "size", "keys")
    bands = first.select(F.col("doc_id").alias("node_id"), "size", F.explode("keys").alias("key"))
    if buckets is not None:
        sizes = first.where("size > 0").select(F.col("doc_id").alias("node_id"), "size").distinct()
        bands = bands.unionByName(sizes.join(buckets.distinct(), "node_id").select("node_id", "size", "key"))
    bands = materialize(bands)
    lows = bands.groupBy("key").agg(F.min("node_id").alias("low"), F.max("node_id").alias("high")).where("low < high").select("key", "low")
    members = materialize(bands.join(lows, "key").where("node_id > low"))
    texts = rows.withColumnRenamed("doc_id", "node_id")

    stars = materialize(members.select("low", "node_id").distinct())
    parts = stars.groupBy("low").agg(F.ceil(F.count("*") / F.lit(star)).cast("int").alias("parts"))
    spokes = stars.join(parts, "low").select("low", F.pmod(F.xxhash64("node_id"), F.col("parts")).cast("int").alias("part"), "node_id")
    centres = parts.select("low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("low").alias("node_id"))
    linked = materialize(spokes.unionByName(centres).join(texts, "node_id").select("low", "part", "node_id", "text").repartition("low", "part")
                         .sortWithinPartitions("low", "part", "node_id").mapInArrow(_star_batches(shingle, similarity), "src long, dst long"))

    named = components(linked)
    stars_found = named.select(F.col("node").alias("src"), F.col("component").alias("dst"))  # connect what ``linked`` does
    rest = members.join(named.withColumnRenamed("node", "node_id"), "node_id", "left").select(
        "key", "node_id", "size", F.coalesce("component", "node_id").alias("comp"))
    rest = materialize(rest)
    same = ["n", "total", "low", "high", "all", "again"]
    open_ = rest.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"), F.min("node_id").alias("low"), F.max("node_id").alias("high"),
        F.bit_xor(F.xxhash64("node_id")).alias("all"), F.bit_xor(F.xxhash64("node_id", F.lit(1))).alias("again"),
        F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b")
    open_ = open_.groupBy(*same).agg(F.min("key").alias("key")).select(
        "key", F.ceil(F.greatest(F.col("n") / F.lit(block), F.col("total") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks"))
    dealt = rest.join(open_, "key").withColumn("side", F.pmod(F.xxhash64("node_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node_id", "comp")
    found = (pairs.join(texts, "node_id").select("key", "i", "j", "side", "node_id", "comp", "text").repartition("key", "i", "j")
             .sortWithinPartitions("key", "i", "j").mapInArrow(_block_batches(shingle, similarity), "src long, dst long"))
    return copies.unionByName(stars_found).unionByName(found)
