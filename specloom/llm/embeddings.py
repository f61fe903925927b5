"""Embedding near-duplicates: cross-polytope hashing with fast Hadamard rotations (operator 1).

A hash function rotates a vector by three rounds of random signs and a Hadamard transform; its value is the coordinate of
largest magnitude and its sign. A table joins as many functions as the number of vectors asks for, and the more functions it joins and the more
dimensions there are, the more tables there are (:func:`tables_for`). A vector is at home
in one bucket of each table and probes the next likely ones. Buckets that can't hold a pair are dropped by their counts
before vectors move; those left are verified in blocks. A pair that meets in several buckets counts in the first one
only, which both vectors' hashes tell, so links are counted and joined without listing pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from specloom.llm.common import materialize
from specloom.llm.graph import components
from specloom.llm.simhash import forest

COSINE = 0.95
TABLES, PROBES = 6, 4  # at least so many tables; more where a pair would else be missed too often
MISSED = 0.001  # share of pairs at the very threshold that no table may bring together
BLOCK = 2048  # members of a bucket that are compared with as many others in one piece of work
PAIRS = 500_000  # near pairs that a task looks at together
PER_BUCKET = 4  # unrelated vectors per bucket that the number of functions aims at


class CrossPolytope:
    """Hashes of unit vectors of one dimension; the same for every task."""

    def __init__(self, dimension: int, functions: int, tables: int = TABLES, probes: int = PROBES):
        # short vectors are padded too: in few dimensions there are few different rotations, and tables would not be independent
        self.dimension, self.width = dimension, 1 << max(6, (dimension - 1).bit_length())
        self.functions, self.tables, self.probes = functions, tables, probes
        draw = np.random.default_rng([dimension, 7])
        self.signs = draw.choice([-1.0, 1.0], size=(tables, functions, 3, self.width))
        self.odd = draw.integers(1, 1 << 62, size=(tables, functions), dtype=np.int64) * 2 + 1

    def _rotate(self, x: np.ndarray, signs: np.ndarray) -> np.ndarray:
        for s in signs:
            x, step = x * s, 1
            while step < self.width:
                y = x.reshape(len(x), -1, 2, step)
                x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), self.width)
                step *= 2
        return x

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys: home (n, tables) and probes (n, tables, probes)."""
        n, k = len(vectors), self.functions
        padded = np.zeros((n, self.width))
        padded[:, :self.dimension] = vectors
        home = np.zeros((n, self.tables), dtype=np.int64)
        probe = np.zeros((n, self.tables, self.probes), dtype=np.int64)
        rows = np.arange(n)[:, None]
        take = min(self.probes + 1, self.width)
        for t in range(self.tables):
            values, losses = [], []
            for f in range(k):
                r = self._rotate(padded, self.signs[t, f])
                size = np.abs(r)
                top = np.argsort(-size, axis=1, kind="stable")[:, :take]
                best = size[rows, top]
                with np.errstate(over="ignore"):
                    values.append((2 * top + (r[rows, top] < 0) + 1) * self.odd[t, f])
                losses.append(np.square(1 - best / best[:, :1]))
            total = sum(v[:, 0] for v in values) + t
            home[:, t] = total
            # one function at a time takes its next best coordinate: the cheapest changes first
            changed = np.concatenate([total[:, None] - v[:, :1] + v[:, 1:] for v in values], axis=1)
            loss = np.concatenate([x[:, 1:] for x in losses], axis=1)
            order = np.argsort(loss, axis=1, kind="stable")[:, :self.probes]
            found = changed[rows, order]
            probe[:, t, :found.shape[1]] = found
            probe[:, t, found.shape[1]:] = total[:, None]
        return home, probe


@functools.lru_cache(maxsize=64)
def tables_for(dimension: int, functions: int, cosine: float = COSINE, probes: int = PROBES, missed: float = MISSED) -> int:
    """Tables that bring all but ``missed`` of the pairs at ``cosine`` together.

    How often one table does so depends on dimension, functions and probes alone, not on the data, so it is measured on drawn pairs
    at the threshold (closer pairs meet more often): 2,000 for common dimensions, fewer for very long vectors. Twice the standard error is
    taken off. Tables are drawn independently, so the share missed by all of them is a power.
    """
    pairs = int(min(2000, max(32, (1 << 20) // dimension)))
    if dimension < 2:
        return TABLES  # all vectors of one sign are equal
    draw = np.random.default_rng([dimension, functions, 11])
    a = unit(list(draw.normal(size=(pairs, dimension))))
    aside = draw.normal(size=(pairs, dimension))
    aside = unit(list(aside - (aside * a).sum(axis=1, keepdims=True) * a))
    b = max(-1.0, min(1.0, cosine)) * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * aside
    hasher = CrossPolytope(dimension, functions, 4, probes)
    (home_a, probe_a), (home_b, probe_b) = hasher.keys(a), hasher.keys(b)
    met = (home_a == home_b) | (probe_a == home_b[:, :, None]).any(axis=2) | (probe_b == home_a[:, :, None]).any(axis=2)
    share = max(0.01, met.mean() - 2 * math.sqrt(met.mean() * (1 - met.mean()) / pairs))
    return TABLES if share > 0.999 else max(TABLES, math.ceil(math.log(missed) / math.log(1 - share)))


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def _hash_batches(functions: int, tables: int, probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashers: dict = {}
        for batch in batches:
            for dimension, rows in batch.groupby(batch["vector"].map(len)):
                hasher = hashers.setdefault(dimension, CrossPolytope(dimension, functions, tables, probes))
                home, probe = hasher.keys(unit(rows["vector"].tolist()))
                ids = rows["node"].to_numpy()
                yield pd.DataFrame({"node": np.repeat(ids, tables), "bucket": home.reshape(-1), "dim": dimension, "home": True})
                fresh = pd.DataFrame({"node": np.repeat(ids, tables * probes), "bucket": probe.reshape(-1), "dim": dimension, "home": False})
                yield fresh[fresh["bucket"].to_numpy() != np.repeat(home.reshape(-1), probes)].drop_duplicates()
    return run


def _first_key(a: np.ndarray, b: np.ndarray, home: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """The bucket in which a pair counts: the first table where one vector's home is the other's home or probe."""
    out, open_ = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
    for t in range(home.shape[1]):
        i, j = a[open_], b[open_]
        hi, hj = home[i, t], home[j, t]
        i_in_j = (probe[j, t] == hi[:, None]).any(axis=1) | (hi == hj)
        j_in_i = (probe[i, t] == hj[:, None]).any(axis=1) | (hi == hj)
        key = np.where(i_in_j & j_in_i, np.minimum(hi, hj), np.where(i_in_j, hi, hj))
        met = i_in_j | j_in_i
        out[open_[met]] = key[met]
        open_ = open_[~met]
    return out


def _verify(functions: int, tables: int, probes: int, cosine: float):
    """Rows of buckets (or of two blocks of one) in; ``a, b, n``: a link of the forest (n = 0) or ``n`` links of ``a`` out.

    Rows are sorted by bucket. The pairs of many buckets are told apart by their hashes at once.
    """
    columns = ["dim", "bucket", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            starts = changes(rows)
            held = rows.iloc[starts[-1]:].reset_index(drop=True)  # the last bucket may go on
            yield from work(rows.iloc[:starts[-1]])
        if held is not None:
            yield from work(held)

    def changes(rows: pd.DataFrame) -> np.ndarray:
        keys = rows[columns].to_numpy()
        return np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])

    def work(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for dim, part in rows.groupby("dim", sort=False):
            yield buckets(part.reset_index(drop=True), _hasher(int(dim), functions, tables, probes))

    def buckets(rows: pd.DataFrame, hasher: CrossPolytope) -> pd.DataFrame:
        x, ids, many = unit(rows["vector"].tolist()), rows["node"].to_numpy(), rows["copies"].to_numpy()
        at_home, block, bucket = rows["home"].to_numpy(), rows["block"].to_numpy(), rows["bucket"].to_numpy()
        crossed = rows["low"].to_numpy() != rows["high"].to_numpy()
        links, parent, found, size = np.zeros(len(x), dtype=np.int64), {}, [], 0

        def settle():
            a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            ok = (at_home[a] | at_home[b]) & ~(crossed[a] & (block[a] == block[b]))
            a, b = a[ok], b[ok]
            if not len(a):
                return
            used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            home, probe = hasher.keys(x[used])
            mine = _first_key(place[:len(a)], place[len(a):], home, probe) == bucket[a]
            a, b = a[mine], b[mine]
            np.add.at(links, a, many[b])
            np.add.at(links, b, many[a])
            forest(ids[a], ids[b], parent)
        starts = changes(rows)
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(x)]):
            for t in range(s, e - 1, 256):
                a, b = np.nonzero(x[t:min(t + 256, e)] @ x[s:e].T >= cosine)
                later = a + t < b + s
                if later.any():
                    found.append((a[later] + t, b[later] + s))
                    size += int(later.sum())
                if size > PAIRS:
                    settle()
                    found, size = [], 0
        if found:
            settle()
        some = links > 0
        edges = [(p, q) for p, q in parent.items() if p != q]
        return pd.DataFrame({"a": np.array([*ids[some], *(p for p, _ in edges)], dtype=np.int64),
                             "b": pd.array([None] * int(some.sum()) + [q for _, q in edges], "Int64"),
                             "n": np.array([*links[some], *[0] * len(edges)], dtype=np.int64)})
    return run


@functools.lru_cache(maxsize=8)
def _hasher(dimension: int, functions: int, tables: int, probes: int) -> CrossPolytope:
    return CrossPolytope(dimension, functions, tables, probes)


def usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _functions(nodes: DataFrame) -> tuple[int, int]:
    """Functions per table, so that a bucket of the commonest length holds few unrelated vectors, and the longest length."""
    lengths = nodes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    values = F.lit(2.0) * F.pow(F.lit(2.0), F.greatest(F.lit(6.0), F.ceil(F.log2(F.col("d")))))  # coordinates after padding, two signs each
    needed = F.ceil(F.log(F.greatest(F.lit(2.0), F.col("n") / PER_BUCKET)) / F.log(values))
    row = lengths.agg(F.max_by(needed, F.struct("n", "d")).alias("f"), F.max("d").alias("d")).first()
    return max(1, int(row["f"] or 1)), int(row["d"] or 2)


def near_vectors(rows: DataFrame, cosine: float = COSINE, tables: int | None = None, probes: int = PROBES, block: int = BLOCK,
                 functions: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``rows`` (``vec_id, embedding``; other columns ignored).

    Vectors that are null, zero or hold null or non-finite components link with nothing, as do vectors of different
    lengths. Equal vectors are one node with a count, and link with each other. A row with a null ``vec_id`` gets no id: it
    counts as a link of others, and its component is the smallest id reachable (null if none). Empty tables give no rows.
    ``functions`` per table follow from the number of different vectors of a length, ``tables`` from functions and the longest vector.
    """
    vectors = materialize(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
                          .withColumn("digest", F.when(usable(F.col("vector")), F.sha2(F.to_json(F.struct(F.transform(
                              "vector", lambda v: v + F.lit(0.0)).alias("v"))), 256))))
    nodes = materialize(vectors.where("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("node", F.coalesce("least", F.xxhash64("digest").bitwiseOR(F.lit(-(1 << 63))))))  # below any id
    functions, longest = _functions(nodes) if functions is None else (functions, _functions(nodes)[1])
    tables = tables or tables_for(longest, functions, cosine, probes)
    hashed = nodes.select("node", "vector").mapInPandas(_hash_batches(functions, tables, probes), "node long, bucket long, dim int, home boolean")
    hashed = materialize(hashed)
    sizes = hashed.groupBy("dim", "bucket").agg(F.count("*").alias("members"), F.max("home").alias("owned")).where("owned and members > 1")
    # large buckets are cut into blocks; each pair of blocks is a piece of work of its own
    placed = hashed.join(sizes.drop("owned"), ["dim", "bucket"]).withColumn("blocks", F.ceil(F.col("members") / block))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("node", "bucket", "dim", "home", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = (placed.join(nodes.select("node", "vector", "copies"), "node").repartition("dim", "bucket", "low", "high")
             .sortWithinPartitions("dim", "bucket", "low", "high", "node")
             .mapInPandas(_verify(functions, tables, probes, cosine), "a long, b long, n long"))
    found = materialize(found)
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    joined = components(found.where("b is not null"), "a", "b")
    # ids of nodes without a vec_id stand below all others, so the component's smallest real id is looked up
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(counts, "node", "left").select(
        "digest", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    good = vectors.where("digest is not null").select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", "component_id")
    rest = vectors.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
