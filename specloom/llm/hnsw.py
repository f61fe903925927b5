"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard (operator 13).

Different vectors are dealt into shards by a hash. A task builds a shard's graph: every vector has a level drawn from its
key, neighbours of a layer are one flat array, and vectors are inserted in batches whose beam searches step together. The graph is
stored as one row per shard. Queries visit every shard, a group of queries and a shard being one piece of work; distances are
taken anew from the original vectors in double precision, and the shards' results are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.llm.common import materialize
from specloom.llm.embeddings import usable

SHARD = 8192  # vectors per graph
QUERIES = 16384  # queries that visit a graph as one piece of work
NEAREST = 10
DEGREE = 16  # neighbours per vector, twice as many in the lowest layer
BUILD, SEARCH = 96, 160  # widths of the beam
BATCH = 256  # vectors inserted, or queries that search, together
EXPAND = 4  # vectors of a beam that are expanded in a step


class Graph:
    """Layers of neighbour arrays over the rows of ``vectors``; the same input gives the same graph in every task."""

    def __init__(self, vectors: np.ndarray, draws: np.ndarray, degree: int = DEGREE):
        """``draws``: a number in [0, 1) per row that decides its level."""
        self.exact, self.degree = np.ascontiguousarray(vectors, dtype=np.float64), degree
        # the graph is walked over float32 vectors brought to at most one, so that squares stay finite
        largest = max(float(np.abs(self.exact).max(initial=0.0)), np.finfo(np.float64).tiny)
        self.scale = largest
        self.x = (self.exact / largest).astype(np.float32)
        self.square = np.einsum("ij,ij->i", self.x, self.x)
        levels = np.minimum((-np.log(1.0 - draws) / np.log(degree)).astype(np.int64), 12)
        self.order = np.lexsort((np.arange(len(levels)), -levels))  # high levels first: the upper layers stand before the lower ones fill
        self.levels = levels
        self.layers = [np.full((len(levels), 2 * degree if at == 0 else degree), -1, dtype=np.int32)
                       for at in range(int(levels.max(initial=0)) + 1)]
        self.entry = int(self.order[0]) if len(levels) else -1

    def together(self, width: int, most: int) -> int:
        """Rows whose ``width`` candidates each are looked at in one step, so that long vectors take no more memory."""
        return max(1, min(most, (1 << 22) // max(1, width * self.x.shape[1])))

    # searching

    def _distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances, up to each query's own square."""
        return self.square[ids] - 2 * np.einsum("ij,ikj->ik", queries, self.x[ids])

    def beam(self, queries: np.ndarray, layer: int, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest found per query in a layer, from ``start`` (one row of ids per query): ids (-1: none) and distances."""
        links, n = self.layers[layer], len(queries)
        rows = np.arange(n)
        seen = np.zeros((n, len(self.x)), dtype=bool)
        mark = np.zeros((n, len(self.x)), dtype=np.int16)
        ids = np.full((n, width), -1, dtype=np.int64)
        dist = np.full((n, width), np.inf, dtype=np.float32)
        done = np.ones((n, width), dtype=bool)
        ids, dist, done = self._merge(queries, rows, start, seen, mark, ids, dist, done)
        open_ = rows
        while len(open_):
            todo = ~done[open_]
            alive = todo.any(axis=1)
            open_, todo = open_[alive], todo[alive]
            if not len(open_):
                break
            # the nearest unexpanded ones of every beam; beams are sorted by distance
            places = np.argsort(~todo, axis=1, kind="stable")[:, :EXPAND]
            usable_ = np.take_along_axis(todo, places, axis=1)
            done[open_[:, None], places] |= usable_
            near = np.where(usable_[:, :, None], links[ids[open_[:, None], places]], -1).reshape(len(open_), -1).astype(np.int64)
            a, b, c = self._merge(queries[open_], open_, near, seen, mark, ids[open_], dist[open_], done[open_])
            ids[open_], dist[open_], done[open_] = a, b, c
        return ids, dist

    def _merge(self, queries, rows, near, seen, mark, ids, dist, done):
        """Beams with the candidates ``near`` that were not seen before."""
        safe = np.maximum(near, 0)
        fresh = (near >= 0) & ~seen[rows[:, None], safe]
        # of a candidate met twice in a step one stays: the place written last
        place = np.broadcast_to(np.arange(near.shape[1], dtype=np.int16), near.shape)
        r, c = np.nonzero(fresh)
        mark[rows[r], near[r, c]] = place[r, c]
        fresh[r, c] = mark[rows[r], near[r, c]] == place[r, c]
        seen[rows[r], near[r, c]] = True
        d = np.where(fresh, self._distances(queries, safe), np.inf).astype(np.float32)
        all_ids = np.concatenate([ids, np.where(fresh, near, -1)], axis=1)
        all_dist = np.concatenate([dist, d], axis=1)
        all_done = np.concatenate([done, ~fresh], axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :ids.shape[1]]
        return tuple(np.take_along_axis(x, best, axis=1) for x in (all_ids, all_dist, all_done))

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """The nearest vector found in the layers above ``to``, per query."""
        at = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            at = self.beam(queries, layer, at, 1)[0]
        return at

    def search(self, queries: np.ndarray, most: int, width: int = SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest found of each query (float64 rows), nearest first: ids (-1: none) and exact distances."""
        if self.entry < 0:
            return np.full((len(queries), most), -1), np.full((len(queries), most), np.inf)
        scaled = (queries / self.scale).astype(np.float32)
        step = self.together(2 * EXPAND * self.degree, len(queries) or 1)
        ids = np.concatenate([self.beam(q, 0, self.descend(q, 0), max(width, most))[0] for q in (
            scaled[at:at + step] for at in range(0, max(1, len(scaled)), step))])
        return ids, np.where(ids >= 0, distances(queries, self.exact[np.maximum(ids, 0)]), np.inf)

    # building

    def build(self, width: int = BUILD, batch: int = BATCH) -> "Graph":
        """Insert all vectors. A batch is no larger than the graph so far; its members see each other as candidates too."""
        batch, done = self.together(max(width, 2 * EXPAND * self.degree), batch), min(1, len(self.order))
        while done < len(self.order):
            some = self.order[done:done + min(batch, done)]
            self._insert(some, width)
            done += len(some)
        return self

    def _insert(self, some: np.ndarray, width: int) -> None:
        levels = self.levels[some]
        at = np.full((len(some), 1), self.entry, dtype=np.int64)
        for layer in range(len(self.layers) - 1, -1, -1):
            inside = np.flatnonzero(levels >= layer)
            outside = np.flatnonzero(levels < layer)
            if len(outside):
                at[outside] = self.beam(self.x[some[outside]], layer, at[outside], 1)[0]
            if not len(inside):
                continue
            new = some[inside]
            ids, dist = self.beam(self.x[new], layer, at[inside], width)
            at[inside] = ids[:, :1]
            # the batch among itself
            own = np.broadcast_to(new, (len(new), len(new))).copy()
            np.fill_diagonal(own, -1)
            d = np.where(own >= 0, self._distances(self.x[new], np.maximum(own, 0)), np.inf).astype(np.float32)
            ids, dist = np.concatenate([ids, own], axis=1), np.concatenate([dist, d], axis=1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :width]
            chosen = self._spread(self.x[new], np.take_along_axis(ids, best, axis=1), np.take_along_axis(dist, best, axis=1), self.degree)
            self.layers[layer][new, :chosen.shape[1]] = chosen
            self._link_back(layer, new, chosen)

    def _spread(self, queries: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Per row at most ``most`` of the candidates (sorted by distance) that are nearer to it than to any taken before; places
        left over are filled with the nearest of the rest. -1: none."""
        n, k = ids.shape
        safe = np.maximum(ids, 0)
        vectors, squares = self.x[safe], self.square[safe]
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        real = dist + np.einsum("ij,ij->i", queries, queries)[:, None]
        blocked = ids < 0
        taken = np.zeros((n, k), dtype=bool)
        count = np.zeros(n, dtype=np.int64)
        for c in range(k):
            take = ~blocked[:, c] & (count < most)
            taken[take, c] = True
            count[take] += 1
            blocked |= take[:, None] & (between[:, c, :] < real)
        rank = np.where(taken, 0, np.where(ids >= 0, 1, 2))
        best = np.argsort(rank, axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(rank, best, axis=1) < 2, np.take_along_axis(ids, best, axis=1), -1)

    def _link_back(self, layer: int, new: np.ndarray, chosen: np.ndarray) -> None:
        """Every chosen neighbour gets the new vector as its neighbour; full lists are chosen anew."""
        links = self.layers[layer]
        target, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
        target, source = target[target >= 0], source[target >= 0]
        order = np.lexsort((source, target))
        target, source = target[order], source[order]
        nodes, begin, many = np.unique(target, return_index=True, return_counts=True)
        step = self.together(links.shape[1] + int(many.max(initial=0)), 1024)
        for at in range(0, len(nodes), step):
            part, first, number = nodes[at:at + step], begin[at:at + step], many[at:at + step]
            more = np.arange(int(number.max()))
            extra = np.where(more < number[:, None], source[np.minimum(first[:, None] + more, len(source) - 1)], -1)
            old = links[part].astype(np.int64)
            extra[(extra[:, :, None] == old[:, None, :]).any(axis=2)] = -1
            ids = np.concatenate([old, extra], axis=1)
            room = links.shape[1]
            order = np.argsort(ids < 0, axis=1, kind="stable")
            ids = np.take_along_axis(ids, order, axis=1)
            over = (ids >= 0).sum(axis=1) > room
            links[part[~over]] = ids[~over, :room]
            if over.any():
                crowd = ids[over][:, :int((ids[over] >= 0).sum(axis=1).max())]
                own = self.x[part[over]]
                d = np.where(crowd >= 0, self._distances(own, np.maximum(crowd, 0)), np.inf).astype(np.float32)
                best = np.argsort(d, axis=1, kind="stable")
                links[part[over]] = self._spread(own, np.take_along_axis(crowd, best, axis=1), np.take_along_axis(d, best, axis=1), room)

    # storing

    def arrays(self) -> dict:
        """The graph as flat arrays."""
        return {"size": len(self.exact), "width": self.exact.shape[1], "entry": self.entry, "degree": self.degree,
                "vectors": self.exact.tobytes(), "layers": [layer.tobytes() for layer in self.layers]}

    @classmethod
    def of(cls, stored: dict) -> "Graph":
        shape = (stored["size"], stored["width"])
        graph = cls(np.frombuffer(stored["vectors"]).reshape(shape), np.zeros(stored["size"]), stored["degree"])
        graph.layers = [np.frombuffer(layer, dtype=np.int32).reshape(stored["size"], -1) for layer in stored["layers"]]
        graph.entry = stored["entry"]
        return graph


def distances(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances of each query to its row of vectors in double precision, added up from the first component on."""
    total = np.zeros(others.shape[:2])
    for i in range(queries.shape[1]):
        total += np.square(queries[:, None, i] - others[:, :, i])
    if np.isfinite(total).all():
        return np.sqrt(total)
    largest = np.abs(queries[:, None, :] - others).max(axis=2)  # squares beyond a double
    part = (queries[:, None, :] - others) / np.maximum(largest, np.finfo(np.float64).tiny)[:, :, None]
    return np.where(np.isfinite(total), np.sqrt(total), largest * np.sqrt(np.square(part).sum(axis=2)))


# Spark ------------------------------------------------------------------------------------------------------------------

MOST_TASKS = 20_000
GRAPH = "dim int, shard long, parts long, ids array<bigint>, size int, width int, entry int, degree int, vectors binary, layers array<binary>"
FOUND = "query_id long, node long, distance double"


def _build(degree: int, width: int, batch: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        node = rows["node"].to_numpy()
        draws = (rows["draw"].to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        graph = Graph(np.array(rows["vector"].tolist()), draws, degree).build(width, batch)
        return pd.DataFrame([{"dim": key[0], "shard": key[1], "parts": key[2], "ids": node, **graph.arrays()}])
    return run


def _visit(most: int, width: int, batch: int):
    """Rows of one piece of work come together: the graph first, then its queries."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, graph, ids = None, None, None
        for rows in batches:
            key = list(zip(rows["dim"], rows["shard"], rows["part"]))
            begins = [i for i in range(len(key)) if i == 0 or key[i] != key[i - 1]]
            for s, e in zip(begins, [*begins[1:], len(key)]):
                part = rows.iloc[s:e]
                if key[s] != work:
                    stored = part.iloc[0]
                    work, ids, part = key[s], np.array(stored["ids"]), part.iloc[1:]
                    graph = Graph.of(stored)
                for at in range(0, len(part), batch):
                    some = part.iloc[at:at + batch]
                    found, dist = graph.search(np.array(some["vector"].tolist()), most, width)
                    nodes = np.where(found >= 0, ids[np.maximum(found, 0)], np.iinfo(np.int64).max)
                    best = np.lexsort((nodes, dist), axis=1)[:, :most]
                    nodes, dist = np.take_along_axis(nodes, best, axis=1), np.take_along_axis(dist, best, axis=1)
                    good = np.isfinite(dist)
                    yield pd.DataFrame({"query_id": np.broadcast_to(some["query_id"].to_numpy()[:, None], nodes.shape)[good],
                                        "node": nodes[good], "distance": dist[good]})
    return run


def nearest(rows: DataFrame, queries: Column, most: int = NEAREST, shard: int = SHARD, query_block: int = QUERIES, degree: int = DEGREE,
            build: int = BUILD, search: int = SEARCH, batch: int = BATCH) -> DataFrame:
    """``query_id long, rank int, vec_id long, score double``: each query's nearest rows found, by Euclidean distance.

    ``rows`` has ``vec_id, embedding``; other columns are ignored. ``queries`` is a condition on ``vec_id``; a query's own row is
    no candidate. Ties go to the smaller ``vec_id``; equal vectors are one node of a graph and all count. Vectors meet those of their
    own length. Rows with a null id and vectors that are null, zero or hold null or non-finite components take no part; of
    rows with one ``vec_id`` the smallest vector counts. Queries without candidates and empty tables give no rows.
    """
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda v: v + F.lit(0.0))  # no negative zeros
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    known = known.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    known = materialize(known.withColumn("digest", F.sha2(F.to_json(F.struct("vector")), 256)).withColumn("query", F.coalesce(queries, F.lit(False))))
    nodes = known.groupBy("digest").agg(F.min("vec_id").alias("node"), F.first("vector").alias("vector"))
    nodes = materialize(nodes.select("node", "vector", F.size("vector").alias("dim"), F.xxhash64("digest").alias("draw")))
    # the first ids of every node: enough for any query's list, its own row among them
    copies = known.withColumn("place", F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))).where(F.col("place") <= most + 1)
    copies = copies.withColumn("node", F.min("vec_id").over(Window.partitionBy("digest"))).select("node", "vec_id")

    asked = known.where("query").select(F.col("vec_id").alias("query_id"), F.size("vector").alias("dim"), F.col("vector").alias("query_vector"))
    # per length: the number of shards, and of groups of queries
    plan = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard).alias("shards")).join(
        asked.groupBy("dim").agg(F.ceil(F.count("*") / query_block).alias("parts")), "dim")
    plan = materialize(plan)
    total = plan.agg(F.sum("shards").alias("builds"), F.sum(F.col("shards") * F.col("parts")).alias("visits")).first()
    placed = nodes.join(plan, "dim").withColumn("shard", F.pmod(F.xxhash64("node"), "shards")).select("dim", "shard", "parts", "node", "vector", "draw")
    # a fixed number of partitions: pieces of work are small in bytes and long in time, so they are not put together
    graphs = placed.repartition(tasks(total["builds"]), "dim", "shard", "parts").groupBy("dim", "shard", "parts").applyInPandas(
        _build(degree, build, batch), GRAPH)
    graphs = materialize(graphs)
    asked = asked.join(plan, "dim").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    columns = [F.col(c) for c in ("ids", "size", "width", "entry", "degree", "vectors", "layers")]
    # numbers are never null, so that pandas keeps them whole
    absent = [F.lit(None).cast(kind).alias(c) for c, kind in (("ids", "array<bigint>"), ("vectors", "binary"), ("layers", "array<binary>"))]
    absent += [F.lit(0).alias(c) for c in ("size", "width", "entry", "degree")]
    graph_rows = graphs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "dim", "shard", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("query_id"), F.lit(None).cast("array<double>").alias("vector"), *columns)
    query_rows = asked.select("dim", "shard", "part", F.lit(1).alias("kind"), "query_id", F.col("query_vector").alias("vector"), *absent)
    found = (graph_rows.unionByName(query_rows).repartition(tasks(total["visits"]), "dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "kind", "query_id")
             .mapInPandas(_visit(most + 1, search, batch), FOUND))
    found = best_of(found, "node", most + 1)
    listed = found.join(copies, "node").where("vec_id <> query_id").select("query_id", "vec_id", "distance")
    return best_of(listed, "vec_id", most).select("query_id", "rank", "vec_id", F.col("distance").alias("score"))


def tasks(pieces: int | None) -> int:
    """Partitions for so many pieces of work: several each, so that few pieces share one by chance."""
    return min(MOST_TASKS, 4 * (pieces or 1))


def best_of(found: DataFrame, name: str, most: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", name))).where(F.col("rank") <= most)
