"""Hard negatives and nearest neighbours against brute force, with nulls, ties, repeated rows, odd lengths and odd columns."""

import math

import numpy as np
import pytest

from specloom.llm import hnsw, negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, label int, embedding array<double>, rank int, score double, part string, vector int, anchor string, node long, shard int"


def frame(spark, rows):
    """``(vec_id, label, embedding)`` with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, label, v, 1, 0.5, "x", 2, "y", 3, 4) for i, label, v in rows], SCHEMA)


def sample(seed=0, n=160, size=12):
    r = np.random.default_rng(seed)
    rows = [(i, int(r.integers(0, 3)), [float(x) for x in r.normal(size=size)]) for i in range(n)]
    rows += [(n + i, 1, rows[20][2]) for i in range(8)]  # ties
    rows += [(10, 2, rows[3][2])]  # a repeated id: the smaller (label, vector) counts
    rows += [rows[5], rows[5]]  # whole rows repeated
    rows += [(500, None, rows[1][2]), (550, 1, None), (600, 1, [1.0, None]), (650, 1, [math.nan] * size), (700, 0, [math.inf] * size),
             (750, 0, [0.0] * size), (800, 0, [1.0, 2.0]), (801, 0, [2.0, 2.5]), (802, 1, [1.0, 1.5]), (850, 2, []), (None, 1, rows[2][2]), (-50, 2, rows[4][2])]
    return rows


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def one_per_id(rows, key):
    out = {}
    for row in rows:
        if row[0] is not None and (row[0] not in out or key(row) < key(out[row[0]])):
            out[row[0]] = row
    return out


# residues -----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("size,width,magnitude", [(1, 256, 5), (64, 256, 300), (700, 256, 1 << 20), (1000, 100, 1 << 26), (3, 256, 1 << 30), (0, 8, 1), (2, 256, 1 << 45)])
def test_products_are_exact(size, width, magnitude):
    r = np.random.default_rng(size)
    a, b = (r.integers(-magnitude, magnitude + 1, size=(k, size)) for k in (7, 5))
    if magnitude > 1 << 40:
        a, b = a.astype(object), b.astype(object) // (1 << 30)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert negatives.gemm(a, b, width).tolist() == want


def test_extremes_of_the_residue_system():
    a = np.array([[1 << 20, -(1 << 20)], [0, 0]])
    assert negatives.gemm(a, a).tolist() == [[1 << 41, 0], [0, 0]]
    with pytest.raises(OverflowError):
        negatives.gemm(np.array([[1 << 50]], dtype=object), np.array([[1 << 50]], dtype=object))
    primes = negatives.moduli(1 << 40, 64)
    assert math.prod(primes) > 1 << 41 and all((p // 2) ** 2 * 64 <= 1 << 24 for p in primes)


# hard negatives -------------------------------------------------------------------------------------------------------

def plain_negatives(rows, step):
    known = one_per_id([r for r in rows if r[1] is not None and good(r[2])], lambda r: (r[1], r[2]))
    ints = {i: (label, [math.floor(256 * x) for x in v]) for i, (_, label, v) in known.items()}
    out = []
    for anchor in ints:
        if anchor % step:
            continue
        label, a = ints[anchor]
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other) for i, (other, v) in ints.items() if i != anchor and len(v) == len(a))
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(anchor, i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 1024), (7, 3)])
def test_hard_negatives_against_brute_force(spark, blocks):
    rows = sample()
    got = negatives.hard_negatives(frame(spark, rows), anchors=F.col("vec_id") % 10 == 0, block=blocks[0], anchor_block=blocks[1])
    want = plain_negatives(rows, 10)
    assert len(want) > 60 and sorted(tuple(r) for r in got.collect()) == want
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_of_nothing(spark):
    df = frame(spark, sample())
    assert negatives.hard_negatives(df.limit(0), anchors=F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, anchors=F.lit(False)).count() == 0


# nearest neighbours ---------------------------------------------------------------------------------------------------

def plain_nearest(rows, step, most):
    known = one_per_id([r for r in rows if good(r[2]) and any(r[2])], lambda r: r[2])
    out = {}
    for q in known:
        if q % step == 0:
            near = sorted((math.dist(known[q][2], v), i) for i, (_, _, v) in known.items() if i != q and len(v) == len(known[q][2]))
            out[q] = near[:most]
    return {q: n for q, n in out.items() if n}


@pytest.mark.parametrize("shard,block", [(8192, 16384), (40, 5)])
def test_nearest_against_brute_force(spark, shard, block):
    rows = sample(3, n=300)
    got = hnsw.nearest(frame(spark, rows), queries=F.col("vec_id") % 10 == 0, shard=shard, query_block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want, lists = plain_nearest(rows, 10, 10), {}
    for r in got.orderBy("query_id", "rank").collect():
        lists.setdefault(r["query_id"], []).append(r)
    assert set(lists) == set(want)
    hits = total = 0
    for q, near in lists.items():
        assert [r["rank"] for r in near] == list(range(1, len(near) + 1)) and len(near) == len(want[q])
        true = {i: d for d, i in want[q]}
        hits, total = hits + sum(r["vec_id"] in true for r in near), total + len(near)
        assert all(math.isclose(r["score"], true[r["vec_id"]], rel_tol=1e-12, abs_tol=1e-12) for r in near if r["vec_id"] in true)
        assert [(r["score"], r["vec_id"]) for r in near] == sorted((r["score"], r["vec_id"]) for r in near)
    assert hits >= 0.97 * total


def test_many_equal_vectors_are_ranked_by_id(spark):
    r = np.random.default_rng(1)
    rows = [(i, 0, [1.0, 2.0, 3.0]) for i in range(0, 400, 2)] + [(i, 0, [float(x) for x in 9 + r.normal(size=3)]) for i in range(1, 60, 2)]
    got = hnsw.nearest(frame(spark, rows), queries=F.col("vec_id") == 100, shard=16).collect()
    assert [(x["rank"], x["vec_id"], x["score"]) for x in got] == [(k + 1, 2 * k, 0.0) for k in range(10)]


def test_recall_of_a_whole_graph():
    """4,000 vectors without structure, the hardest case, and as many in tight groups."""
    r = np.random.default_rng(0)
    loose = r.normal(size=(4000, 48))
    tight = np.repeat(r.normal(size=(40, 48)), 100, axis=0) + 0.05 * r.normal(size=(4000, 48))
    for x in (loose, tight):
        graph = hnsw.Graph(x, r.random(len(x))).build()
        queries = x[::50]
        ids, _ = hnsw.Graph.of(graph.arrays()).search(queries, 11)
        true = np.argsort(np.square(queries[:, None] - x[None]).sum(axis=2), axis=1)[:, :11]
        assert np.mean([len(set(a[:11]) & set(b)) / 11 for a, b in zip(ids.tolist(), true.tolist())]) >= 0.95


def test_distances_beyond_the_square_root_of_a_double():
    far = hnsw.distances(np.array([[1e200, 0.0]]), np.array([[[-1e200, 0.0], [1e200, 0.0]]]))
    assert far.tolist() == [[2e200, 0.0]]


def test_nearest_of_nothing(spark):
    df = frame(spark, sample())
    assert hnsw.nearest(df.limit(0), queries=F.col("vec_id") % 10 == 0).count() == 0
    assert hnsw.nearest(df.where("vec_id = 0"), queries=F.col("vec_id") % 10 == 0).count() == 0
