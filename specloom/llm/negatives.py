"""Hard negatives by exact integer inner products in residue number systems (operator 12).

Vectors become integers; a block of anchors meets a block of rows as one piece of work. Its score matrix is the product of
the residue matrices modulo several small primes, each in float32, where every partial sum stays below 2**24 and is
therefore exact; Chinese remaindering (mixed radix) gives back the signed scores. As many primes are taken as the largest
possible score of the block pair asks for. Two passes: the best rows of the anchor's label, then the rows of other labels whose
scores lie in the windows that these positives set.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.llm.common import materialize

SCALE = 256
BLOCK = 4096  # rows that meet a block of anchors at once
ANCHORS = 1024
EXACT = 1 << 24  # integers up to here are exact in float32
POSITIVES, NEGATIVES = 5, 3
#: a negative's score lies between these hundredths of its positive's score
WINDOW = (50, 95)
LONG = (1 << 63) - 1


# residues -------------------------------------------------------------------------------------------------------------

@functools.lru_cache(maxsize=64)
def primes_below(limit: int) -> tuple[int, ...]:
    """All odd primes below ``limit``, largest first."""
    sieve = np.ones(max(limit, 4), dtype=bool)
    sieve[:2] = False
    for p in range(2, int(limit ** 0.5) + 1):
        if sieve[p]:
            sieve[p * p::p] = False
    return tuple(int(p) for p in np.flatnonzero(sieve[:limit])[::-1] if p > 2)


def moduli(bound: int, width: int) -> list[int]:
    """Primes whose product tells all integers of magnitude ``bound`` apart; sums of ``width`` products of residues are exact."""
    half = int((EXACT / max(1, width)) ** 0.5)  # residues of magnitude up to `half`
    out, product = [], 1
    for p in primes_below(2 * half + 2):
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    if product <= 2 * bound:
        raise OverflowError("scores beyond the range of the residue system")
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of integers, as float32."""
    r = np.mod(x, p).astype(np.int64)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def gemm(a: np.ndarray, b: np.ndarray, width: int = 256) -> np.ndarray:
    """``a @ b.T`` of integer matrices (int64, or Python integers in object arrays), exact.

    Scores beyond 64 bits raise ``OverflowError``.
    """
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    # the largest sum of magnitudes of a row times the largest magnitude of the other side, in Python integers
    bound = max(1, int(np.abs(a).sum(axis=1).max()) * int(np.abs(b).max()))
    primes, digits = moduli(bound, min(width, a.shape[1])), []
    for p in primes:
        total = np.zeros((len(a), len(b)), dtype=np.int64)
        for at in range(0, a.shape[1], width):
            total += (residues(a[:, at:at + width], p) @ residues(b[:, at:at + width], p).T).astype(np.int64)
        digits.append(np.mod(total, p))
    return signed(digits, primes)


def signed(digits: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Chinese remaindering by mixed radix: the integer of smallest magnitude with these residues."""
    mixed = []
    for i, p in enumerate(primes):
        value, radix, sum_ = digits[i], 1, np.zeros_like(digits[i])
        for q, m in zip(primes, mixed):
            sum_ = (sum_ + m * radix) % p
            radix = radix * q % p
        mixed.append((value - sum_) * pow(radix, -1, p) % p)
    product = 1
    for p in primes:
        product *= p
    wide = product > LONG
    out, radix = mixed[0].astype(object) if wide else mixed[0].copy(), 1
    for m, p in zip(mixed[1:], primes):
        radix *= p
        out = out + (m.astype(object) if wide else m) * radix
    out = np.where(out > product // 2, out - product, out)
    if wide and np.abs(out).max() > LONG:
        raise OverflowError("a score has more than 64 bits")
    return out.astype(np.int64)


def integers(vectors: list, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as Python integers where that is too narrow."""
    x = np.floor(np.array(vectors, dtype=np.float64) * scale)
    if not np.isfinite(x).all():
        raise OverflowError("a scaled component is beyond a double")
    if np.abs(x).max(initial=0) < 1 << 40:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


# pieces of work -------------------------------------------------------------------------------------------------------

def _by_length(anchors: pd.DataFrame, rows: pd.DataFrame, scale: float):
    """Vectors of one length meet; rows come in order of ``vec_id``."""
    rows = rows.sort_values("vec_id", kind="stable")
    lengths = rows["vector"].map(len)
    for length, some in anchors.groupby(anchors["vector"].map(len), sort=False):
        others = rows[lengths == length]
        if len(others):
            yield some, others, gemm(integers(some["vector"].tolist(), scale).reshape(len(some), -1),
                                     integers(others["vector"].tolist(), scale).reshape(len(others), -1))


def _positives(scale: float, most: int):
    def run(key, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for some, others, scores in _by_length(anchors, rows, scale):
            ids = others["vec_id"].to_numpy()
            for anchor, line in zip(some["vec_id"].tolist(), scores):
                best = np.argsort(-line, kind="stable")[:most + 1]
                best = best[ids[best] != anchor][:most]
                found.append(pd.DataFrame({"anchor_id": anchor, "positive_id": ids[best], "positive_score": line[best]}))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []}).astype("int64")
    return run


def within(line: np.ndarray, positive: int, window: tuple[int, int]) -> tuple[int, int]:
    """First and last place of the descending scores ``line`` inside the window of ``positive``, in Python integers."""
    low, high = window
    top = high * positive // 100  # 100 s <= high p
    least = -(-low * positive // 100)  # 100 s >= low p
    rising = -line
    return int(np.searchsorted(rising, -top, side="left")), int(np.searchsorted(rising, -least, side="right"))


def _negatives(scale: float, most: int, window: tuple[int, int]):
    def run(key, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {n: [] for n in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        for some, others, scores in _by_length(anchors, rows, scale):
            ids, labels = others["vec_id"].to_numpy(), others["label"].to_numpy()
            for anchor, label, positives, line in zip(some["vec_id"].tolist(), some["label"].tolist(), some["positives"].tolist(), scores):
                other = np.flatnonzero(labels != label)
                order = other[np.argsort(-line[other], kind="stable")]
                line = line[order]
                for p in positives:
                    begin, end = within(line, int(p["positive_score"]), window)
                    for at in range(begin, min(end, begin + most)):
                        for name, value in zip(out, (anchor, p["positive_id"], p["positive_score"], ids[order[at]], line[at])):
                            out[name].append(int(value))
        return pd.DataFrame(out).astype("int64")
    return run


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
                   scale: float = SCALE, block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (all long, rank int).

    ``rows`` has ``vec_id, label, embedding``; other columns are ignored. ``anchors`` is a condition on ``vec_id``. An anchor's
    positives are its first rows of the same label; for each of them the first rows of other labels are returned
    whose score lies within ``window`` hundredths of the positive's. Scores are integer inner products of
    ``floor(scale * x)``; higher ones come first, ties by smaller ``vec_id``. Rows with a null id, label or vector, or with a
    null or non-finite component, take no part; of rows with one ``vec_id`` the smallest (label, vector) counts. Vectors meet
    those of their own length; an empty vector scores zero. An anchor without positives, or a positive without negatives, gives no row,
    as does an empty table. Scores of more than 64 bits raise an error.
    """
    vector = F.col("embedding").cast("array<double>")
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector"))
    known = known.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    known = known.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    known = materialize(known.withColumn("anchor", F.coalesce(anchors, F.lit(False))))
    marked = known.where("anchor").drop("anchor")
    known = known.drop("anchor")

    # pass 1, within labels: a label's rows and anchors are dealt into blocks, every pair of blocks is a piece of work
    cut = known.groupBy("label").agg(F.ceil(F.count("*") / block).alias("blocks")).join(
        marked.groupBy("label").agg(F.ceil(F.count("*") / anchor_block).alias("anchor_blocks")), "label")
    place = F.xxhash64("vec_id")
    at = ["label", "part", "anchor_part"]
    left = marked.join(cut, "label").withColumn("anchor_part", F.pmod(place, "anchor_blocks")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(*at, "vec_id", "vector")
    right = known.join(cut, "label").withColumn("part", F.pmod(place, "blocks")).withColumn(
        "anchor_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("anchor_blocks") - 1))).select(*at, "vec_id", "vector")
    found = apart(left).groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_positives(scale, positives), "anchor_id long, positive_id long, positive_score long")
    best = first(found, ["anchor_id"], ["positive_score", "positive_id"], positives).drop("rank")
    asked = marked.join(best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives")), "vec_id")  # a few per anchor
    asked = materialize(asked)

    # pass 2, across labels: all rows in blocks
    sizes = asked.agg(F.ceil(F.count("*") / anchor_block).alias("n")).first(), known.agg(F.ceil(F.count("*") / block).alias("n")).first()
    anchor_parts, parts = (max(1, int(s["n"])) for s in sizes)
    at = ["part", "anchor_part"]
    left = asked.withColumn("anchor_part", F.pmod(place, F.lit(anchor_parts))).withColumn("part", F.explode(numbers(parts)))
    right = known.withColumn("part", F.pmod(place, F.lit(parts))).withColumn("anchor_part", F.explode(numbers(anchor_parts)))
    found = apart(left).groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(
        _negatives(scale, negatives, window), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return first(found, ["anchor_id", "positive_id"], ["negative_score", "negative_id"], negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def apart(df: DataFrame) -> DataFrame:
    """The same columns with identities of their own, so that two tables of one origin can be grouped together."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def first(found: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first rows of each key, higher score first, ties by smaller id, with their ``rank``."""
    score, ident = order
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), ident))).where(F.col("rank") <= most)
