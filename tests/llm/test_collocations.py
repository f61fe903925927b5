"""Phrase collocations against a brute force, with crowded pairs, full bit tables, tiny chunks, nulls and odd columns."""

import collections
import random
import re

import numpy as np
import pytest

from specloom.llm import collocations

SCHEMA = "doc_id long, lang string, text string, phrase string, n long, bucket string, k int"


def documents(spark, rows):
    return spark.createDataFrame([(i, lang, text, "x", 1, "y", 2) for i, (lang, text) in enumerate(rows)], SCHEMA)


def plain(rows, least=30, top=2000):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3, 4):
                f["und" if lang is None else lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for w, c in counts.items() if len(w) == 1)
        found = []
        candidates = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        for w, a in candidates.items():
            score, k = min((2000000 * a // (counts[w[:k]] + counts[w[k:]]), k) for k in range(1, len(w)))
            longer = [b for v, b in candidates.items() if len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))]
            if not any(100 * b >= 80 * a for b in longer):
                found.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        for rank, (score, a, w, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, w.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed=0, n=700):
    r = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "city", "a", "é", "ß", "日本", "x-1", "z" * 50]
    rows = [(r.choice(["en", "de", None, "und", ""]), " ".join(r.choices(vocabulary, [9, 6, 5, 5, 4, 3, 1, 1, 1, 1, 1], k=r.randint(0, 40)))
             + r.choice([".", " ", "\t", ",\n", "; the new york city of"])) for _ in range(n)]
    rows += [("en", "new York city\tof\x0bthe  new york!") for _ in range(60)] + [("en", None), ("de", ""), (None, "   \t"), ("en", "...")]
    rows += [("fr", "seul")] * 40 + [("it", "uno due tre quattro cinque " * 50), ("it", "uno due. " * 40)]
    return rows


@pytest.mark.parametrize("settings", [
    {}, {"heavy": 40, "bucket": 100}, {"bits": (15, 15, 15), "chunk": 300}, {"heavy": 1, "bucket": 7, "chunk": 50}, {"bits": (15, 15, 15), "heavy": 0}])
def test_against_brute_force(spark, settings):
    rows = corpus()
    got = collocations.collocations(documents(spark, rows), **settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows)
    assert len(want) > 40 and sorted(tuple(r) for r in got.collect()) == want


def test_first_ones_and_ties(spark):
    rows = corpus(1)
    got = collocations.collocations(documents(spark, rows), top=7, least=5)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5, 7)


def test_nothing(spark):
    assert collocations.collocations(documents(spark, corpus()).limit(0)).count() == 0
    assert collocations.collocations(documents(spark, [("en", None), (None, "a b"), ("en", "  ")])).count() == 0


@pytest.mark.parametrize("least", [1, 3, 30])
def test_multikey_sort(least):
    r = np.random.default_rng(least)
    rows = r.integers(0, 4, size=(500, 4))
    cut = r.integers(1, 5, size=500)
    rows[np.arange(4) >= cut[:, None]] = -1
    weights = r.integers(1, 5, size=500)
    want = collections.Counter()
    for row, w in zip(rows.tolist(), weights.tolist()):
        for k in range(1, 5):
            if row[k - 1] >= 0:
                want[tuple(row[:k])] += w
    got = [(tuple(rows[i, :d].tolist()), size) for i, d, size in collocations.multikey(np.ascontiguousarray(rows.T), weights, least)]
    assert len(got) == len(dict(got)) and dict(got) == {w: n for w, n in want.items() if n >= least}


@pytest.mark.parametrize("size", [1, 5, 64, 10_000])
def test_chunks_end_where_pieces_end(size):
    r = random.Random(size)
    texts = [("".join(r.choices("ab C.,\t", k=r.randint(0, 90)))).encode() for _ in range(30)]
    lower = [re.split(rb"[.,]", t.replace(b"\t", b" ").lower()) for t in texts]
    for langs in (1, 3, 30):
        named = [(str(i % langs), t) for i, t in enumerate(texts)]
        got = {}
        for lang, c in collocations.chunks(iter(named), size):
            got.setdefault(lang, []).extend(p.split() for p in c.split(b"\n") if p.split())
        for lang in {lang for lang, _ in named}:
            assert got.get(lang, []) == [p.split() for (name, _), t in zip(named, lower) if name == lang for p in t if p.split()]


def test_scores_beyond_64_bits(spark):
    big = 6_000_000_000_000_000
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1)], "lang string, phrase string, n long")
    counts = spark.createDataFrame([("en", "a b", big - 1)], "lang string, phrase string, n long")
    row = collocations.scored(words, counts).first()
    assert (row["a"], row["l"], row["r"], row["score"]) == (big - 1, big, big + 1, 2000000 * (big - 1) // (2 * big + 1))
