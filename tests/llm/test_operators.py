"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and odd columns."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from specloom.llm import bpe, chat, embeddings, exact_dedup, licenses, near_copies, packing, pii, simhash, suffixes, toxicity
from specloom.llm.common import WordCache, tokenizer_file
from specloom.llm.graph import components

SCHEMA = "doc_id long, text string, digest string, row string, kept_id long, spans string, toxicity double"


def documents(spark, rows):
    """``(doc_id, text)`` with columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "x", "y", 7, "z", 0.5) for d, t in rows], SCHEMA)


def words(seed, n, size=40):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 6))) for _ in range(n)) if n else ""


@pytest.fixture(scope="module")
def mixed():
    base = words(1, 300)
    near = base.replace(base.split()[150], "zzz", 1)
    return [(1, base), (2, near), (3, base), (4, None), (5, ""), (6, "   "), (7, "é ü 日本 ß"), (8, words(2, 12_000)), (9, "a"), (10, "a"),
            (11, words(3, 40)), (None, "no id"), (12, words(3, 40) + "."), (13, "word " * 500), (14, words(1, 299))]


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# components ---------------------------------------------------------------------------------------------------------

def union_find(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("links", [
    [], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(i, 100) for i in range(30)],
    [(random.Random(5).randrange(60), j) for j in range(60)]])
def test_components(spark, links):
    got = components(spark.createDataFrame([*links, (None, 3), (7, 7)], "src long, dst long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {
        a: b for a, b in union_find([(a, b) for a, b in links if a != b]).items() if a != b}


def test_rounds_of_few_links_take_few_tasks(spark):
    """With 97 shuffle partitions a round over 40 links still ends in one task per core at most."""
    names = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        got = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long"))
        assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism < 97
        assert {r["node"]: r["component"] for r in got.collect()} == {i: 0 for i in range(1, 41)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_word_cache_looks_up_a_held_word_once():
    class Word(str):
        hashed = 0

        def __hash__(self):
            Word.hashed += 1
            return super().__hash__()

    filled = []
    cache = WordCache(lambda ws: filled.extend(ws) or [w.upper() for w in ws], half_size=3)
    for groups in ([["a", "b"], ["a"]], [["c", "d"], [], ["a", "c"]], [["e", "a"]], [["b", "b", "e"]]):
        assert cache.lists(groups) == [[w.upper() for w in g] for g in groups]
    assert filled.count("a") == 1 and cache.held(["e", "zz"]) == {"e": "E"}
    assert cache.lists([[Word("e")] * 5]) == [["E"] * 5] and Word.hashed == 5


def test_word_cache_keeps_what_it_promises():
    cache = WordCache(lambda ws: [w.upper() for w in ws], half_size=3)
    for group in (["a", "b"], ["c", "d", "a"], ["e", "a"], ["b"]):
        cache.ensure([group])
        assert list(cache.take(group)) == [w.upper() for w in group]


# 1: embeddings --------------------------------------------------------------------------------------------------------

def vectors(seed=0, n=220, groups=12, size=9):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, 32))
    near = [c + 0.12 * r.normal(size=32) for c in centres for _ in range(size)]
    return [(i, [float(x) for x in v]) for i, v in enumerate([*r.normal(size=(n, 32)), *near])]


def test_embeddings_against_brute_force(spark):
    rows = vectors()
    rows += [(1000, rows[-1][1]), (1001, rows[-1][1]), (1002, None), (1003, [0.0] * 32), (1004, [float("nan")] * 32), (1005, [None] * 32),
             (1006, [float("inf")] * 32), (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (1009, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, bucket string, node int")
    got = {r["vec_id"]: r for r in rows_of(embeddings.near_vectors(df, block=8))}
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(good, 2)
             if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= embeddings.COSINE]
    n = {i: 0 for i, _ in rows}
    for i, j in links:
        n[i] += 1
        n[j] += 1
    assert len(links) > 150 and set(got) == set(n)
    assert all(got[i]["n_links"] <= n[i] for i in n)  # nothing below the threshold
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(n.values())  # recall
    named = union_find(links)
    assert sum(got[i]["component_id"] == named.get(i, i) for i in n) >= 0.95 * len(n)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_embeddings_blocks_give_the_same(spark):
    df = spark.createDataFrame(vectors(1), "vec_id long, embedding array<double>")
    a, b = (sorted(map(str, rows_of(embeddings.near_vectors(df, block=k)))) for k in (4, 4096))
    assert a == b
    assert embeddings.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("dimension,functions", [(3, 5), (16, 5), (64, 3), (64, 4), (64, 5), (256, 3), (256, 4), (256, 5)])
def test_embedding_recall_with_many_functions(dimension, functions):
    """Pairs at the threshold itself, other ones than those that the number of tables is derived from."""
    draw = np.random.default_rng(5)
    a = embeddings.unit(list(draw.normal(size=(1000, dimension))))
    side = draw.normal(size=a.shape)
    side = embeddings.unit(list(side - (side * a).sum(axis=1, keepdims=True) * a))
    b = embeddings.COSINE * a + np.sqrt(1 - embeddings.COSINE ** 2) * side
    hasher = embeddings.CrossPolytope(dimension, functions, embeddings.tables_for(dimension, functions))
    (ha, pa), (hb, pb) = hasher.keys(a), hasher.keys(b)
    met = (ha == hb) | (pa == hb[:, :, None]).any(axis=2) | (pb == ha[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.99


def test_embeddings_with_the_functions_of_a_large_table(spark):
    """Four functions, as for ten million vectors: the links of all pairs, between two vectors and in crowds of them."""
    draw = np.random.default_rng(8)
    base = embeddings.unit(list(draw.normal(size=(150, 64))))
    side = draw.normal(size=base.shape)
    side = embeddings.unit(list(side - (side * base).sum(axis=1, keepdims=True) * base))
    close = np.linspace(0.951, 0.999, len(base))[:, None]
    crowd = base[0] + draw.normal(size=(60, 64)) * 0.02
    x = np.concatenate([base, close * base + np.sqrt(1 - close ** 2) * side, crowd])
    got = {r["vec_id"]: r["n_links"] for r in rows_of(embeddings.near_vectors(
        spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"), functions=4))}
    u = embeddings.unit(x.tolist())
    want = (u @ u.T >= embeddings.COSINE).sum(axis=1) - 1
    assert all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.995 * want.sum() and want.sum() > 3000


# 2: exact copies --------------------------------------------------------------------------------------------------------

def test_cuckoo_index():
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(5000)]
    index = exact_dedup.CuckooIndex(buckets=4)
    for i, k in enumerate(keys):
        assert index.find(k) == -1
        index.insert(k, i)
    assert index.grown > 5 and len(index) == 5000
    assert all(index.values[index.find(k)] == i for i, k in enumerate(keys))
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert [index.find(k) >= 0 for k in keys[:6]] == [False, True] * 3 and len(index) == 2500
    for i, k in enumerate(keys[::2]):
        index.insert(k, -i)
    assert dict(index.live()) == {**dict(zip(keys[1::2], range(1, 5000, 2))), **{k: -i for i, k in enumerate(keys[::2])}}
    # a filter hit of another digest is not taken for it: there are only 2^16 marks
    assert not any(index.find(hashlib.sha256(b"no%d" % i).hexdigest()) >= 0 for i in range(20_000))


def test_drop_copies_looks_at_id_and_text(spark):
    rows = [(5, "A"), (5, "B"), (9, "B"), (7, None), (8, ""), (None, "A"), (None, "C"), (None, "C"), (9, "B"), (4, "D")]
    got = exact_dedup.drop_copies(documents(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(
        [(5, "A"), (9, "B"), (9, "B"), (8, ""), (None, "C"), (None, "C"), (4, "D")], key=str)
    assert exact_dedup.drop_copies(documents(spark, [])).count() == 0


def test_exact_groups(spark, mixed):
    got = rows_of(exact_dedup.exact_groups(documents(spark, mixed)))
    groups = {}
    for d, t in mixed:
        groups.setdefault(t or "", []).append(d)
    assert len(got) == len(mixed)
    for r in got:
        text = next(t or "" for d, t in mixed if d == r["doc_id"])
        ids = [d for d in groups[text] if d is not None]
        assert r["keep_id"] == (max(ids) if ids else None) and r["group_size"] == len(groups[text])
        assert r["kept"] == (r["doc_id"] == r["keep_id"]) and r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    kept = exact_dedup.drop_copies(documents(spark, mixed))
    assert kept.columns == documents(spark, []).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["kept"])
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0


def test_deleted_digests_are_not_live(spark):
    rows = spark.createDataFrame([("%064x" % (i % 50), i) for i in range(300)], "digest string, keep_id long")
    gone = spark.createDataFrame([("%064x" % i,) for i in (3, 4, 99)], "digest string")
    got = {int(r["digest"], 16): (r["keep_id"], r["group_size"]) for r in exact_dedup.live_digests(rows, gone).collect()}
    assert got == {i: (250 + i, 6) for i in range(50) if i not in (3, 4)}


# 3: licenses ------------------------------------------------------------------------------------------------------------

def test_license_scan(spark):
    filler = words(4, 30)
    rows = [(1, f"{filler}\nReleased under the MIT License.\n{filler}"), (2, filler), (3, None), (4, ""),
            (5, f"é Licensed under the Apache License, Version 2.0. {filler} Licensed under CC BY-NC 4.0"),
            (6, "Permission is hereby granted, free of any charge, to any person getting a copy of this software and associated "
                "documentation files (the Software), to deal in the Software without restriction"), (None, "Released under the MIT License")]
    got = rows_of(licenses.scan(documents(spark, rows)))
    texts = dict(rows)
    found = sorted((str(r["doc_id"]), r["license"], texts[r["doc_id"]][r["start"]:r["end"]]) for r in got)
    assert found[:3] == [("1", "MIT", "Released under the MIT License"), ("5", "Apache-2.0", "Licensed under the Apache License, Version 2.0"),
                         ("5", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0")]
    assert [f[:2] for f in found[3:]] == [("6", "MIT-grant"), ("None", "MIT")]
    assert 0.8 <= next(r["coverage"] for r in got if r["doc_id"] == 6) < 1
    assert licenses.scan(documents(spark, [])).count() == 0


def test_banded_alignment_is_the_longest_common_subsequence():
    r = random.Random(6)
    for _ in range(200):
        template = [r.choice("abcd") for _ in range(r.randint(3, 9))]
        text = [r.choice("abcd") for _ in range(r.randint(0, 9))]
        lcs = [[0] * (len(text) + 1) for _ in range(len(template) + 1)]
        for i, j in itertools.product(range(len(template)), range(len(text))):
            lcs[i + 1][j + 1] = lcs[i][j] + 1 if template[i] == text[j] else max(lcs[i][j + 1], lcs[i + 1][j])
        assert licenses.align(template, text, 0, band=20)[0] == lcs[-1][-1]


def test_licenses_are_told_apart(spark):
    given = ["Released under the BSD License", "Released under an MIT License", "Licensed under the GNU General Public License, version 3",
             "Licensed under the GNU Affero General Public License, version 3", "licensed under CC BY 4.0", "licensed under CC BY-SA 4.0",
             "This work is licensed under the GNU General Public License, version 2", "Licensed under the Apache License, Version 1.1",
             "Released under the Foo License", "mit " * 400, "License " * 3000,
             "Permission is hereby granted, free of charge, to any person now or later obtaining in any way a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction"]
    got = {r["doc_id"]: (r["license"], r["coverage"]) for r in licenses.scan(documents(spark, list(enumerate(given)))).collect()}
    assert got == {0: ("BSD-line", 1.0), 1: ("MIT", 0.8), 3: ("AGPL-3.0", 1.0), 4: ("CC-BY-4.0", 1.0), 5: ("CC-BY-SA-4.0", 1.0),
                   6: ("GPL-2.0-line", 1.0), 11: ("MIT-grant", 1.0)}
    index = licenses.LicenseIndex(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        assert [m[:2] for m in licenses.find(text, index)] == [(name, 1.0)], name


def test_no_license_match_is_lost():
    """Every template, changed as far as the coverage and the band allow, against an alignment with the whole text."""
    r, index = random.Random(3), licenses.LicenseIndex(licenses.TEMPLATES)
    for name, t in index.templates.items():
        for _ in range(40):
            text = list(t.words)
            free = [i for i, w in enumerate(text) if w not in t.telling]
            for i in r.sample(free, min(len(free), r.randint(0, t.missing))):
                text[i] = r.choice([None, "x%d" % i])
            text = [w for w in text if w]
            for _ in range(r.randint(0, t.band - t.missing) if t.band > t.missing else 0):
                text.insert(r.randint(1, len(text) - 1), "y")
            words_ = ["z"] * r.randint(0, 40) + text + ["z"] * r.randint(0, 40)
            whole = licenses.align(t.words, words_, 0, len(words_) + len(t.words))[0]
            assert whole >= t.wanted
            found = licenses.find(" ".join(words_), index)
            assert any(n == name or round(c * len(index.templates[n].words)) >= whole for n, c, _, _ in found), (name, words_)


# 4: chat ------------------------------------------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    r = random.Random(7)
    alphabet = ["<", "|", "\\", " ", "\n", "é", "日", "im_end", "|>", "a", "😀", "́", "<|im_end|>", "<|endoftext|>"]
    rows = [(1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
            (2, 1, "assistant", None), (2, 0, None, "x"), (3, None, "assistant", " lead\n\n"), (3, 2, "assistant", "word " * 3000),
            (None, 0, "assistant", "no id")]
    rows += [(10 + i // 4, i % 4, r.choice(["assistant", "user", "<|im_sep|>"]), "".join(r.choices(alphabet, k=r.randint(0, 14)))) for i in range(120)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "conv_id long, turn int, role string, text string, formatted string")
    formatted = chat.format_chats(df)
    got = {x["conv_id"]: x for x in rows_of(chat.digests(formatted))}
    assert set(got) == {x[0] for x in rows}
    for conv, x in got.items():
        turns = [(role or "", text or "") for c, t, role, text in sorted(
            (q for q in rows if q[0] == conv), key=lambda q: (q[1] is not None, q[1] or 0, q[2] or "", q[3] or ""))]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert x["n_turns"] == len(turns)
        assert x["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (x["loss_chars"], x["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert all(len(x["ids"]) == len(x["loss_mask"]) for x in formatted.collect())
    assert chat.format_chats(df.limit(0)).count() == 0


# 5: simhash ---------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, mixed):
    rows = mixed + [(20, "É A B c"), (21, "É a b C"), (22, "x\x0by\x1cz"), (23, "0")]
    got = {r["doc_id"]: r for r in rows_of(simhash.near_groups(documents(spark, rows)))}
    marks = {d: plain_fingerprint(t) for d, t in rows}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: "%016x" % m for d, m in marks.items()}
    named = union_find([(a, b) for a, b in itertools.combinations([d for d in marks if d is not None], 2) if (marks[a] ^ marks[b]).bit_count() <= 2])
    assert {d: r["component_id"] for d, r in got.items()} == {d: named.get(d, d) for d in marks}
    kept = simhash.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns and kept.count() < len(rows)
    assert simhash.near_groups(documents(spark, [])).count() == 0


@pytest.mark.parametrize("split, distance", [(4, 2), (100_000, 2), (4, 6), (100_000, 5)])
def test_gray_index_finds_all_links(spark, split, distance):
    r = random.Random(8)
    codes = {r.getrandbits(64) for _ in range(300)}
    for code in list(codes)[:60]:  # chains and crowded nodes
        for _ in range(8):
            code ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
            codes.add(code)
    codes = sorted(codes)
    links = [(i, j) for i, j in itertools.combinations(range(len(codes)), 2) if (codes[i] ^ codes[j]).bit_count() <= distance]
    nodes = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(codes)], "fp long, node_id long")
    got = [(x["src"], x["dst"]) for x in simhash.similar_links(nodes, distance, split).collect()]
    assert split == 4 or len(got) < 2 * 28 * len(codes)  # a forest per node, not all pairs
    assert union_find(got) == union_find(links)


def plain_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} or ({" ".join(w)} if w else set())


@pytest.fixture(scope="module")
def copies(mixed):
    """Texts with one to a fifth of their words changed, a crowd around one text, short and empty ones."""
    r, rows = random.Random(5), list(mixed) + [(30, "x y z"), (31, "X  y z"), (32, "x y"), (33, "\n")]
    for base in range(40):
        source = words(100 + base, r.randint(20, 200)).split()
        for copy in range(25 if base == 0 else 3):
            changed = list(source)
            for _ in range(r.randint(0, max(len(source) // 40, 1))):
                changed[r.randrange(len(changed))] = "w%d" % r.randrange(10**6)
            rows.append((1000 + 50 * base + copy, " ".join(changed)))
    return rows


def plain_near(rows):
    sets = {d: plain_shingles(t) for d, t in rows if d is not None}
    return union_find([(a, b) for a, b in itertools.combinations(sorted(sets), 2)
                       if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])])


def test_no_near_copy_stays(spark, copies):
    named = plain_near(copies)
    kept = {r["doc_id"] for r in rows_of(simhash.keep_one(documents(spark, copies)))}
    assert not [d for d in kept if named.get(d, d) != d] and None in kept
    links = [(x["src"], x["dst"]) for x in near_copies.near_links(documents(spark, copies)).collect()]
    assert union_find(links) == {d: n for d, n in named.items()}
    assert near_copies.near_links(documents(spark, [])).count() == 0


def test_only_near_copies_go(spark, copies):
    r = random.Random(6)
    for i in range(60):  # three-word fingerprints within six bits, similarity below 0.8
        w = words(500 + i, r.randint(12, 60)).split()
        w[len(w) // 2] = "other"
        copies = copies + [(5000 + 2 * i, words(500 + i, len(w))), (5001 + 2 * i, " ".join(w))]
    named = plain_near(copies)
    kept = {r["doc_id"] for r in rows_of(simhash.keep_one(documents(spark, copies)))}
    assert kept == {d for d, _ in copies if d is None or named.get(d, d) == d}


def test_near_copies_meet_in_the_fingerprint_index(spark, copies, monkeypatch):
    """The groups of the index are compared: without any band, near copies it links go, and nothing else does."""
    marks = {d: simhash.fingerprint(t or "", 5) for d, t in copies if d is not None and plain_shingles(t)}
    named = union_find([(a, b) for a, b in itertools.combinations(sorted(marks), 2) if (marks[a] ^ marks[b]).bit_count() <= simhash.NEAR_DISTANCE])
    groups: dict = {}
    for r in simhash.near_buckets(documents(spark, [x for x in copies if x[0] in marks])).collect():
        groups.setdefault(r["key"], set()).add(r["node_id"])
    assert sorted(map(sorted, groups.values())) == sorted(sorted(d for d in named if named[d] == c) for c in set(named.values()))
    seen = []
    monkeypatch.setattr(simhash, "near_links", lambda docs, buckets: seen.append(buckets.count()) or near_copies.near_links(docs, buckets=buckets))
    assert simhash.keep_one(documents(spark, copies)).count() and seen[0] > 50


def test_near_blocks_of_any_size(spark):
    """Crowds whose members are partly near copies: parts and blocks of two members give the links that whole buckets give."""
    r, rows = random.Random(8), []
    for crowd in range(4):
        source = words(900 + crowd, 120).split()
        for copy in range(14):
            changed = list(source)
            for at in r.sample(range(120), r.choice([0, 1, 2, 3, 4, 6])):
                changed[at] = "v%d" % r.randrange(10**6)
            rows.append((100 * crowd + copy, " ".join(changed)))
    rows += [(5, words(7, 30)), (5, words(8, 30)), (77, words(8, 30))]  # two texts share an id
    sets = [(d, plain_shingles(t)) for d, t in rows]
    want = union_find([(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if a != b and 5 * len(x & y) >= 4 * len(x | y)])
    assert 4 < len(set(want.values())) < len(want)
    for star, block in ((2, 2), (2048, 256)):
        links = near_copies.near_links(documents(spark, rows), star=star, block=block).collect()
        assert union_find([(x["src"], x["dst"]) for x in links]) == want


def test_links_across_blocks():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 62, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(300) < 0.93], r.integers(0, 1 << 62, 8, dtype=np.uint64)])) for _ in range(30)]
    group, side = np.array([i % 3 if i < 12 else 10 + i for i in range(30)]), np.arange(30) % 2
    near = {(i, j): near_copies.similar(sets[i], sets[j], 0.8) for i, j in itertools.combinations(range(30), 2)}
    assert near == {(i, j): len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) for i, j in near}
    assert 0 < sum(near.values()) < len(near)
    own = [(int(np.flatnonzero(group == g)[0]), int(i)) for g in range(3) for i in np.flatnonzero(group == g)[1:]]
    for sides in (None, side):
        links = near_copies.bucket_links(np.arange(30), sets, 0.8, group, sides)
        assert all(near[i, j] and (sides is None or side[i] != side[j]) for i, j in links)
        whole = [p for p, yes in near.items() if yes and (sides is None or side[p[0]] != side[p[1]])]
        assert union_find(own + links) == union_find(own + whole)


def test_crowd_of_near_copies(spark):
    source = words(77, 80).split()
    texts = [" ".join(source[:i % 80] + ["c%d" % i] + source[i % 80 + 1:]) for i in range(4000)]
    links = near_copies.near_links(documents(spark, list(enumerate(texts))), star=64, block=16)
    found = union_find([(x["src"], x["dst"]) for x in links.collect()])
    assert set(found) == set(range(4000)) and set(found.values()) == {0}


def test_gray_index_prunes_whole_groups():
    codes = np.array([random.Random(i).getrandbits(64) for i in range(2000)], dtype=np.uint64)
    index = simhash.GrayIndex(codes)
    q, hit = index.search(index.codes)
    assert (q == hit).sum() == len(codes)
    order = simhash.gray_rank(index.codes)
    assert (order[1:] >= order[:-1]).all()


# 6: PII -----------------------------------------------------------------------------------------------------------------

FIND = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(FIND.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(
                    (int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))) for i, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_pii_base_spans(spark):
    r = random.Random(9)
    pieces = ["a@b.c", "@", ".", "x_y%z@mail.example.com", "1.2.3.4", "255.255.0.1", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+",
              "+49 (30) 1234-5678", "é", "日本", " ", "-", "7", "00000000000000000000255", "a", "\n", "😀", "4041894974608795"]
    texts = [None, "", "a@b.c@d.e.f", "a@b.c_d@e.f", "+1" + "2" * 14, "1" * 6000, "a" * 30_000, "a@b" + ".c" * 8000, "1.1.1.1.1.1.1.1.1",
             "é😀 a@b.co +49 (30) 1234-5678 4111 1111 1111 1111 1.2.3.4", *("".join(r.choices(pieces, k=r.randint(1, 12))) for _ in range(400))]
    got = {x["doc_id"]: x for x in rows_of(pii.find(documents(spark, list(enumerate(texts)))))}
    for i, text in enumerate(texts):
        want = plain_spans(text)
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("term")] == want, text
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i]["n_" + k] for k in FIND] == [sum(s.startswith(k + ":") for s in want) for k in FIND]
    assert pii.find(documents(spark, [])).count() == 0


def plain_terms(rows, context=pii.CONTEXT):
    """Disclosing (entity, term) pairs by counting every row."""
    import math
    near, everywhere, entities = {}, {}, {}
    for d, text in rows:
        text = text or ""
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in plain_spans(text))]
        for w in {m[0].lower() for m in re.finditer(r"[^\W\d_]{3,}", text)}:
            everywhere[w] = everywhere.get(w, 0) + 1
        pairs = set()
        for s, e, k in spans:
            entity = k + ":" + (text[s:e].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", text[s:e]))
            pairs.add((entity, None))
            for m in re.finditer(r"[^\W\d_]{3,}", text):
                inside = (m.start() >= s - context and m.end() <= s) or (m.start() >= e and m.end() <= e + context)
                if inside and not any(m.start() < b and a < m.end() for a, b, _ in spans):
                    pairs.add((entity, m[0].lower()))
        for entity, term in pairs:
            if term is None:
                entities[entity] = entities.get(entity, 0) + 1
            else:
                near.setdefault((entity, term), []).append(text)
    out, n = {}, len(rows)
    for (entity, term), texts in near.items():
        if len(set(texts)) >= pii.SUPPORT and entities[entity] < n:
            share = math.log2(n * len(texts) / (entities[entity] * everywhere[term])) / math.log2(n / entities[entity])
            if share >= pii.THRESHOLD:
                out[entity, term] = share
    return out


def test_pii_terms_and_sanitising(spark):
    rows = [(i, f"text {i} Anna Berg writes from anna@berg.example on the road {words(i, 5)}") for i in range(6)]
    rows += [(10 + i, f"{words(50 + i, 20)} the road and the text of 10.0.0.{i} " + words(90 + i, 6)) for i in range(20)]
    rows += [(40, None), (41, ""), (42, "anna nothing here"), (43, rows[0][1]), (None, rows[1][1])]
    want = plain_terms(rows)
    assert {t for _, t in want} >= {"berg", "writes"} and ("email:anna@berg.example", "the") not in want
    docs = documents(spark, rows)
    base = pii.find_base(docs)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosing(base, docs).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    found = {r["doc_id"]: r for r in rows_of(pii.find(docs))}
    assert found[0]["n_term"] >= 2 and found[42]["n_term"] == 0 and found[43]["spans"] == found[0]["spans"]
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert "[EMAIL]" in text[0] and "Berg" not in text[0] and "@" not in text[0] and "the road" in text[0]
    assert text[42] == "anna nothing here" and text[40] is None and text[41] == ""
    assert "[IP]" in text[10]


def test_pii_terms_stand_anywhere_in_the_text(spark):
    """Terms far from the entity disclose it as well, and each of their places is sanitised; words that run into a span are none."""
    rows = [(i, f"Zacharias {words(300 + i, 60)} é😀 mail z@mail.example\n {words(400 + i, 60)} ZACHARIAS and abcßz@mail.example") for i in range(4)]
    rows += [(10 + i, words(600 + i, 30)) for i in range(30)]
    want = plain_terms(rows)
    assert ("email:z@mail.example", "zacharias") in want
    docs = documents(spark, rows)
    assert {(r["entity"], r["term"]) for r in pii.disclosing(pii.find_base(docs), docs).collect()} == set(want)
    found = {r["doc_id"]: r["spans"].split(",") for r in rows_of(pii.find(docs))}
    for i, text in rows[:4]:
        at = [m.span() for m in re.finditer("(?i)zacharias", text)]
        assert len(at) == 2 and all(f"term:{s}:{e}" in found[i] for s, e in at)
    assert not any("zacharias" in r["text"].lower() for r in pii.sanitise(docs).collect())


def test_pii_plan_is_native(spark):
    plan = pii.sanitise(documents(spark, [(1, "a@b.c")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 7: BPE -------------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference_bpe():
    import public_tokenizers
    import tiktoken
    ranks = bpe.load_ranks(tokenizer_file(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, mixed, reference_bpe):
    odd = ["  a  b   c\n\n d ", "x" * 3000, "日本語 テスト　x  é́", "\x1c a\x1fb c", "aaaa" * 200 + " b", " lead", "trail ",
           "don't we'll", "it's  ok \t", " x  y　z", "<|endoftext|> <|im_start|>", "0123456789 " * 5, "\x00\x01"]
    rows = mixed + [(100 + i, t) for i, t in enumerate(odd)]
    docs = documents(spark, rows)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(docs).collect()}
    assert ids == {d: reference_bpe.encode_ordinary(t or "") for d, t in rows}
    back = {r["doc_id"]: bytes(r["text"]) for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == {d: (t or "").encode() for d, t in rows}
    got = {r["doc_id"]: r for r in rows_of(bpe.digests(docs))}
    for d, t in rows:
        want = reference_bpe.encode_ordinary(t or "")
        assert got[d]["n_tokens"] == len(want) and got[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(documents(spark, [])).count() == 0


def test_spans_of_texts_with_line_breaks_are_encoded_apart_and_once(reference_bpe):
    coder, asked = bpe.RecursiveBpe(tokenizer_file(bpe.RANKS), half_size=2), []
    encode_spans = coder.first.fill
    coder.first.fill = lambda spans: asked.extend(spans) or encode_spans(spans)
    coder.encode_spans = lambda spans: asked.extend(spans) or encode_spans(spans)  # behind a space
    texts = ["", " ", "one\ntwo words ,  and \n\n\ttwo words", "two words two\xa0 words", "\u3000 x\x1c y \x85z", " lead trail ", "one two"]
    for _ in range(2):
        assert coder.encode(texts) == [np.array(reference_bpe.encode_ordinary(t), dtype="<i4").tobytes() for t in texts]
        back = coder.decode(coder.encode(texts[::-1]) + [b""])
        assert back == [t.encode() for t in texts[::-1]] + [b""]
    assert coder.encode([]) == coder.decode([]) == []
    asked.clear()
    coder.encode(["new1\nnew2 new3 new4 new3  new4"] * 2)
    assert sorted(asked) == ["  new4", " new3", " new4", "new1\nnew2"]


def test_recursive_contraction_and_long_words_agree(reference_bpe):
    coder, r = bpe.RecursiveBpe(tokenizer_file(bpe.RANKS)), random.Random(10)
    ws = ["".join(r.choices("etaoin shr", k=r.randint(1, 60))).replace(" ", "") or "a" for _ in range(300)]
    assert coder.encode_words(ws) == [coder._long_word(w.encode()) if w.encode() not in coder.ranks else coder.ranks[w.encode()].to_bytes(4, "little") for w in ws]
    with pytest.raises(ValueError):
        coder.decode([np.array([10 ** 6], dtype="<i4").tobytes()])
    parts = [reference_bpe.encode_ordinary(words(i, 50)) for i in range(5)] + [[]]
    assert coder.decode([np.array(p, dtype="<i4").tobytes() for p in parts]) == [reference_bpe.decode_bytes(p) for p in parts]


# 8: toxicity ----------------------------------------------------------------------------------------------------------------

def test_toxicity_scores_as_fitted():
    """The score is the noisy-or over all sentences with words, those without a weighted word too."""
    texts = [". ".join(words(900 * i + k, 6) for k in range(1 + i % 7)) + (" you scumbag! And more" if i % 3 == 0 else ".") for i in range(300)]
    weights, bias = toxicity.fit(texts, np.array([i % 3 == 0 for i in range(300)]))
    scorer = toxicity.Scorer(weights, bias)
    for text in [*texts[:60], "", " \n.! ", "one", "a. b. c\n\nd", "scumbag. scumbag scumbag. x", "z. " * 300, "é. scumbag"]:
        clean = 1.0
        for sentence in toxicity.sentences(text):
            value = 0.0
            for w in sentence:
                own = sum(weights.get(f, 0.0) for f in toxicity.features(w))
                value += own if abs(own) >= toxicity.LEAST_WEIGHT else 0.0
            clean *= 1 - 1 / (1 + np.exp(-(bias + value)))
        assert abs(scorer.score(text) - (1 - clean)) < 1e-9
    assert scorer.score("z. " * 300) > scorer.score("z.")


def test_toxicity_fits_one_text_per_id(spark):
    rows = [(i, ("bad scumbag " if i % 2 else "fine ") + words(i, 5)) for i in range(60)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    once = toxicity.train(documents(spark, rows), marks)
    again = toxicity.train(documents(spark, rows + [(1, "zzz " + rows[1][1])] * 50 + [(3, "zz " * 200_000)]), marks)
    assert (once.weights, once.bias) == (again.weights, again.bias) and once.weights


def test_toxicity_learns_and_locates(spark):
    r = random.Random(11)
    rows, labels = [], []
    for i in range(700):
        sentences = [words(1000 * i + k, 8) for k in range(r.randint(2, 9))]
        toxic = i % 4 == 0
        if toxic:
            sentences[r.randrange(len(sentences))] += " " + r.choice(["scumbag", "loser", "idiotic"]) + " " + words(i, 2)
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "x " * 20_000), (None, "fine words here")]
    labels += [(5000, 1, 1), (None, 1, 1), (3, 1, None)]
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in rows_of(toxicity.predictions(docs, marks))}
    assert len(got) == len(rows)
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in range(700) if got[i]["held_out"]] == held
    assert sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in got.values())
    assert got[1000]["score"] == got[1001]["score"] and got[1000]["predicted"] == 0
    texts = dict(rows)
    located = [texts[i][s["start"]:s["end"]] for i in held if i % 4 == 0 for s in got[i]["toxic_spans"]]
    assert len(located) > 10 and sum(bool(re.search("scumbag|loser|idiotic", x)) for x in located) >= 0.9 * len(located)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert {x["doc_id"] for x in kept.collect()} == {d for d, x in got.items() if not x["predicted"]}
    assert toxicity.predictions(docs.limit(0), marks).count() == 0
    assert toxicity.predictions(docs, marks.limit(0)).where("predicted = 1").count() == 0


# 9: packing -----------------------------------------------------------------------------------------------------------------

def test_pieces_fill_their_slots():
    for n in range(0, 9000, 7):
        parts = packing.pieces(n)
        assert sum(parts) == n and all(0 < p <= packing.CAPACITY for p in parts)
        assert sum(packing.CAPACITY // (packing.CAPACITY // p) - p for p in parts) <= 8


def test_packing(spark, mixed):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = mixed + [(100 + i, words(200 + i, 10 + 37 * i % 700)) for i in range(60)] + [(200, "Ä\x1cb c\x85d e　f <|endoftext|> Ⅷ ﬁ")]
    got = rows_of(packing.pack(documents(spark, rows)))
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            part = ids[d][r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids[d]) and r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= total / packing.CAPACITY * 1.05 + 2
    assert packing.pack(documents(spark, [])).count() == 0


# 10: suffixes ---------------------------------------------------------------------------------------------------------------

def plain_repeats(rows, length):
    """Removed byte positions by row index: every string of ``length`` bytes that started before."""
    seen, out = set(), []
    for text in rows:
        removed = set()
        for i in range(len(text) - length + 1):
            s = text[i:i + length]
            if s in seen:
                removed.update(range(i, i + length))
            seen.add(s)
        out.append(removed)
    return out


@pytest.mark.parametrize("crowded", [1, suffixes.CROWDED])
def test_repeated_bytes(spark, mixed, crowded):
    shared = [words(300 + i, 40) for i in range(4)]
    r = random.Random(12)
    rows = mixed[:-4] + [(20 + i, " ".join([words(400 + i, r.randint(0, 30)), *r.sample(shared, r.randint(0, 3)), words(500 + i, r.randint(0, 30))]))
                         for i in range(30)]
    rows += [(90, "ab" * 400), (91, "é" * 120 + shared[0][20:160]), (92, "x" * 99), (93, "x" * 99), (94, "x" * 100), (95, "x" * 100)]
    rows = [(d, t) for d, t in rows if d is not None]
    r.shuffle(rows)
    got = {x["doc_id"]: x for x in rows_of(suffixes.repeated_bytes(documents(spark, rows), crowded=crowded))}
    ordered = sorted(rows)
    for (d, t), removed in zip(ordered, plain_repeats([(t or "").encode() for _, t in ordered], 100)):
        text = (t or "").encode()
        kept = bytes(b for i, b in enumerate(text) if i not in removed)
        assert (got[d]["n_bytes"], got[d]["n_removed"]) == (len(text), len(removed)), d
        assert got[d]["n_spans"] == sum(i - 1 not in removed for i in removed) and got[d]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffixes.repeated_bytes(documents(spark, [])).count() == 0


def test_copies_of_a_crowded_string_do_not_travel(spark):
    import pyarrow as pa
    shared, r = words(90, 60)[:220], random.Random(11)
    rows = [(i, words(2000 + i, 12) + shared + words(4000 + i, 12)) for i in range(300)]
    places = [(i, t.encode(), t.index(shared)) for i, t in rows]
    for order in (places, r.sample(places, len(places))):
        batches = [pa.RecordBatch.from_pylist([{"doc": d, "text": t, "asked": [{"least": 1, "start": at, "end": at + 220, "apart": True}]}
                                               for d, t, at in order[k:k + 50]]) for k in range(0, 300, 50)]
        cut = [x for b in suffixes._cut_batches(100)(iter(batches)) for x in b.to_pylist()]
        pieces = [x for x in cut if x["piece"] is not None]
        assert len(pieces) == 121 if order is places else 121 <= len(pieces) <= 121 * 30
        place = {d: at for d, _, at in places}
        covered = [(x["doc"], b) for x in cut if x["piece"] is None for b in range(x["start"], x["end"] - 99)]
        assert len(covered) + len(pieces) == 300 * 121 and len(set(covered)) == len(covered)
        assert all(d > 0 and 0 <= b - place[d] <= 120 for d, b in covered)
    seen = suffixes.Seen(2)
    assert [seen.repeats(s, (p, 0)) for s, p in [(b"a", 5), (b"b", 1), (b"c", 1), (b"a", 3), (b"a", 4), (b"d", 1), (b"a", 6)]] == [
        False, False, False, False, True, False, True]
    got = {x["doc_id"]: x for x in rows_of(suffixes.repeated_bytes(documents(spark, rows), crowded=1))}
    assert [got[d]["n_removed"] for d, _ in rows] == [len(x) for x in plain_repeats([t.encode() for _, t in rows], suffixes.LENGTH)]


def test_repeated_bytes_without_a_key(spark):
    text, other = words(600, 60), words(601, 60)
    rows = [(None, text), (1, text), (1, text), (2, other), (2, text + other)]
    got = sorted((str(x["doc_id"]), x["n_bytes"], x["n_removed"]) for x in rows_of(suffixes.repeated_bytes(documents(spark, rows))))
    n, m = len(text), len(other)
    first = hashlib.sha256(other.encode()).hexdigest() < hashlib.sha256((text + other).encode()).hexdigest()
    assert got == sorted([("None", n, 0), ("1", n, n), ("1", n, n), ("2", m, 0 if first else m), ("2", n + m, n + m if first else n)])


def test_two_stage_order_is_the_suffix_order():
    r = random.Random(13)
    for _ in range(40):
        text = np.array([r.choice([1, 2, 3]) for _ in range(r.randint(1, 200))] + [0], dtype=np.uint8)
        data = text.tobytes()
        assert suffixes.suffix_order(text, len(text)).tolist() == sorted(range(len(data)), key=lambda i: data[i:])
