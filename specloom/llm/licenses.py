"""License scan: winnowed template fingerprints, then banded alignment (operator 3).

Templates are word sequences. An alignment is a match if it holds the wanted share of the template's words (the coverage) and each
word that tells the license from others: those of its own name ("mit", "apache", "2.0") and those that a template lacks whose
text would else do as well ("affero"). Gram length and winnowing window of a template follow from its length, the
coverage and the band of inserted words, such that every match shares a fingerprint; a template with telling words is looked up by
the rarest of them. The fingerprints go into an inverted index, whose size depends on
the templates alone. A document looks up its grams there; each hit proposes a template and a diagonal, around which template and
document words are aligned.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from specloom.llm.common import text_or_empty

COVERAGE = 0.8  # least share of template words
BAND = 4, 0.25  # inserted document words that a match may hold: at least, and as a share of the template's words
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")

# Notices as they are published with the licenses; a table of others can be given instead.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
               "License as published by the Free Software Foundation; either version 2 of the License",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License",
    "BSD-line": "Released under the BSD License",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _hash(words) -> int:
    return xxhash.xxh64_intdigest(" ".join(words))


class Template:
    """A template with what a match of it may lack, hold in between and must hold."""

    def __init__(self, name: str, words: list[str], coverage: float, band: int | None):
        self.name, self.words, self.distinct = name, words, set(words)
        self.wanted = max(math.ceil(coverage * len(words) - 1e-9), 1)
        self.missing = len(words) - self.wanted
        self.band = max(BAND[0], int(BAND[1] * len(words))) if band is None else band
        # words of the license's name; "3.0" is written "3" in most texts
        named = {w for part in words_of(name) for w in (part, part.removesuffix(".0"))}
        self.telling = self.distinct & named
        # matched words lie in at most missing + band + 1 runs, the longest of them has at least this many
        self.run = math.ceil(self.wanted / (self.missing + self.band + 1))
        self.reach = self.band + self.missing  # diagonals of one match differ by no more

    def tell_from(self, other: Template) -> None:
        """Where the other template's text holds enough words of this one, the words it lacks become telling."""
        if sum(w in other.distinct for w in self.words) >= self.wanted:
            self.telling |= self.distinct - other.distinct

    def weights(self) -> list[int]:
        """Weight of each word: a telling one (where it stands first) outweighs all others together."""
        return [1 + (len(self.words) + 1) * (w in self.telling and w not in self.words[:i]) for i, w in enumerate(self.words)]

    def fingerprints(self, frequency: Counter) -> list[tuple[str, int]]:
        """Grams and their places. Any run of ``k + window - 1`` words holds a winnowed gram; the shortest sure run bounds both."""
        words = self.words
        if self.telling:
            rare = min(self.telling, key=lambda w: (frequency[w], -len(w), w))
            return [(rare, words.index(rare))]
        k = min(3, (self.run + 1) // 2 if self.run > 2 else self.run)
        window = self.run - k + 1
        grams = [_hash(words[i:i + k]) for i in range(len(words) - k + 1)]
        picked = {min(range(i, i + window), key=lambda j: (grams[j], -j)) for i in range(len(grams) - window + 1)}
        return [(" ".join(words[i:i + k]), i) for i in sorted(picked)]

    def possible(self, words: list[str], diagonal: int) -> bool:
        """Whether enough of the template's words stand near the diagonal at all."""
        near = words[max(diagonal - self.reach, 0):max(diagonal + len(self.words) + self.reach, 0)]
        return len(self.distinct.intersection(near)) >= len(self.distinct) - self.missing and self.telling <= set(near)


class LicenseIndex:
    """Inverted index of the fingerprints of the templates, by gram length."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, band: int | None = None):
        chosen = {name: w for name, text in templates.items() if len(w := words_of(text or "")) >= 3}
        frequency = Counter(w for words in chosen.values() for w in set(words))
        self.templates = {name: Template(name, words, coverage, band) for name, words in chosen.items()}
        for t in self.templates.values():
            for other in self.templates.values():
                t.tell_from(other)
        self.index: dict[int, dict[str, list]] = {}
        for t in self.templates.values():
            for gram, i in t.fingerprints(frequency):
                self.index.setdefault(gram.count(" ") + 1, defaultdict(list))[gram].append((t.name, i))
        self.vocabulary = {w for grams in self.index.values() for gram in grams for w in gram.split()}

    def candidates(self, words: list[str]) -> dict[str, set[int]]:
        """Diagonals (document position of the template's first word) by template."""
        out = defaultdict(set)
        at = [i for i, w in enumerate(words) if w in self.vocabulary]
        for k, grams in self.index.items():
            for a, b in zip(at, at[k - 1:]):
                if b - a == k - 1:
                    for name, i in grams.get(" ".join(words[a:b + 1]), ()):
                        out[name].add(a - i)
        return out


def align(template: list[str], words: list[str], diagonal: int, band: int, weights: list[int] | None = None) -> tuple[int, int, int]:
    """Greatest weight of template words matched in order within ``band`` of the diagonal: (weight, first word, last word + 1)."""
    low = diagonal - band
    # cell: (matched, -words skipped, first, last); column c of row r is document word low + r + c
    none = (0, 0, -1, -1)
    row = [none] * (2 * band + 1)
    for r, wanted in enumerate(template):
        new = []
        for c in range(2 * band + 1):
            d = low + r + c
            best = row[c + 1] if c < 2 * band else none  # the template word is missing
            if c and (left := new[c - 1])[0] and (skip := (left[0], left[1] - 1, left[2], left[3])) > best:
                best = skip  # a document word is inserted
            if 0 <= d < len(words) and words[d] == wanted:
                m, s, first, _ = row[c]
                hit = (m + (weights[r] if weights else 1), s, d if first < 0 else first, d + 1)
                best = max(best, hit)
            new.append(best)
        row = new
    m, _, first, last = max(row)
    return m, first, last


def find(text: str, index: LicenseIndex) -> list[tuple]:
    """``(license, coverage, start, end)`` in code points; of overlapping matches the one with more matched words stays."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    near = index.candidates(words)
    if not near:
        return []
    # lower() can lengthen a few letters: offsets are then taken on the text word by word
    spans = [m.span() for m in WORD.finditer(lowered if len(lowered) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text))]
    if len(spans) != len(words):
        words = [text[a:b].lower() for a, b in spans]
        near = index.candidates(words)
    found = set()
    for name, diagonals in near.items():
        t = index.templates[name]
        size, weights = len(t.words) + 1, t.weights()
        for d in sorted(diagonals):
            if t.possible(words, d):
                score, s, e = align(t.words, words, d, t.reach, weights)
                m = score % size
                if m >= t.wanted and score // size == len(t.telling):
                    found.add((m, name, m / len(t.words), spans[s][0], spans[e - 1][1]))
    kept: list = []
    for m, name, share, s, e in sorted(found, key=lambda x: (-x[0], -x[2], x[3], x[1])):
        if all(e <= a or s >= b for _, _, a, b in kept):
            kept.append((name, share, s, e))
    return sorted(kept, key=lambda x: x[2:])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, band: int | None = None) -> DataFrame:
    """One row per license text found: ``doc_id, license, coverage, start, end``.

    Whole texts of ``docs`` (``doc_id, text``; other columns ignored) are read. Null or empty texts give no rows, nor does
    an empty table; rows with a null or repeated ``doc_id`` are scanned each on its own. Templates of fewer than three
    words are left out. A match holds ``coverage`` of a template's words and all its telling ones. None with at most ``band``
    other words in between (by default a quarter of the template's length, at least four) is missed. A region is reported once, for the template with most matched words (ties: higher coverage, name).
    """
    chosen = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = LicenseIndex(chosen, coverage, band)
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch["doc_id"], batch["text"]) for m in find(t, index)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "start", "end"])
            yield out.assign(doc_id=pd.array([None if pd.isna(d) else int(d) for d in out["doc_id"]], "Int64"))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInPandas(run, "doc_id long, license string, coverage double, start long, end long"))
