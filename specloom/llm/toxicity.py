"""Toxicity by multiple-instance learning (operator 8).

A document is a bag of sentences. A sentence scores ``sigmoid(bias + sum of the weights of its distinct words)``,
a word weighing as much as its features together; the document's
score is the noisy-or of its sentences, ``1 - prod(1 - p)``. Weights are learned from document labels alone; the sentence
scores then tell where a document offends.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from specloom.llm.common import text_or_empty

TRAIN_PER_LABEL = 3000  # labelled documents per label that the model is fitted on, at most (about)
LEAST_DOCUMENTS = 5  # training documents that must hold a feature
LEAST_Z = 5.0  # and the least difference between the labels' shares of documents that hold it, in standard errors
PREFIXES = (4, 5, 6)  # a word's features: itself and its prefixes, which inflected forms share
EPOCHS, RATE, SHRINK = 80, 0.15, 0.01
LEAST_WEIGHT = 0.1  # words that count less than this are left out
TRAIN_CHARS = 200_000  # labelled documents that are longer are not fitted on, so that the sample is bounded in size too
KNOWN_WORDS = 500_000  # words whose weight a task remembers
TOKEN = re.compile(r"\w+|[.!?\n]")
ENDS = frozenset(".!?\n")


def held_out(doc_id: Column) -> Column:
    """Rows labels are never learned from: crc32 of the id's text is a multiple of 5 (an id that is null: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if n <= len(word))]


def sentences(text: str) -> list[set[str]]:
    """Distinct words of each sentence, at least one sentence."""
    out: list = [set()]
    for token in TOKEN.findall(text.lower()):
        if token in ENDS:
            out.append(set())
        else:
            out[-1].add(token)
    return [s for s in out if s] or out[:1]


def _noisy_or(z: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence probabilities and log of the chance that no sentence of a document offends."""
    return 1 / (1 + np.exp(-z)), np.add.reduceat(-np.logaddexp(0, z), starts)


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[dict[str, float], float]:
    """Word weights and bias by gradient steps (Adam) on the likelihood of the labels."""
    # texts are cut twice, so that never the words of more than one are held
    positive = np.asarray(labels) > 0
    count: dict = {True: {}, False: {}}
    for text, label in zip(texts, positive.tolist()):
        held = count[label]
        for f in {f for w in set().union(*sentences(text)) for f in features(w)}:
            held[f] = held.get(f, 0) + 1
    n1, n0 = max(positive.sum(), 1), max((~positive).sum(), 1)

    def telling(f):
        a, b = count[True].get(f, 0), count[False].get(f, 0)
        share = (a + b) / (n1 + n0)
        return a + b >= LEAST_DOCUMENTS and abs(a / n1 - b / n0) >= LEAST_Z * np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    words = sorted(f for f in {*count[True], *count[False]} if telling(f))
    count.clear()
    index = {w: i for i, w in enumerate(words)}
    ids, sizes, starts = array.array("i"), array.array("q"), []
    for text in texts:
        starts.append(len(sizes))
        for sentence in sentences(text):
            n = 0
            for word in sorted(sentence):
                known = [index[f] for f in features(word) if f in index]
                ids.extend(known)
                n += len(known)
            sizes.append(n)
    at, ids, sizes, starts = len(sizes), np.array(ids, dtype=np.int32), np.array(sizes, dtype=np.int64), np.array(starts)
    owner, document = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.arange(len(texts)), np.diff(np.append(starts, at)))
    weights, positive = np.zeros(len(words) + 1), positive[document]
    weights[-1] = -4.0
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, epochs + 1):
        z = weights[-1] + np.bincount(owner, weights=weights[ids], minlength=len(sizes))
        p, none = _noisy_or(z, starts)
        chance = -np.expm1(none)
        # of a toxic document's sentences, each answers for its share; of a clean one's, all must be clean
        slope = np.where(positive, -p * (np.exp(none) / np.maximum(chance, 1e-12))[document], p)
        step_by = np.append(np.bincount(ids, weights=slope[owner], minlength=len(words)) + SHRINK * weights[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * step_by, 0.99 * second + 0.01 * step_by ** 2
        weights -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return {w: float(x) for w, x in zip(words, weights[:-1]) if x}, float(weights[-1])


class Scorer(dict):
    """Scores texts; as a dict it remembers the weight of words met before (``nan`` marks the end of a sentence)."""

    def __init__(self, weights: dict[str, float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __reduce__(self):
        return Scorer, (self.weights, self.bias)

    def __missing__(self, token: str) -> float:
        if token in ENDS:
            value = np.nan
        else:
            value = sum(self.weights.get(f, 0.0) for f in features(token))
            value = value if abs(value) >= LEAST_WEIGHT else 0.0
        self[token] = value
        return value

    def sentences(self, text: str) -> tuple[dict[int, float], int]:
        """Score (before the sigmoid) by number of the sentences that hold words with a weight, and how many others hold words."""
        if len(self) > KNOWN_WORDS:
            self.clear()
        tokens = TOKEN.findall(text.lower())
        values = np.fromiter(map(self.__getitem__, tokens), dtype=np.float64, count=len(tokens))
        at = np.flatnonzero(values)  # ends of sentences are not zero either
        out, seen, number = {}, set(), 0
        for i, value in zip(at.tolist(), values[at].tolist()):
            if value != value:
                number += 1
                seen = set()
            elif tokens[i] not in seen:
                seen.add(tokens[i])
                out[number] = out.get(number, self.bias) + value
        ends = np.isnan(values)
        owner = np.cumsum(ends)[~ends]
        return out, (1 + int((owner[1:] != owner[:-1]).sum()) if len(owner) else 0) - len(out)

    def score(self, text: str) -> float:
        """Noisy-or of all sentences with words, as fitted; a text without words is one sentence."""
        found, others = self.sentences(text)
        z = np.array([*found.values()])
        return float(-np.expm1(-np.logaddexp(0, z).sum() - np.logaddexp(0, self.bias) * (others if found or others else 1)))

    def locate(self, text: str) -> list[dict]:
        """Sentences that score at least one half, as spans of code points."""
        bad, out, at = {n for n, z in self.sentences(text)[0].items() if z >= 0}, [], 0
        for number in range(max(bad) + 1 if bad else 0):
            end = next((i for i in range(at, len(text)) if text[i] in ENDS), len(text))
            if number in bad:
                out.append({"start": at, "end": end})
            at = end + 1
        return out


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_PER_LABEL) -> Scorer:
    """Fit on about ``per_label`` labelled documents per label, chosen by a hash of the id; held-out rows are never used.

    One text counts per id (the least of them), none of more than ``TRAIN_CHARS`` characters. The sample's size doesn't grow with
    the tables, so one task fits the model and only its weights reach the driver.
    Without rows of both labels, the model scores every text 0.5 or less.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = dict(usable.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return Scorer({}, -4.0)
    share = F.when(F.col("toxic") == 1, min(1.0, per_label / counts[1])).otherwise(min(1.0, per_label / counts[0]))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"], kind="stable").drop_duplicates("text")  # copies count once
        weights, bias = fit(rows["text"].tolist(), rows["toxic"].to_numpy())
        return pd.DataFrame({"word": [*weights, None], "weight": [*weights.values(), bias]})
    chosen = texts.where(F.length("text") <= TRAIN_CHARS).join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    model = (chosen.groupBy(F.lit(0).alias("one"))
             .applyInPandas(lambda rows: run(rows), "word string, weight double").collect())
    weights = {r["word"]: r["weight"] for r in model}
    bias = weights.pop(None, -4.0)
    return Scorer(weights, bias)


def scored(docs: DataFrame, scorer: Scorer, locate: bool = True) -> DataFrame:
    """All columns of ``docs`` and ``toxicity`` (0 to 1), ``toxic_spans`` (offending sentences; null unless ``locate``).

    Whole texts are scored; empty and null texts get the score of a sentence without known words. Columns of these names
    in ``docs`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("toxicity", "toxic_spans")]

    @F.pandas_udf("toxicity double, toxic_spans array<struct<start:int,end:int>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = [scorer.score(t) for t in texts]
            spans = [scorer.locate(t) if locate and v >= 0.5 else ([] if locate else None) for t, v in zip(texts, values)]
            yield pd.DataFrame({"toxicity": values, "toxic_spans": spans})
    rows = docs.select(F.struct(*docs.columns).alias("row"), score(text_or_empty()).alias("score"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], "score.toxicity", "score.toxic_spans")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, toxic_spans`` per row of ``docs``."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                       (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "toxic_spans")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with their columns. Every row is judged by its own text, repeated ids too; an
    empty table gives no rows."""
    rows = scored(docs.select(F.struct(*docs.columns).alias("row"), F.col("text")), train(docs, labels), locate=False)
    return rows.where(F.col("toxicity") < threshold).select("row.*")
