"""Helpers of the operators: tables, materialised intermediates, null handling, tokenizer files."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session without the setting (a test) gets one of its own, a cluster's raises."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="specloom-checkpoint-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder of ``spark.checkpoint.dir``; lineage ends there.

    The files survive a lost executor.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; ``SPECLOOM_TOKENIZERS`` names another folder."""
    import public_tokenizers
    folder = os.environ.get("SPECLOOM_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


class WordCache:
    """A map of bounded size for long tails of words: two generations, the older one is dropped when the younger is full.

    ``take(words)`` returns the values in order; ``fill(list of missing words)`` computes values of words not held.
    """

    def __init__(self, fill, half_size: int = 400_000):
        self.fill, self.half_size, self.young, self.old = fill, half_size, {}, {}

    def ensure(self, groups) -> None:
        """Make every word of all ``groups`` (lists of words) available to :meth:`take` until the next call."""
        if len(self.young) > self.half_size:
            self.old, self.young = self.young, {}
        young, missing = self.young, set()
        for words in groups:
            missing.update(set(words).difference(young))
        old = self.old
        for word in [w for w in missing if w in old]:
            young[word] = old[word]
            missing.discard(word)
        if missing:
            missing = list(missing)
            young.update(zip(missing, self.fill(missing)))

    def values(self, words: list) -> list:
        """The values of different words, none of which is ``None``, in order."""
        if len(self.young) > self.half_size:
            self.old, self.young = self.young, {}
        out = list(map(self.young.get, words))
        young = self.young
        for find in (lambda asked: map(self.old.get, asked), self.fill):
            missing = [i for i, value in enumerate(out) if value is None]
            asked = [words[i] for i in missing]
            for i, word, value in zip(missing, asked, find(asked) if asked else ()):
                if value is not None:
                    out[i] = young[word] = value
        return out

    def held(self, words) -> dict:
        """The values of those words that are held."""
        young, old = self.young.get, self.old.get
        return {w: value for w in words if (value := young(w, old(w))) is not None}

    def lists(self, groups) -> list[list]:
        """The values of the words of each group (lists of words), none of which is ``None``, in order; a word that is held is looked up once."""
        if len(self.young) > self.half_size:
            self.old, self.young = self.young, {}
        young, get, found, gaps, asked = self.young, self.young.get, [], [], []
        for words in groups:
            values = list(map(get, words))
            gap = [i for i, value in enumerate(values) if value is None]
            found.append(values)
            gaps.append(gap)
            asked.append([words[i] for i in gap])
        missing, new = list(set().union(*asked)), []
        for word, value in zip(missing, map(self.old.get, missing)):
            if value is None:
                new.append(word)
            else:
                young[word] = value
        if new:
            young.update(zip(new, self.fill(new)))
        for values, gap, words in zip(found, gaps, asked):
            for i, word in zip(gap, words):
                values[i] = young[word]
        return found

    def take(self, words):
        return map(self.young.__getitem__, words)
