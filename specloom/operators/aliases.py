"""Alias search at size: an inverted index of n-grams in place of one comparison per alias and row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GRAM = 3  # characters; shorter aliases are their own gram


def grams(text: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def alias_index(aliases: DataFrame) -> DataFrame:
    """``gram, alias, field_code, alias_rank``: every alias under its rarest gram, so that common letters gather no aliases.

    ``aliases``: (field_code, alias, alias_rank). Case is ignored, blank aliases are left out; of equal aliases of a field the
    lowest rank counts.
    """
    a = aliases.select("field_code", F.lower("alias").alias("alias"), "alias_rank").where("alias <> ''")
    a = a.groupBy("alias", "field_code").agg(F.min("alias_rank").alias("alias_rank"))
    own = a.select("alias").distinct().select("alias", F.explode(F.coalesce(
        F.when(F.length("alias") >= GRAM, grams(F.col("alias"), GRAM)), F.array("alias"))).alias("gram"))
    common = own.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = own.join(common, "gram").groupBy("alias").agg(F.min(F.struct("n", "gram")).gram.alias("gram"))
    return a.join(rarest, "alias").select("gram", "alias", "field_code", "alias_rank")


def label_fields(labels: DataFrame, label: str, aliases: DataFrame) -> DataFrame:
    """J2 for any number of aliases: rows of ``labels`` with each field that has an alias in the label, and the lowest rank.

    Every different label is searched once: its grams meet the index by equality, and what meets is compared as a whole.
    The plan does not depend on the number of aliases.
    """
    texts = labels.select(F.lower(F.col(label)).alias("_text")).where("_text <> ''").distinct()
    cut = texts.select("_text", F.explode(F.concat(*[grams(F.col("_text"), n) for n in range(1, GRAM + 1)])).alias("gram"))
    hits = cut.join(alias_index(aliases), "gram").where(F.contains("_text", "alias"))
    hits = hits.groupBy("_text", "field_code").agg(F.min("alias_rank").alias("alias_rank"))
    return labels.join(hits, F.lower(F.col(label)) == F.col("_text")).select(*(labels[c] for c in labels.columns), "field_code", "alias_rank")
