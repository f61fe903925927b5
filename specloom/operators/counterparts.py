"""Counterparts of a brand's products among those of another brand (N12 for two brands).

Where a few tokens in common make a pair, most products of two brands are pairs, far too many to be written down. So pairs are
counted where two blocks of classes meet and only the best of each class leave the block: what is shuffled are the classes, once per
block of the other side. The work is one comparison of small integers per pair and field.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from specloom import registry as R
from specloom.functions import values as V
from specloom.operators.common import latest

PRODUCT = ["brand", "product_model"]
SHARDS = 64  # in which the values of a field are numbered
LEFT, RIGHT = 32_768, 65_536  # classes of a block, on average
CELLS = 1 << 21  # pairs counted at once


def signatures(specs: DataFrame) -> DataFrame:
    """One row per product: ``tokens``, one per field with a value, that are equal where the field's comparison rule calls two values the same."""
    one = latest(specs.where("normalized_value IS NOT NULL").select(*PRODUCT, "field_code", "normalized_value", "updated_at"),
                 [*PRODUCT, "field_code"], F.desc("updated_at"), F.desc("normalized_value"))
    value, rule = F.col("normalized_value"), R.lookup(F.col("field_code"), {f.code: f.rule for f in R.FIELDS})
    key = V.comparison_key(rule, F.col("field_code"), value)
    # a value that can't be parsed is the same as one of the same text
    token = F.to_json(F.struct(F.col("field_code").alias("f"), key.alias("k"), F.when(key.isNull(), F.lower(value)).alias("t")))
    return one.select(*PRODUCT, token.alias("token")).groupBy(*PRODUCT).agg(F.sort_array(F.collect_set("token")).alias("tokens"))


def counterparts(specs: DataFrame, left_brand: str, right_brand: str, most: int = 3, least: int = 4) -> DataFrame:
    """``left_model, right_model, same_fields, rank``: for each product of the left brand the ``most`` products of the right one that are the
    same in most fields, in at least ``least`` of them; ties go to the lesser model.

    Products of a brand with the same values are one class; all classes of the two brands are compared, block by block.
    """
    return matches(signatures(specs.where(F.col("brand").isin(left_brand, right_brand))), left_brand, right_brand, most, least)


def _numbered(classes: DataFrame) -> DataFrame:
    """``brand, class, fields, numbers``: the tokens of a class as numbers of their fields and, within those, of their values. Exact, no hashes."""
    rows = classes.select("brand", "class", F.explode("tokens").alias("token"))
    every = rows.select("token").distinct().select("token", F.get_json_object("token", "$.f").alias("field"))
    place = Window.partitionBy("field", "shard").orderBy("token")
    every = every.withColumn("shard", F.pmod(F.xxhash64("token"), F.lit(SHARDS)).cast("int")).withColumn(
        "number", (F.row_number().over(place) - 1) * SHARDS + F.col("shard") + 1)
    fields = every.select("field").distinct().withColumn("_field", F.row_number().over(Window.orderBy("field")))  # one row per field
    every = every.join(fields, "field").select("token", F.col("_field").alias("field"), "number")
    pair = F.struct(F.col("field"), F.col("number"))
    return rows.join(every, "token").groupBy("brand", "class").agg(F.sort_array(F.collect_list(pair)).alias("pairs")).select(
        "brand", "class", F.col("pairs.field").alias("fields"), F.col("pairs.number").alias("numbers"))


def _table(rows: pd.DataFrame, fields: np.ndarray) -> np.ndarray:
    """A row per field with the number of each class's value, 0 where it has none."""
    out = np.zeros((len(fields), len(rows)), dtype=np.int32)
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows["fields"]])
    if len(owner):
        out[np.searchsorted(fields, np.concatenate(rows["fields"].to_list())), owner] = np.concatenate(rows["numbers"].to_list())
    return out


def _best_of_blocks(most: int, least: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The first ``most`` right classes of each left class among the members of two blocks."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        names = np.array([], dtype=object)
        if len(left) and len(right):
            # in the order of UTF-8 bytes, in which Spark compares strings
            right = right.iloc[np.argsort(np.array([x.encode("utf-8", "surrogatepass") for x in right["class"]], dtype=object), kind="stable")]
            names = right["class"].to_numpy()
            fields = np.unique(np.concatenate([*left["fields"], *right["fields"]]))
            a, b = _table(left, fields), _table(right, fields)
            kind = np.uint8 if len(fields) < 256 else np.int32
            codes = []
            for x, y in zip(a, b):  # small codes of the values that both blocks have; others are the same as nothing
                shared = np.intersect1d(x[x > 0], y[y > 0])
                if len(shared):
                    small = np.uint8 if len(shared) < 254 else np.int32
                    at = lambda v, none: np.where(np.isin(v, shared), np.searchsorted(shared, v) + 2, none).astype(small)
                    codes.append((at(x, 0), at(y, 1)))
            step = max(1, CELLS // len(right))
            for begin in range(0, len(left), step):
                n = min(step, len(left) - begin)
                same, score = np.empty((n, len(right)), dtype=bool), np.zeros((n, len(right)), dtype=kind)
                for x, y in codes:
                    np.equal(x[begin:begin + n, None], y[None, :], out=same)
                    score += same
                rows = np.arange(n)
                for _ in range(min(most, len(right))):
                    first = score.argmax(axis=1)  # the first of the highest
                    height = score[rows, first]
                    ok = (height >= least) & (height > 0)
                    if not ok.any():
                        break
                    found.append((begin + rows[ok], first[ok], height[ok]))
                    score[rows, first] = 0
        rows, firsts, heights = (np.concatenate([f[k] for f in found]) if found else np.array([], dtype=np.int64) for k in range(3))
        return pd.DataFrame({"left_class": left["class"].to_numpy()[rows], "right_class": names[firsts], "same_fields": heights.astype(np.int32)})
    return run


def matches(products: DataFrame, left_brand: str, right_brand: str, most: int, least: int, left_block: int = LEFT, right_block: int = RIGHT) -> DataFrame:
    """:func:`counterparts` of the rows of :func:`signatures`. The sizes of blocks bound what a task holds and change no result."""
    both = products.where(F.col("brand").isin(left_brand, right_brand) & (F.size("tokens") >= F.greatest(F.lit(least), F.lit(1))))
    classes = both.groupBy("brand", "tokens").agg(F.min("product_model").alias("class"))
    sides = _numbered(classes.where("class IS NOT NULL"))
    blocks = classes.agg(*(F.ceil(F.count(F.when(F.col("brand") == brand, 1)) / F.lit(size)).cast("int").alias(name)
                           for name, brand, size in (("n_left", left_brand, left_block), ("n_right", right_brand, right_block))))

    def dealt(brand: str, mine: str, other: str) -> DataFrame:
        """The classes of a brand, each in its block and once per block of the other side."""
        n = lambda name: F.greatest(blocks.select(name).scalar(), F.lit(1))
        rows = sides.where(F.col("brand") == brand).withColumn(mine, F.pmod(F.xxhash64("class"), n(f"n_{mine}")).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), n(f"n_{other}") - 1))).select(
            *(F.col(c).alias(c) for c in ("left", "right", "class", "fields", "numbers")))  # named anew: both sides come from one frame
    scored = dealt(left_brand, "left", "right").groupBy("left", "right").cogroup(dealt(right_brand, "right", "left").groupBy("left", "right")).applyInPandas(
        _best_of_blocks(most, least), "left_class string, right_class string, same_fields int")
    # a class brings its first models only: no list can hold more of them
    models = both.join(classes, ["brand", "tokens"]).select("brand", "class", "product_model")
    first = Window.partitionBy("brand", "class").orderBy("product_model")
    right = models.where(F.col("brand") == right_brand).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).select(
        F.col("class").alias("right_class"), F.col("product_model").alias("right_model"))
    # the classes that come first by score and least model hold the first models
    order = Window.partitionBy("left_class").orderBy(F.desc("same_fields"), "right_class")
    kept = scored.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).select("left_class", "right_class", "same_fields")
    kept = kept.join(right, "right_class")
    rank = Window.partitionBy("left_class").orderBy(F.desc("same_fields"), "right_model")
    listed = kept.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= most).select("left_class", "right_model", "same_fields", "rank")
    left = models.where(F.col("brand") == left_brand).select(F.col("class").alias("left_class"), F.col("product_model").alias("left_model"))
    return left.join(listed, "left_class").select("left_model", "right_model", "same_fields", "rank")
