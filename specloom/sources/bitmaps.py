"""Exact distinct counts that merge over runs (A2, A3, A5, A12): a bitmap per run and group over a stored key dictionary.

A count of distinct keys can't be added up over runs, a bitmap of key numbers can be united. Each run leaves bitmaps of what it holds; counts
over any set of runs, at any level of the group, come from those alone, without reading a row of the runs again.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from specloom.operators.common import null_safe_join
from specloom.sources import snapshots

SHARDS = 64


class DistinctCounts:
    """Bitmaps of ``key`` per run and ``group`` in a folder. One writer at a time; a step that fails may be run again.

    ``keys/`` numbers every key once. Numbers are dense, so that keys share words: a key
    falls into one of 64 shards by its hash and is ranked there, so no step sorts all keys in one task. ``runs/`` has
    a partition per run with ``group, bucket, bits``: the words of 64 bits that have a bit set. So a bitmap never has more rows than keys, and
    aggregates hold numbers and no buffers; blocks of fixed size would be nearly empty for small groups, and what compresses well in a
    shuffle fills the memory of the task that reads it. A NULL key is no value, but its group is kept with a count of zero. NULL is a group like
    any other.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, group: Sequence[str]):
        self.spark, self.base, self.key, self.group = spark, base, key, list(group)

    def _stored(self, name: str) -> DataFrame | None:
        path = os.path.join(self.base, name)
        return self.spark.read.parquet(path) if snapshots._exists(self.spark, snapshots._path(self.spark, self.base, name)) else None

    def _number(self, rows: DataFrame) -> DataFrame:
        """Adds keys that have no number yet and returns the dictionary. Keys numbered by a failed step keep their numbers."""
        new = rows.select(F.col(self.key).alias("key")).where("key IS NOT NULL").distinct()
        new = new.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS)).cast("int"))
        stored = self._stored("keys")
        rank = F.row_number().over(Window.partitionBy("shard").orderBy("key")).cast("long")
        if stored is None:
            ranked = new.withColumn("rank", rank)
        else:
            last = stored.groupBy("shard").agg(F.max("rank").alias("last"))
            ranked = new.join(stored.select("key"), "key", "left_anti").withColumn("rank", rank).join(last, "shard", "left").withColumn(
                "rank", F.col("rank") + F.coalesce("last", F.lit(0))).drop("last")
        ranked.select("key", "shard", "rank").write.mode("append").parquet(os.path.join(self.base, "keys"))
        return self._stored("keys").select("key", ((F.col("rank") - 1) * SHARDS + F.col("shard") + 1).alias("key_no"))

    def add(self, rows: DataFrame, replaces: Sequence[str] = ()) -> None:
        """The runs of ``rows`` (``run_id``, the group and the key); a run that comes again replaces itself, one without rows in ``replaces`` goes.

        Rows are made distinct before they meet the dictionary, so a run or key that holds most rows moves as few of them.
        """
        few = rows.select("run_id", *self.group, F.col(self.key).alias("key")).distinct()
        numbers = self._number(few.withColumnRenamed("key", self.key))
        place = F.col("key_no") - 1
        bits = few.join(numbers, "key", "left").groupBy("run_id", *self.group, F.shiftright(place, 6).alias("bucket")).agg(
            F.coalesce(F.bit_or(F.expr("shiftleft(1L, cast((key_no - 1) & 63 AS int))")), F.lit(0).cast("long")).alias("bits"))
        snapshots.write_partitions(bits, self.base, "runs", replaces)

    def merged(self, run_ids: Sequence[str] | None = None) -> DataFrame:
        """``group, bucket, bits`` over all runs or the given ones. The run predicate prunes folders."""
        stored = self._stored("runs")
        rows = stored if run_ids is None else stored.where(F.col("run_id").isin(*run_ids))
        return rows.groupBy(*self.group, "bucket").agg(F.bit_or("bits").alias("bits"))

    def counts(self, name: str, levels: Sequence[Sequence[str]] | None = None, run_ids: Sequence[str] | None = None) -> DataFrame:
        """``group, level, name``: distinct keys per level, ``level`` being the number of its columns. Default: every prefix of the group.

        Words are united per level and bucket, with partial results before the shuffle; only their counts are added up. The level
        without columns has a row also if nothing is stored for the runs.
        """
        sets = [list(s) for s in (levels if levels is not None else [self.group[:n] for n in range(len(self.group), -1, -1)])]
        out = None
        merged = self.merged(run_ids)
        for s in sets:
            part = merged.groupBy(*s, "bucket").agg(F.bit_or("bits").alias("bits")).groupBy(*s).agg(
                F.coalesce(F.sum(F.bit_count("bits").cast("long")), F.lit(0)).alias(name))
            part = part.select(*[F.col(c) if c in s else F.lit(None).cast(merged.schema[c].dataType).alias(c) for c in self.group],
                               F.lit(len(s)).alias("level"), name)
            out = part if out is None else out.unionByName(part)
        return out


def model_counts(store: DistinctCounts, run_ids: Sequence[str] | None = None) -> DataFrame:
    """A2 over any runs: distinct models by brand, brand and l1, brand, l1 and l2, and in all."""
    return store.counts("models", run_ids=run_ids)


def coverage(catalog: DistinctCounts, specs: DistinctCounts, run_ids: Sequence[str] | None = None) -> DataFrame:
    """A3 over any runs: catalog models and models with specs per brand. Both stores have groups that start with the brand."""
    c = catalog.counts("catalog_models", [["brand"]], run_ids).select("brand", "catalog_models")
    s = specs.counts("spec_models", [["brand"]], run_ids).select("brand", "spec_models")
    joined = null_safe_join(c, s, ["brand"], "left")
    return joined.select("brand", "catalog_models", F.coalesce("spec_models", F.lit(0)).alias("spec_models"))


def average_fields(store: DistinctCounts, run_ids: Sequence[str] | None = None) -> DataFrame:
    """A5 over any runs, of bitmaps of field codes by brand and model: products and distinct fields per product, by brand."""
    fields = store.counts("fields", [["brand", "product_model"]], run_ids)
    return fields.groupBy("brand").agg(F.count("*").alias("products"), F.avg("fields").alias("avg_fields"))
