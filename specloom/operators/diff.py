"""Comparing runs: hierarchy and spec changes, lifecycle, new entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.operators.common import latest, null_safe_join, select_where

NODE = ["brand", "series_l1", "series_l2"]


def run_sequence(df: DataFrame) -> DataFrame:
    """Runs in order with their neighbours. The rows are distinct run ids, so this table stays small."""
    w = Window.orderBy("run_id")
    return df.select("run_id").distinct().select(
        "run_id", F.row_number().over(w).alias("run_no"), F.lag("run_id").over(w).alias("previous_run_id"),
        F.lead("run_id").over(w).alias("next_run_id"))


def latest_run(hierarchy: DataFrame) -> DataFrame:
    """Newest run per brand by discovery time."""
    return hierarchy.groupBy("brand").agg(F.max(F.struct("discovered_at", "run_id")).alias("m")).select(
        "brand", F.col("m.run_id").alias("latest_run_id"))


def previous_runs(df: DataFrame) -> DataFrame:
    """Every run of a brand with the run before it."""
    w = Window.partitionBy("brand").orderBy("run_id")
    return df.select("brand", "run_id").distinct().select(
        "brand", "run_id", F.lag("run_id").over(w).alias("previous_run_id"))


def _path_levels(hierarchy: DataFrame, explode) -> DataFrame:
    present = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    both = F.array(F.when(present("series_l1"), F.lit("")), F.when(present("series_l2"), F.col("series_l2")))
    return hierarchy.select("run_id", "brand", "series_l1", explode(F.filter(both, lambda x: x.isNotNull())).alias("series_l2"))


def paths(hierarchy: DataFrame) -> DataFrame:
    """Distinct hierarchy paths of each run: first-level path and, where present, second-level path."""
    return _path_levels(hierarchy, F.explode).distinct()


def compare_hierarchies(current: DataFrame, previous: DataFrame) -> DataFrame:
    """U1 for two hierarchies: added and removed paths. NULL levels compare equal."""
    a, b = (paths(x.withColumn("run_id", F.lit(""))).select(*NODE) for x in (current, previous))
    return a.exceptAll(b).withColumn("change", F.lit("added")).unionByName(
        b.exceptAll(a).withColumn("change", F.lit("removed")))


def hierarchy_changes(hierarchy: DataFrame) -> DataFrame:
    """U1 for every run of a brand against the brand's run before; ``run_id`` is the later run.

    One shuffle, on the path: each path becomes one row with the set of its runs, and the runs of a brand are read from those rows
    (the exchange is reused), so the input is read once and no window orders it.
    """
    # a node without any path (series_l2 NULL) has no changes, but its run is one of the brand
    seen = _path_levels(hierarchy, F.explode_outer).groupBy(*NODE).agg(F.collect_set("run_id").alias("seen"))
    runs = seen.select("brand", F.explode("seen").alias("run_id")).groupBy("brand").agg(F.array_sort(F.collect_set("run_id")).alias("runs"))

    def change(run: Column, i: Column) -> Column:
        now, before = F.array_contains("seen", run), F.array_contains(F.col("seen"), F.get("runs", i))
        kind = F.when(now & ~before, "added").when(before & ~now, "removed")
        return F.struct(run.alias("run_id"), F.when(F.col("series_l2").isNotNull(), kind).alias("change"))

    later = F.transform(F.slice("runs", 2, F.size("runs")), change)
    return seen.join(runs, "brand").select(*NODE, F.inline(F.filter(later, lambda x: x["change"].isNotNull()))).select(
        "run_id", *NODE, "change")


def series_change_counts(hierarchy: DataFrame) -> DataFrame:
    """New and disappeared nodes per run and brand."""
    return hierarchy_changes(hierarchy).groupBy("run_id", "brand").agg(
        F.count_if(F.col("change") == "added").alias("new_series_count"),
        F.count_if(F.col("change") == "removed").alias("disappeared_series_count"))


def lifecycle(catalog: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """First and last sighting of a product over all runs; unseen for more than ``days`` is discontinued."""
    keys = ["brand", "series_l1", "series_l2", "product_model"]
    seen = catalog.groupBy(*keys).agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    gone = F.datediff(as_of, F.col("last_seen_at")) > days
    return seen.withColumn("catalog_status", F.when(gone, "discontinued").otherwise("current"))


def spec_changes(specs: DataFrame) -> DataFrame:
    """New, changed and removed values between neighbouring runs.

    Rows are first folded to one value per run and key (map-side combine), so a window holds at most one row
    per run.
    """
    keys = ["brand", "product_model", "field_code"]
    values = specs.groupBy("run_id", *keys).agg(F.max(F.struct("updated_at", "normalized_value")).alias("m")).select(
        "run_id", *keys, F.col("m.normalized_value").alias("value"))
    rows = values.join(run_sequence(specs), "run_id")
    w = Window.partitionBy(*keys).orderBy("run_no")
    near = rows.select("*", F.lag("run_no").over(w).alias("prev_no"), F.lag("value").over(w).alias("prev_value"),
                       F.lead("run_no").over(w).alias("next_no"))
    n = F.col("run_no")
    follows = F.coalesce(F.col("prev_no") == n - 1, F.lit(False))
    continued = F.coalesce(F.col("next_no") == n + 1, F.lit(False))

    def event(kind: str, run: str, old: Column, new: Column) -> Column:
        return F.struct(F.col(run).alias("run_id"), F.lit(kind).alias("change_type"), old.alias("old_value"), new.alias("new_value"))

    none = F.lit(None).cast("string")
    events = F.array(
        F.when((n > 1) & ~follows, event("new", "run_id", none, F.col("value"))),
        F.when(follows & ~F.col("value").eqNullSafe(F.col("prev_value")), event("changed", "run_id", F.col("prev_value"), F.col("value"))),
        F.when(F.col("next_run_id").isNotNull() & ~continued, event("removed", "next_run_id", F.col("value"), none)))
    return near.select(*keys, F.inline(F.filter(events, lambda e: e.isNotNull())))


def new_entries(new: DataFrame, existing: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """Rows to append, the first in ``order`` per key that is not stored yet."""
    return null_safe_join(latest(new, list(keys), *order), existing.select(*keys), list(keys), "left_anti")


def empty_subseries(hierarchy: DataFrame, catalog: DataFrame) -> DataFrame:
    """Second-level nodes of a run without any catalog entry."""
    keys = ["run_id", *NODE]
    nodes = hierarchy.where("series_l2 IS NOT NULL").select(*keys).distinct()
    return null_safe_join(nodes, catalog.where("series_l2 IS NOT NULL").select(*keys), keys, "left_anti")


def series_overlap(catalog: DataFrame, first: str, second: str) -> DataFrame:
    """Models listed under both series."""
    models = lambda s: select_where(catalog, series_l2=s).select("product_model")
    return models(first).intersect(models(second))


def union_all(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; columns missing in a part become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
