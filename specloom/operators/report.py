"""Counts, coverage and run reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom import registry as R
from specloom.operators.common import latest, null_safe_join, ratio, select_where

PRODUCT = ["brand", "product_model"]


def counts(df: DataFrame, *keys: str) -> DataFrame:
    """A1."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """A1: rows per named table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_models(catalog: DataFrame) -> DataFrame:
    """A2: distinct models by brand, brand and l1, brand, l1 and l2, and in all, in one rollup.

    ``level`` is the number of hierarchy columns in the group (0 = total).
    """
    rows = catalog.select("brand", "series_l1", "series_l2", "product_model").distinct()
    return rows.rollup("brand", "series_l1", "series_l2").agg(
        F.count_distinct("product_model").alias("models"), F.grouping_id().alias("g")).select(
        "brand", "series_l1", "series_l2", F.when(F.col("g") == 0, 3).when(F.col("g") == 1, 2).when(F.col("g") == 3, 1)
        .otherwise(0).alias("level"), "models")


def coverage(catalog: DataFrame, specs: DataFrame) -> DataFrame:
    """A3: models with specs as a share of catalog models, per brand and in all (brand NULL)."""
    c = catalog.groupBy("brand").agg(F.count_distinct("product_model").alias("catalog_models"))
    s = specs.groupBy("brand").agg(F.count_distinct("product_model").alias("spec_models"))
    per_brand = c.join(s, "brand", "left").select("brand", "catalog_models", F.coalesce("spec_models", F.lit(0)).alias("spec_models"))
    both = per_brand.groupingSets([["brand"], []], "brand").agg(
        F.sum("catalog_models").alias("catalog_models"), F.sum("spec_models").alias("spec_models"))
    return both.withColumn("coverage_pct", ratio(F.col("spec_models") * 100, F.col("catalog_models")))


def field_coverage(specs: DataFrame, brands: Sequence[str]) -> DataFrame:
    """A4: records per required field and listed brand, with the total over those brands.

    Conditional counts in one aggregate; a field without records shows zeros.
    """
    fields = specs.sparkSession.createDataFrame([(f,) for f in R.REQUIRED_FIELDS], "field_code string")
    cells = [F.count_if(F.col("brand") == b).alias(b) for b in brands]
    per_field = specs.groupBy("field_code").agg(*cells, F.count_if(F.col("brand").isin(*brands)).alias("total"))
    zero = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c)
    return fields.join(per_field, "field_code", "left").select("field_code", *[zero(b) for b in brands], zero("total"))


def average_fields(specs: DataFrame) -> DataFrame:
    """A5: records, products and distinct fields per product, by brand."""
    per_product = specs.groupBy(*PRODUCT).agg(F.count_distinct("field_code").alias("fields"), F.count("*").alias("n"))
    return per_product.groupBy("brand").agg(
        F.count("*").alias("products"), F.sum("n").alias("records"), F.avg("fields").alias("avg_fields"))


def issue_summary(issues: DataFrame, *dimensions: str) -> DataFrame:
    """Counts by each dimension on its own and in all, as (dimension, value, n)."""
    dims = list(dimensions) or ["severity", "issue_type", "status"]
    # fold to the few distinct combinations first, the grouping sets then expand those only
    few = issues.groupBy(*dims).agg(F.count("*").alias("n"))
    sets = few.groupingSets([[d] for d in dims] + [[]], *dims).agg(
        F.sum("n").alias("n"), *[F.grouping(d).alias(f"g_{d}") for d in dims])
    name, value = F.lit("total"), F.lit(None).cast("string")
    for d in dims:
        name = F.when(F.col(f"g_{d}") == 0, d).otherwise(name)
        value = F.when(F.col(f"g_{d}") == 0, F.col(d)).otherwise(value)
    return sets.select(name.alias("dimension"), value.alias("value"), F.coalesce("n", F.lit(0)).alias("n"))


def field_statistics(specs: DataFrame) -> DataFrame:
    """Records per run and field, and products of the run that miss the field; also fields that no product has."""
    products = specs.groupBy("run_id").agg(F.count_distinct("product_model").alias("products")).withColumn(
        "field_code", F.explode(F.array(*[F.lit(c) for c in R.FIELD_CODES])))
    fields = specs.groupBy("run_id", "field_code").agg(
        F.count("*").alias("n"), F.count_distinct("product_model").alias("with_field"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return products.join(fields, ["run_id", "field_code"], "left").select(
        "run_id", "field_code", zero("n").alias("n"), (F.col("products") - zero("with_field")).alias("missing"))


def run_summary(runs: DataFrame, catalog: DataFrame, specs: DataFrame, issues: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per run known to any table. ``changes``: U1 rows.

    Every table is counted per run before the joins, so the joined inputs have one row per run.
    """
    c = catalog.groupBy("run_id").agg(F.count("*").alias("catalog_count"), F.count_distinct("brand", "product_model").alias("models"))
    s = specs.groupBy("run_id").agg(F.count("*").alias("spec_field_count"), F.count_distinct("brand", "product_model").alias("with_specs"))
    i = issues.groupBy("run_id").agg(F.count("*").alias("issue_count"), F.count_distinct("product_model").alias("failed"))
    h = changes.groupBy("run_id").agg(F.count_if(F.col("change") == "added").alias("new_series_count"),
                                      F.count_if(F.col("change") == "removed").alias("disappeared_series_count"))
    out = runs
    for part in (c, s, i, h):
        out = out.join(part, "run_id", "full_outer")
    zero = lambda n: F.coalesce(F.col(n), F.lit(0))
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    total = zero("catalog_count")
    return out.select(
        "run_id", "schedule_type", "started_at", "ended_at", seconds.alias("duration_seconds"),
        *[zero(n).alias(n) for n in ("catalog_count", "spec_field_count", "issue_count", "new_series_count", "disappeared_series_count")],
        ratio(total - zero("issue_count"), total).alias("success_rate"),
        F.round(ratio(total - zero("failed"), total), 4).alias("product_success_rate"),
        ratio(zero("with_specs"), zero("models")).alias("spec_success_rate"), "status")


def fetch_statistics(log: DataFrame) -> DataFrame:
    """A11."""
    total, ok = F.count("*"), F.count_if("success")
    size = F.coalesce(F.sum(F.when(F.col("success"), F.col("size"))), F.lit(0))
    return log.agg(total.alias("total_items"), ok.alias("successful"), (total - ok).alias("failed"),
                   ratio(ok * 100, total).alias("success_rate"), size.alias("total_bytes"),
                   ratio(size, ok).alias("avg_bytes_per_item"))


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """A12, by brand and in all (brand NULL). Rows are made distinct first, so only those are expanded."""
    names = ["series_l1", "series_l2", "product_model"]
    few = catalog.groupBy("brand", *names).agg(F.count("*").alias("n"))
    return few.groupingSets([["brand"], []], "brand").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"), F.count_distinct("brand").alias("total_brands"),
        F.count_distinct("series_l1").alias("total_series_l1"), F.count_distinct("series_l2").alias("total_series_l2"),
        F.count_distinct("product_model").alias("total_models"))


def hierarchy_summary(hierarchy: DataFrame) -> DataFrame:
    """A13, per run."""
    return hierarchy.groupBy("run_id").agg(
        F.count("*").alias("total_nodes"), F.count_distinct("brand").alias("total_brands"),
        F.count_if(F.col("series_l2").isNull()).alias("total_l1"), F.count("series_l2").alias("total_l2"),
        F.min("discovered_at").alias("discovery_time"))


def duplicate_groups(catalog: DataFrame) -> DataFrame:
    """Entries that share brand, series and model with another entry, one row each with the group size.

    The list form (one row per group with all entries) is left out on purpose: a group has no size limit.
    """
    keys = ["brand", "series_l1", "series_l2", "product_model"]
    big = catalog.groupBy(*keys).agg(F.count("*").alias("group_size")).where("group_size > 1")
    return null_safe_join(catalog, big, keys, "inner").select(*keys, "product_url", "product_name", "group_size")


def duplicate_models_in_run(catalog: DataFrame) -> DataFrame:
    """Entries whose model occurs more than once in their run."""
    keys = ["run_id", "product_model"]
    big = catalog.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    return catalog.join(big, keys, "left_semi")


def products_without_specs(catalog: DataFrame, specs: DataFrame) -> DataFrame:
    """J6. The spec keys are made distinct per partition before they are compared."""
    return catalog.join(specs.select(*PRODUCT).distinct(), PRODUCT, "left_anti")


def missing_fields(catalog: DataFrame, specs: DataFrame) -> DataFrame:
    """Required fields a catalog product has no record for.

    The fields of a product are collected as a set of at most twelve codes and subtracted from the required
    list, instead of pairing every product with every field.
    """
    required = F.array(*[F.lit(f) for f in R.REQUIRED_FIELDS])
    have = specs.where(F.col("field_code").isin(*R.REQUIRED_FIELDS)).groupBy(*PRODUCT).agg(F.collect_set("field_code").alias("have"))
    products = catalog.select(*PRODUCT).distinct().join(have, PRODUCT, "left")
    left = F.array_except(required, F.coalesce("have", F.array().cast("array<string>")))
    return products.select(*PRODUCT, F.explode(left).alias("field_code"))


def missing_field_counts(catalog: DataFrame, specs: DataFrame) -> DataFrame:
    """J7 per brand and field."""
    return missing_fields(catalog, specs).groupBy("brand", "field_code").agg(F.count("*").alias("missing_products"))


def top_missing_fields(catalog: DataFrame, specs: DataFrame, n: int = 5) -> DataFrame:
    """The fields most products of a brand miss. A brand has at most twelve rows here."""
    w = Window.partitionBy("brand").orderBy(F.desc("missing_products"), "field_code")
    return missing_field_counts(catalog, specs).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def recent_runs(runs: DataFrame, n: int = 10, status: str | None = None, schedule_type: str | None = None) -> DataFrame:
    """T1."""
    return select_where(runs, status=status, schedule_type=schedule_type).orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first rows of a report list in a total order."""
    return df.orderBy(*order).limit(n)


def retry_candidates(catalog: DataFrame, log: DataFrame, catalog_key: str, *newest_first: Column) -> DataFrame:
    """Catalog entries whose last fetch failed; ``newest_first`` orders the attempts of a url."""
    failed = latest(log.where("url IS NOT NULL"), ["url"], *newest_first).where("NOT success").select(F.col("url").alias(catalog_key))
    return catalog.join(failed, catalog_key, "left_semi")


def normalize_hierarchy(listing: DataFrame) -> DataFrame:
    """Items take brand and series of the node they were found under; ``mismatch`` lists what differed."""
    pairs = (("brand", "node_brand"), ("series_l1", "node_l1"), ("series_l2", "node_l2"))
    differs = F.array(*[F.when(~F.col(a).eqNullSafe(F.col(b)), F.lit(a)) for a, b in pairs])
    nodes = [b for _, b in pairs]
    mismatch = F.array_join(F.filter(differs, lambda x: x.isNotNull()), ",")
    return listing.withColumn("mismatch", mismatch).withColumns({a: F.col(b) for a, b in pairs}).drop(*nodes)


def run_report(runs: DataFrame, catalog: DataFrame, specs: DataFrame, issues: DataFrame) -> DataFrame:
    """Per run and brand the entry, record and issue counts, next to the run's status and success rate (as in A9).

    Every table is folded once, to run and brand; the totals of a run are sums over its brands, and all joins are of that size.
    """
    keys = ["run_id", "brand"]
    parts = [df.groupBy(*keys).agg(F.count("*").alias(name))
             for df, name in ((catalog, "catalog_entries"), (specs, "spec_records"))]
    i = issues.groupBy(*keys).agg(F.count("*").alias("issues"), *[F.count_if(F.col("severity") == s).alias(s.lower()) for s in R.SEVERITIES])
    out = parts[0].join(parts[1], keys, "full_outer").join(i, keys, "full_outer")
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("catalog_entries", "spec_records", "issues", "p1", "p2", "p3")]
    total = lambda c: F.sum(c).over(Window.partitionBy("run_id"))
    rate = ratio(total("catalog_entries") - total("issues"), total("catalog_entries"))
    return out.select(*keys, *zero).withColumn("success_rate", rate).join(runs.select("run_id", "status"), "run_id", "left").select(
        *keys, *[F.col(c) for c in ("catalog_entries", "spec_records", "issues", "p1", "p2", "p3")], "status", "success_rate")


def quality_report(issues: DataFrame, severity: str | None = None, issue_type: str | None = None) -> DataFrame:
    """Filtered issues counted by run, brand, type and severity."""
    return select_where(issues, severity=severity, issue_type=issue_type).groupBy(
        "run_id", "brand", "issue_type", "severity").agg(F.count("*").alias("n"))


def wide_specs(specs: DataFrame) -> DataFrame:
    """One row per run and product with a column per field (the latest value).

    A conditional max per field in one aggregate: the field list is fixed, so no job is needed to find it.
    """
    keys = ["run_id", "brand", "series_l1", "series_l2", "product_model"]
    value = F.struct("updated_at", "normalized_value")
    cells = [F.max(F.when((F.col("field_code") == c) & F.col("normalized_value").isNotNull(), value)).alias(c) for c in R.FIELD_CODES]
    return specs.groupBy(*keys).agg(*cells).select(*keys, *[F.col(c).normalized_value.alias(c) for c in R.FIELD_CODES])


def compare_products(specs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Two products field by field, by the comparison rule of the field.

    ``pairs``: (left_brand, left_model, right_brand, right_model). One latest value per product and field.
    """
    from specloom.functions import values as V
    one = latest(specs.where("normalized_value IS NOT NULL AND field_code IS NOT NULL").select(*PRODUCT, "field_code", "normalized_value", "updated_at"),
                 [*PRODUCT, "field_code"], F.desc("updated_at"), F.desc("normalized_value")).drop("updated_at")
    value, rule = F.col("normalized_value"), R.lookup(F.col("field_code"), {f.code: f.rule for f in R.FIELDS})
    # values are parsed once per product, not once per pair and side: the joins share one exchange of parsed values
    parts = V.comparison_parts(rule, value)
    parsed = one.withColumns(parts)
    parts = {name: F.col(name) for name in parts}
    cell = F.struct("field_code", value.alias("value"), V.comparison_key(rule, F.col("field_code"), value, parts).alias("key"),
                    V.comparison_order(rule, parts).alias("order"))
    products = parsed.select(*PRODUCT, cell.alias("cell")).groupBy(*PRODUCT).agg(F.collect_list("cell").alias("cells"))
    side = lambda p: products.withColumnsRenamed({"brand": f"{p}_brand", "product_model": f"{p}_model", "cells": f"{p}_cells"})
    both = pairs.join(side("left"), ["left_brand", "left_model"]).join(side("right"), ["right_brand", "right_model"])
    names = ["left_brand", "left_model", "right_brand", "right_model"]
    by_field = F.map_from_entries(F.transform("right_cells", lambda x: F.struct(x["field_code"], x)))
    cells = both.select(*names, by_field.alias("_right"), F.explode("left_cells").alias("_left")).select(
        *names, "_left", F.try_element_at("_right", F.col("_left.field_code")).alias("_right")).where("_right IS NOT NULL")
    rows = cells.select(*names, F.col("_left.field_code").alias("field_code"), *(
        F.col(f"_{p}.{name}").alias(f"{p}_{name}") for p in ("left", "right") for name in ("value", "key", "order")))
    same = F.coalesce(F.col("left_key") == F.col("right_key"), F.lower("left_value") == F.lower("right_value"))
    ordering = F.when(rule.isin(*V.ORDERED_RULES), V.compare(F.col("left_order"), F.col("right_order")))
    return rows.select("left_brand", "left_model", "right_brand", "right_model", "field_code", rule.alias("comparison_rule"),
                       "left_value", "right_value", same.alias("same"), ordering.alias("ordering"))
