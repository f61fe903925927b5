"""Filters and lookups over the six tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from specloom import registry as R
from specloom.functions.values import allowed_series, valid_model
from specloom.operators.common import problems, select_where

SEVERITY_RANK = {s: i for i, s in enumerate(reversed(R.SEVERITIES), start=1)}


def select_run(df: DataFrame, run_id: str | None = None, brand: str | None = None, series_l1: str | None = None,
               series_l2: str | None = None, product_model: str | None = None, field_code: str | None = None) -> DataFrame:
    """F1, F6."""
    return select_where(df, run_id=run_id, brand=brand, series_l1=series_l1, series_l2=series_l2,
                        product_model=product_model, field_code=field_code)


def select_issues(issues: DataFrame, run_id: str | None = None, severity: str | None = None, status: str | None = None,
                  issue_type: str | None = None, product_model: str | None = None, owner: str | None = None) -> DataFrame:
    """F2."""
    return select_where(issues, run_id=run_id, severity=severity, status=status, issue_type=issue_type,
                        product_model=product_model, owner=owner)


def critical_issues(issues: DataFrame, run_id: str | None = None) -> DataFrame:
    return select_issues(issues, run_id=run_id, severity="P1")


def open_issues(issues: DataFrame, run_id: str | None = None, min_severity: str = "P3") -> DataFrame:
    """open issues at or above a severity; an unknown severity selects all."""
    rows = select_issues(issues, run_id=run_id, status="open")
    at_least = SEVERITY_RANK.get(min_severity)
    if at_least is None:
        return rows
    return rows.where(F.col("severity").isin(*[s for s, rank in SEVERITY_RANK.items() if rank >= at_least]))


def low_confidence(specs: DataFrame, run_id: str | None = None, threshold: float = 0.7) -> DataFrame:
    """F4."""
    return select_where(specs, run_id=run_id).where(F.col("extract_confidence") < threshold)


def overridden(specs: DataFrame, run_id: str | None = None) -> DataFrame:
    """F5."""
    return select_where(specs, run_id=run_id).where("is_manual_override")


def allowed_catalog(catalog: DataFrame, keywords: list[str]) -> DataFrame:
    """F7."""
    return catalog.where(allowed_series(F.col("series_l1"), keywords))


def valid_models(catalog: DataFrame) -> DataFrame:
    """F8."""
    return catalog.where(valid_model(F.col("product_model")))


def incomplete_catalog(catalog: DataFrame) -> DataFrame:
    """one row per problem of a catalog entry."""
    missing = [(F.coalesce(F.col(c), F.lit("")) == "", f"Missing {label}") for c, label in (
        ("brand", "brand"), ("series_l1", "series_l1"), ("series_l2", "series_l2"), ("product_model", "model"),
        ("product_url", "URL"), ("product_name", "name"))]
    url = F.coalesce(F.col("product_url"), F.lit(""))
    bad_url = (url != "") & ~url.startswith("http://") & ~url.startswith("https://")
    return catalog.select("*", F.explode(problems(*missing, (bad_url, "Invalid URL format"))).alias("problem"))


def incomplete_hierarchy(hierarchy: DataFrame) -> DataFrame:
    """brands without first-level nodes and first-level nodes without a second level, per run."""
    l1_nodes = F.count_if(F.col("series_l2").isNull())
    brands = hierarchy.groupBy("run_id", "brand").agg(l1_nodes.alias("n")).where("n = 0").select(
        "run_id", "brand", F.lit(None).cast("string").alias("series_l1"), F.lit("no L1 series").alias("problem"))
    # one aggregate tells both: a first level that has its own node and no second-level node
    series = hierarchy.groupBy("run_id", "brand", "series_l1").agg(
        l1_nodes.alias("n"), F.count("series_l2").alias("subs")).where("n > 0 AND subs = 0").select(
        "run_id", "brand", "series_l1", F.lit("no L2 subseries").alias("problem"))
    return brands.unionByName(series)


def manual_for_product(manual: DataFrame, brand: str, model: str) -> DataFrame:
    """F11."""
    return select_where(manual, brand=brand, product_model=model).orderBy(F.desc("created_at"), "input_id")


def manual_for_series(manual: DataFrame, brand: str, series_l1: str, series_l2: str | None = None) -> DataFrame:
    return select_where(manual, brand=brand, series_l1=series_l1, series_l2=series_l2).orderBy(
        F.desc("created_at"), "input_id")


def series_l1(hierarchy: DataFrame, run_id: str | None = None, brand: str | None = None) -> DataFrame:
    """distinct first-level names."""
    return select_where(hierarchy, run_id=run_id, brand=brand).where("series_l1 IS NOT NULL").select(
        "brand", "series_l1").distinct()


def series_l2(hierarchy: DataFrame, run_id: str | None = None, brand: str | None = None, l1: str | None = None) -> DataFrame:
    return select_where(hierarchy, run_id=run_id, brand=brand, series_l1=l1).where("series_l2 IS NOT NULL").select(
        "brand", "series_l1", "series_l2").distinct()


def hierarchy_node(hierarchy: DataFrame, run_id: str, brand: str, l1: str | None, l2: str | None) -> DataFrame:
    """A single node; a NULL level matches NULL."""
    return select_where(hierarchy, run_id=run_id, brand=brand).where(
        F.col("series_l1").eqNullSafe(F.lit(l1)) & F.col("series_l2").eqNullSafe(F.lit(l2)))


