"""Checks of counts from stored bitmaps; the runs come in three parts, one of them again."""

from pyspark.sql import functions as F

from specloom.checks import reports  # noqa: F401  (its oracle is used below)
from specloom.checks.base import ORACLES, check
from specloom.checks.storage import folder
from specloom.sources import bitmaps as B

LATE = "run_id >= '19960101'"


def stored(t, rows, key, *group):
    """All runs of ``rows``: the early ones, half of the late ones, then all of the late ones."""
    store = B.DistinctCounts(t.spark, folder(t), key, group)
    late = F.expr(LATE)
    store.add(rows.where(~late))
    store.add(rows.where(late & (F.crc32(F.coalesce(key, F.lit(""))) % 2 == 0)))
    store.add(rows.where(late))
    return store


def late_runs(t):
    return [r["run_id"] for r in t.runs.where(LATE).select("run_id").distinct().collect()]


check("A2_from_bitmaps")(lambda t: B.model_counts(stored(t, t.catalog, "product_model", "brand", "series_l1", "series_l2")))
ORACLES["A2_from_bitmaps"] = ORACLES["A2_distinct_models"]
check("A3_from_bitmaps", """, c AS (SELECT brand, count(DISTINCT product_model) AS catalog_models FROM catalog WHERE run_id IN (SELECT run_id FROM runs WHERE run_id >= '19960101') GROUP BY brand),
  s AS (SELECT brand, count(DISTINCT product_model) AS spec_models FROM specs AS o WHERE run_id IN (SELECT run_id FROM runs WHERE run_id >= '19960101') GROUP BY brand)
  SELECT c.brand, catalog_models, coalesce(spec_models, 0) AS spec_models FROM c LEFT JOIN s ON c.brand = s.brand""", "catalog", "specs", "runs")(
    lambda t: B.coverage(stored(t, t.catalog, "product_model", "brand"), stored(t, t.specs, "product_model", "brand"), late_runs(t)))
check("A5_from_bitmaps", """SELECT brand, count(*) AS products, avg(fields) AS avg_fields FROM (
  SELECT brand, product_model, count(DISTINCT field_code) AS fields FROM specs GROUP BY brand, product_model) AS p GROUP BY brand""", "specs")(
    lambda t: B.average_fields(stored(t, t.specs, "field_code", "brand", "product_model")))
