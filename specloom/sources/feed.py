"""JSON product feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom import schemas
from specloom.functions.html import absolute_url, series_slug
from specloom.functions.text import strip
from specloom.operators.common import latest


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One product per row from JSON documents, with its position in the document."""
    docs = spark.read.schema(schemas.FEED).option("multiLine", True).json(path)
    return docs.select(F.posexplode("products").alias("pos", "p")).select("pos", "p.*")


def parse_feed(docs: DataFrame, text: str, *keys: str) -> DataFrame:
    """The same from a column of JSON texts."""
    parsed = docs.select(*keys, F.from_json(text, schemas.FEED).alias("d"))
    return parsed.select(*keys, F.posexplode("d.products").alias("pos", "p")).select(*keys, "pos", "p.*")


def feed_products(products: DataFrame, series_l1: str, series_l2: str | None, brand: str, base_url: str, *order: str) -> DataFrame:
    """Catalog rows of one series: names match as parts in any case, the first row of a model wins."""
    has = lambda c, part: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(part.lower()))
    rows = products.where(has("series", series_l1))
    if series_l2 and series_l2 != series_l1:
        rows = rows.where(has("subseries", series_l2))
    rows = rows.withColumn("model", strip(F.coalesce("productModel", F.lit("")))).where("model <> ''")
    first = latest(rows, ["model"], *[F.asc(c) for c in (order or ("pos",))])
    slug = F.regexp_replace(F.lower("model"), "[/ ]", "-")
    made = F.concat(F.lit(f"{base_url}/en/products/IP-Products/Network-Cameras/"), series_slug(F.lit(series_l1)), F.lit("/"), slug, F.lit("/"))
    path = F.coalesce("detailPath", F.lit(""))
    url = F.when(path != "", absolute_url(F.lit(base_url), path)).otherwise(made)
    return first.select(F.lit(brand).alias("brand"), F.lit(series_l1).alias("series_l1"), F.lit(series_l2).alias("series_l2"),
                        F.col("model").alias("product_model"), F.coalesce("title", "model").alias("product_name"),
                        url.alias("product_url"), F.lit("en").alias("locale"))


def first_models(rows: DataFrame, series: str, model: str, position: str) -> DataFrame:
    """First row of a model within its series, by position."""
    return latest(rows, [series, model], F.asc(position))
