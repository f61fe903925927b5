"""Session settings the jobs rely on; all can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The jobs build long CASE expressions. Generated methods above 8000 bytes of byte code are never compiled by
    # the JVM and run interpreted; below this limit Spark uses its split, compilable form instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Runtime plans: coalesce small partitions, split skewed join partitions, broadcast by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
