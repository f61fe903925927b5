"""Registry of the checked queries: a Spark callable and, where SQL can say the same, an oracle for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from specloom.plans import views
from specloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Base tables and domain views by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)


def check(name: str, sql: str | None = None, *view_names: str):
    """Register ``fn(tables) -> DataFrame``; ``sql`` may use the named views."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.with_views(sql.strip(), *view_names) if view_names else sql.strip()
        return fn
    return register
