"""Helpers shared by the table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.functions.text import is_blank


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """First row per key in the given order.

    Row number 1 lets Catalyst limit each group before the shuffle (WindowGroupLimit), so a key that holds most
    of the rows still sends only one row per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL. For kinds that keep right columns, its keys are named ``_r_<key>``."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how)


def natural_key(*columns: str) -> Column:
    """Digest of the columns' values; NULL and the text of another column can't be mistaken for each other."""
    return F.sha2(F.to_json(F.array(*[F.col(c).cast("string") for c in columns])), 256)


def select_where(df: DataFrame, **keys: object) -> DataFrame:
    """conjunction of equality filters; keys with value None are skipped.

    The conditions are plain column comparisons, so they reach the scan.
    """
    for name, value in keys.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def problems(*checks: tuple[Column, Column | str]) -> Column:
    """array<string> of the texts whose condition holds."""
    texts = [F.when(cond, text if isinstance(text, Column) else F.lit(text)) for cond, text in checks]
    return F.filter(F.array(*texts), lambda x: x.isNotNull())


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    """a / b as double, ``empty`` for a zero or missing divisor."""
    return F.when(F.coalesce(b, F.lit(0)) > 0, a.cast("double") / b).otherwise(F.lit(empty))


__all__ = ["latest", "null_safe_join", "select_where", "problems", "ratio", "is_blank"]
