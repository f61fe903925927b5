"""Sheets of human corrections (S8) and report sheets."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from specloom import registry as R
from specloom.operators.common import natural_key
from specloom.operators.merge import FULL, check_manual_rows, latest_manual


def read_manual_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export of the correction sheet; ``row_no`` counts sheet rows, the header being row 1.

    A sheet is read as one text per file to keep row numbers and quoted line breaks right; sheets are typed by
    hand, so files are small and many files are read in parallel.
    """
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    missing = set(R.MANUAL_SHEET) - set(rows.columns)
    if missing:
        raise ValueError(f"Missing required columns: {sorted(missing)}")
    # within one unsplit file monotonically_increasing_id counts rows from a per-file base
    low = (1 << 33) - 1
    return rows.select(*R.MANUAL_SHEET, (F.monotonically_increasing_id().bitwiseAND(low) + 2).alias("row_no"))


def accepted(rows: DataFrame, created_at: Column) -> DataFrame:
    """Rows with all required columns, the last one per product field, as manual inputs."""
    good = check_manual_rows(rows).where("error IS NULL").select(
        *R.MANUAL_SHEET, created_at.alias("created_at"), F.lpad(F.col("row_no").cast("string"), 12, "0").alias("input_id"))
    last = latest_manual(good, FULL)
    return last.withColumn("input_id", F.concat(F.lit("in-"), natural_key(*FULL)))


def rejected(rows: DataFrame) -> DataFrame:
    return check_manual_rows(rows).where("error IS NOT NULL").select("row_no", "error")


def upsert_manual(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New corrections replace stored ones with the same key."""
    return latest_manual(stored.unionByName(new), FULL)


def sheet(df: DataFrame, columns: tuple[str, ...], brand: str | None = None, *order: str) -> DataFrame:
    """One report sheet: fixed column order, one brand (any case), sorted."""
    rows = df if brand is None else df.where(F.upper("brand") == brand.upper())
    return rows.select(*columns).orderBy(*(order or columns))


def summary_sheet(summary: DataFrame) -> DataFrame:
    """The run summary with the success rate as a percentage text and times as text."""
    when = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias(c)
    shown = {"success_rate": F.format_string("%.2f%%", F.col("success_rate") * 100).alias("success_rate"),
             "started_at": when("started_at"), "ended_at": when("ended_at")}
    return summary.select(*[shown.get(c, F.col(c)) for c in R.SUMMARY_SHEET])


def write_sheets(sheets: dict[str, DataFrame], base: str, fmt: str = "csv") -> None:
    """One folder per sheet."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(os.path.join(base, name))
