"""Run snapshots: Parquet tables partitioned by year, month and run."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from specloom import schemas

LAYOUT = ("year", "month", "run_id")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that driver and executors share")
    return os.path.join(base, f"specloom-{uuid.uuid4().hex}")


def run_date(run_id: Column) -> Column:
    """Date at the front of a run id, NULL for a malformed one."""
    day = F.split_part(run_id, F.lit("_"), F.lit(1))
    return F.when(day.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(day, F.lit("yyyyMMdd"))))


def with_layout(df: DataFrame) -> DataFrame:
    """Adds the partition columns; a malformed run id lands in the default partition."""
    day = run_date(F.col("run_id"))
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def write_runs(df: DataFrame, base: str, table: str, replaces: Sequence[str] = ()) -> None:
    """S3: write all runs of ``df``; a run that is written again replaces itself, other runs stay.

    ``replaces`` names runs that this write stands for: one without any row in ``df`` is emptied, which an overwrite of the
    partitions in ``df`` alone would not do. Rows are rebalanced by run: small runs end in one file instead of one per
    task, and a run that holds most of the rows is split by size over many tasks (AQE), so no task writes a whole large run.
    """
    write_partitions(typed_records(df, table), base, table, replaces)


def write_partitions(df: DataFrame, base: str, table: str, replaces: Sequence[str] = ()) -> None:
    """The write of :func:`write_runs` for rows of any columns beside ``run_id``."""
    path = os.path.join(base, table)
    laid = with_layout(df)
    named = sorted(set(replaces))
    before = {r: _files(df.sparkSession, base, table, r) for r in named}
    laid.hint("rebalance", F.col("run_id")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(path)
    for run_id in named:  # every write names its files anew, so a folder that holds the same ones got no row
        if before[run_id] and _files(df.sparkSession, base, table, run_id) == before[run_id]:
            drop_run(df.sparkSession, base, table, run_id)


def append_records(df: DataFrame, base: str, table: str, **defaults: Column) -> None:
    """Append rows in the table's schema, filling columns the rows do not have. Rows are rebalanced by run."""
    laid = with_layout(typed_records(df, table, **defaults)).hint("rebalance", F.col("run_id"))
    laid.write.mode("append").partitionBy(*LAYOUT).parquet(os.path.join(base, table))


def typed_records(df: DataFrame, table: str, **defaults: Column) -> DataFrame:
    """Rows cast to the table's schema; missing columns take a default or NULL."""
    def column(f):
        if f.name in df.columns:
            c = F.col(f.name)
            return (F.coalesce(c, defaults[f.name]) if f.name in defaults else c).cast(f.dataType).alias(f.name)
        return defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
    return df.select(*[column(f) for f in schemas.TABLES[table]])


def _path(spark: SparkSession, base: str, table: str):
    return spark._jvm.org.apache.hadoop.fs.Path(os.path.join(base, table))


def _exists(spark: SparkSession, path) -> bool:
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """All runs of a table, with an explicit schema; an empty frame when nothing is stored."""
    schema = schemas.TABLES[table]
    full = schemas.StructType(list(schema.fields)).add("year", schemas.IntegerType()).add("month", schemas.IntegerType())
    if not _exists(spark, _path(spark, base, table)):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(os.path.join(base, table))


def month_of(run_id: str) -> tuple[int, int] | None:
    """Year and month of a run id as :func:`run_date` reads them; None for an id without a date."""
    day = run_id.split("_")[0]
    if not re.fullmatch("[0-9]{8}", day):
        return None
    try:
        return (lambda d: (d.year, d.month))(datetime.strptime(day, "%Y%m%d"))
    except ValueError:
        return None


def read_runs(spark: SparkSession, base: str, table: str, run_ids: Sequence[str]) -> DataFrame:
    """Some runs. Each id brings the predicate of its month (or of no date), so only those folders are listed."""
    by_month: dict = {}
    for run_id in run_ids:
        by_month.setdefault(month_of(run_id), []).append(run_id)
    wanted = F.lit(False)
    for month, ids in by_month.items():
        place = F.col("year").isNull() & F.col("month").isNull() if month is None else (F.col("year") == month[0]) & (F.col("month") == month[1])
        wanted = wanted | (place & F.col("run_id").isin(*ids))
    return read_table(spark, base, table).where(wanted).select(*[f.name for f in schemas.TABLES[table]])


def list_runs(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Run ids, newest first. Folder names alone are read."""
    folders = _path(spark, base, f"{table}/year=*/month=*/run_id=*")
    found = folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders)
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = sorted({plain(f.getPath().getName()[len("run_id="):]) for f in found or ()}, reverse=True)
    return spark.createDataFrame([(n,) for n in names], "run_id string")


def _run_folder(spark: SparkSession, base: str, table: str, run_id: str):
    year, month = month_of(run_id) or ("__HIVE_DEFAULT_PARTITION__",) * 2
    hidden = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    return _path(spark, base, f"{table}/year={year}/month={month}/run_id={hidden}")


def _files(spark: SparkSession, base: str, table: str, run_id: str) -> set[str]:
    """Names in the folder of a run; the rows themselves are not looked at."""
    folder = _run_folder(spark, base, table, run_id)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in system.listStatus(folder)} if system.exists(folder) else set()


def drop_run(spark: SparkSession, base: str, table: str, run_id: str) -> None:
    """Remove the folder of a run; nothing is rewritten."""
    folder = _run_folder(spark, base, table, run_id)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def without_run(df: DataFrame, run_id: str) -> DataFrame:
    """S7 as a transformation: the rows that remain."""
    return df.where(F.col("run_id") != run_id)


def delete_run(spark: SparkSession, base: str, run_id: str, tables: Sequence[str] = tuple(schemas.TABLES)) -> dict[str, int]:
    """Drop one run from stored tables; returns the rows removed per table.

    A run is a folder, so dropping it rewrites nothing.
    """
    removed = {}
    for table in tables:
        removed[table] = read_runs(spark, base, table, [run_id]).count()
        drop_run(spark, base, table, run_id)
    return removed
