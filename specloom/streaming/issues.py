"""Incremental quality checks on arriving snapshot files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from specloom.operators.common import null_safe_join
from specloom.operators.quality import detect_spec_issues


def issue_counts_stream(specs: DataFrame, target: str, checkpoint: str, delivery: str | None = None):
    """Rules over each arriving micro-batch, counted per run, delivery, type and severity.

    ``delivery`` names a column that all rows of one delivery of a run share and that is larger for a later one (a time, a
    number). A delivery may be split over any number of micro-batches. Without it a run arrives in one micro-batch, as ``write_runs``
    publishes it, and every batch is a delivery. A batch is written to its own folder, so a batch that is run again after
    a failure replaces itself; a row without type marks every run and delivery of a batch, so that a run which arrives again
    without issues replaces its old counts too. Returns the started query.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        name = F.col(delivery).cast("string") if delivery else F.format_string("%019d", F.lit(batch_id))
        runs = batch.withColumn("run_id", F.to_json(F.struct("run_id", name.alias("delivery"))))  # the rules carry the run id through
        counts = detect_spec_issues(runs).groupBy("run_id", "issue_type", "severity").agg(F.count("*").alias("n"))
        marks = runs.select("run_id").distinct().select("run_id", F.lit(None).cast("string").alias("issue_type"),
                                                        F.lit(None).cast("string").alias("severity"), F.lit(0).cast("long").alias("n"))
        counts.unionByName(marks).select(F.from_json("run_id", "run_id string, delivery string").alias("of"), "issue_type", "severity", "n").select(
            "of.*", "issue_type", "severity", "n").write.mode("overwrite").parquet(os.path.join(target, f"batch={batch_id}"))

    return specs.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def issue_counts(spark, target: str) -> DataFrame:
    """Counts of each run's last delivery, added up over its batches: a run that was delivered again counts once.

    Deliveries are compared as texts, numbers by their value. A NULL delivery is older than any other.
    """
    rows = spark.read.parquet(target)
    order = lambda c: F.struct(F.try_to_number(c, F.lit("9" * 19)).alias("number"), c.alias("text"))
    last = rows.groupBy("run_id").agg(F.max_by(F.struct("delivery"), order(F.col("delivery"))).alias("last"))
    rows = null_safe_join(rows, last.select("run_id", "last.delivery"), ["run_id", "delivery"], "left_semi").where("issue_type IS NOT NULL")
    return rows.groupBy("run_id", "issue_type", "severity").agg(F.sum("n").alias("n"))


def event_rate(events: DataFrame, time: str, key: str, kind: str, lateness: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """R2: events per tumbling window and kind; re-delivered keys and events later than ``lateness`` are dropped.

    State is bounded by the watermark: keys and windows older than it are forgotten.
    """
    once = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])
    return once.groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), kind, "n")


def run_to_table(stream: DataFrame, target: str, checkpoint: str, mode: str = "update"):
    """Write each micro-batch of a streaming aggregate to its own folder under ``target``."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(target, f"batch={batch_id}"))

    return stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def last_state(spark, target: str, *keys: str) -> DataFrame:
    """The newest row per key over all written batches (update mode rewrites a key in later batches)."""
    from specloom.operators.common import latest
    return latest(spark.read.parquet(target), list(keys), F.desc("batch")).drop("batch")
