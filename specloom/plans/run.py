"""One run from stored pages to reports, as DataFrame stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from specloom import schemas
from specloom.operators import diff, extract, merge, quality, report
from specloom.sources import snapshots


@dataclass
class Inputs:
    pages: DataFrame
    catalog: DataFrame
    hierarchy: DataFrame  # all runs, the previous one is needed for changes
    manual: DataFrame
    runs: DataFrame  # run_id, schedule_type, started_at, ended_at, status


def spec_rows(inputs: Inputs, run_id: str, at: Column, strict_units: bool = False) -> DataFrame:
    """Extract, normalize and merge corrections for one run."""
    catalog = inputs.catalog.where(F.col("run_id") == run_id)
    specs = extract.extract_specs(catalog, inputs.pages, strict_units).withColumn("updated_at", at)
    typed = specs.select(*[F.col(f.name).cast(f.dataType) for f in schemas.SPECS])
    return merge.merge_manual(typed, inputs.manual, run_id, at)


def run_changes(hierarchy: DataFrame, run_id: str) -> DataFrame:
    """U1 of one run: per brand the run and the one before it are read, no others."""
    earlier = hierarchy.where(F.col("run_id") < run_id).groupBy("brand").agg(F.max("run_id").alias("run_id"))
    now = hierarchy.where(F.col("run_id") == run_id)
    # a brand without an earlier run has no changes, and one that isn't in this run wasn't collected
    both = now.select("brand").distinct().join(earlier, "brand")
    before = hierarchy.where(F.col("run_id") < run_id).join(both, ["brand", "run_id"], "left_semi")
    return diff.compare_hierarchies(now.join(both.select("brand"), "brand", "left_semi"), before).withColumn("run_id", F.lit(run_id))


def run_once(spark: SparkSession, run_id: str, inputs: Inputs, base: str, at: Column) -> dict[str, DataFrame]:
    """Write the four snapshot tables of a run under ``base`` and return its report frames.

    Specs are written once and read back, so the rules and reports scan the stored columns instead of parsing
    HTML again, and a lost executor recomputes from storage.
    """
    mine = F.col("run_id") == run_id
    snapshots.write_runs(spec_rows(inputs, run_id, at), base, "specs", [run_id])
    snapshots.write_runs(inputs.catalog.where(mine), base, "catalog", [run_id])
    snapshots.write_runs(inputs.hierarchy.where(mine), base, "hierarchy", [run_id])
    specs = snapshots.read_runs(spark, base, "specs", [run_id])
    catalog = snapshots.read_runs(spark, base, "catalog", [run_id])
    changes = run_changes(inputs.hierarchy, run_id)
    issues = (quality.detect_spec_issues(specs).unionByName(quality.duplicate_models(specs))
              .unionByName(quality.empty_subseries(inputs.hierarchy.where(mine), catalog))
              .unionByName(quality.hierarchy_changed(changes)))
    snapshots.write_runs(quality.export_shape(issues, at), base, "issues", [run_id])
    stored = snapshots.read_runs(spark, base, "issues", [run_id])
    summary = report.run_summary(inputs.runs.where(mine), catalog, specs, stored, changes)
    return {"summary": summary, "issues": stored, "issue_summary": report.issue_summary(stored),
            "coverage": report.coverage(catalog, specs), "report": report.run_report(inputs.runs.where(mine), catalog, specs, stored)}
