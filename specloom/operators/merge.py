"""Human corrections and upserts: manual wins, last write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from specloom import registry as R
from specloom.operators.common import latest, null_safe_join

MATCH = ["product_model", "field_code"]
FULL = ["brand", "series_l1", "series_l2", "product_model", "field_code"]
NEWEST = lambda: (F.desc("created_at"), F.desc("input_id"))


def latest_manual(manual: DataFrame, keys: list[str] = FULL) -> DataFrame:
    """The last correction per key, by time and then id."""
    return latest(manual, keys, *NEWEST())


def usable_manual(manual: DataFrame) -> DataFrame:
    """Corrections with a brand and a first level; the rest cannot be merged."""
    return manual.where((F.coalesce("brand", F.lit("")) != "") & (F.coalesce("series_l1", F.lit("")) != ""))


def _present(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``wanted`` that occur in ``rows``: at most as many as wanted, so the large table stays put
    when the wanted keys are small enough to broadcast."""
    return rows.select(*keys).join(wanted.select(*keys), keys, "left_semi").distinct()


def merge_manual(specs: DataFrame, manual: DataFrame, run_id: str, merged_at: Column) -> DataFrame:
    """Specs of one run with the corrections applied; unmatched corrections become new rows.

    All rows of a corrected (model, field) take the value. ``specs`` is only joined, never grouped: the
    corrections are the small side, and whether they are broadcast is left to their measured size.
    """
    rows = specs.where(F.col("run_id") == run_id)
    usable = usable_manual(manual)
    named = latest_manual(usable.where("product_model IS NOT NULL"), MATCH)
    unnamed = usable.where("product_model IS NULL")
    m = named.select(*MATCH, F.col("manual_value").alias("_value"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    matched = rows.join(m, MATCH, "left").withColumns({
        "raw_value": F.when(hit, F.col("_value")).otherwise(F.col("raw_value")),
        "normalized_value": F.when(hit, F.col("_value")).otherwise(F.col("normalized_value")),
        "extract_confidence": F.when(hit, 1.0).otherwise(F.col("extract_confidence")),
        "is_manual_override": F.when(hit, True).otherwise(F.col("is_manual_override")),
        "updated_at": F.when(hit, merged_at).otherwise(F.col("updated_at")),
    }).select(*specs.columns)
    extra = named.join(_present(rows, named, MATCH), MATCH, "left_anti").unionByName(unnamed)
    new = extra.select(
        F.lit(run_id).alias("run_id"), "brand", "series_l1", "series_l2",
        F.coalesce(F.nullif("product_model", F.lit("")), F.lit("MANUAL_INPUT")).alias("product_model"), "field_code",
        F.col("field_code").alias("field_name"), F.col("manual_value").alias("raw_value"),
        F.col("manual_value").alias("normalized_value"), F.lit(None).cast("string").alias("unit"),
        F.lit("string").alias("value_type"), F.lit("MANUAL_INPUT").alias("source_url"),
        F.lit(1.0).alias("extract_confidence"), F.lit(True).alias("is_manual_override"), merged_at.alias("updated_at"))
    return matched.unionByName(new, allowMissingColumns=True)


def merge_counts(specs: DataFrame, manual: DataFrame, run_id: str) -> DataFrame:
    """J3 counts: corrections read, applied as overrides, added as new rows, not mergeable."""
    keys = specs.where(F.col("run_id") == run_id).select(*MATCH).distinct().withColumn("_in_run", F.lit(1))
    usable = (F.coalesce("brand", F.lit("")) != "") & (F.coalesce("series_l1", F.lit("")) != "")
    m = manual.select(*MATCH, usable.alias("ok")).groupBy(*MATCH, "ok").agg(F.count("*").alias("n")).join(keys, MATCH, "left")
    n, ok, inside = F.col("n"), F.col("ok"), F.col("_in_run").isNotNull()
    named = F.col("product_model").isNotNull()
    # after its first insert a repeated key finds its own row, so only one insert per key is counted
    added = F.when(ok & ~inside, F.when(named, 1).otherwise(n)).otherwise(0)
    return m.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("manual_inputs_count"),
                 F.coalesce(F.sum(F.when(ok, n - added).otherwise(0)), F.lit(0)).alias("overrides_applied"),
                 F.coalesce(F.sum(added), F.lit(0)).alias("new_products_added"),
                 F.coalesce(F.sum(F.when(~ok, n).otherwise(0)), F.lit(0)).alias("import_errors"))


def override_status(specs: DataFrame, manual: DataFrame, run_id: str) -> DataFrame:
    """J4 report: each correction with 'applied' or 'skipped' for a run, on the full key (NULL equals NULL)."""
    keys = specs.where(F.col("run_id") == run_id).select(*FULL).distinct().withColumn("_in_run", F.lit(1))
    hit = F.col("_in_run").isNotNull()
    return null_safe_join(manual, keys, FULL, "left").select(
        "input_id", "brand", "product_model", "field_code", F.when(hit, "applied").otherwise("skipped").alias("status"),
        F.when(~hit, "No matching spec record found").alias("reason"))


def apply_overrides(specs: DataFrame, manual: DataFrame, run_id: str, merged_at: Column) -> DataFrame:
    """Corrections on the full key, matching rows only; confidence is left as it is."""
    m = latest_manual(manual).select(*FULL, F.col("manual_value").alias("_value"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    rows = null_safe_join(specs.where(F.col("run_id") == run_id), m, FULL, "left")
    return rows.withColumns({
        "raw_value": F.when(hit, F.col("_value")).otherwise(F.col("raw_value")),
        "normalized_value": F.when(hit, F.col("_value")).otherwise(F.col("normalized_value")),
        "is_manual_override": F.when(hit, True).otherwise(F.col("is_manual_override")),
        "updated_at": F.when(hit, merged_at).otherwise(F.col("updated_at")),
    }).select(*specs.columns)


def audit_trail(merged: DataFrame, before: DataFrame, manual: DataFrame, run_id: str) -> DataFrame:
    """Overridden rows of a run with who changed them and the value before the merge."""
    m = latest_manual(manual).select(*FULL, "input_id", "manual_value", "operator", "reason", "created_at")
    old = before.where(F.col("run_id") == run_id).groupBy(*FULL).agg(
        F.max(F.struct("updated_at", "normalized_value")).alias("o")).select(*FULL, F.col("o.normalized_value").alias("previous_value"))
    done = merged.where((F.col("run_id") == run_id) & F.col("is_manual_override")).select("run_id", *FULL).distinct()
    named = null_safe_join(done, m, FULL, "inner").select("run_id", *FULL, "input_id", "manual_value", "operator", "reason", "created_at")
    return null_safe_join(named, old, FULL, "left").select(
        "run_id", *FULL, "previous_value", "manual_value", "operator", "reason", "created_at")


def revert_override(specs: DataFrame, before: DataFrame, run_id: str, brand: str, model: str, field: str) -> DataFrame:
    """Flag off again; the value comes back from the rows before the merge."""
    keys = ["run_id", *FULL]
    target = ((F.col("run_id") == run_id) & (F.col("brand") == brand) & (F.col("product_model") == model)
              & (F.col("field_code") == field))
    old = before.where(target).groupBy(*keys).agg(
        F.max(F.struct("updated_at", "raw_value", "normalized_value", "extract_confidence")).alias("o"))
    # the few rows of the product field are mended and put back; no other row is joined
    hit = F.coalesce(target & F.col("is_manual_override"), F.lit(False))
    back = lambda c: F.when(F.col("o").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(c))
    mended = null_safe_join(specs.where(hit), old, keys, "left").withColumns({
        "raw_value": back("raw_value"), "normalized_value": back("normalized_value"),
        "extract_confidence": back("extract_confidence"), "is_manual_override": F.lit(False)})
    return mended.select(*specs.columns).unionByName(specs.where(~hit))


def without_manual(manual: DataFrame, brand: str, model: str, field: str) -> DataFrame:
    """The corrections left after a revert."""
    gone = (F.col("brand") == brand) & (F.col("product_model") == model) & (F.col("field_code") == field)
    return manual.where(~F.coalesce(gone, F.lit(False)))


def upsert_specs(existing: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """Updates replace values by (run, model, field), the last one by ``order``; others are appended.

    A replaced row keeps its place in the hierarchy and its override flag.
    """
    keys = ["run_id", *MATCH]
    values = ["raw_value", "normalized_value", "unit", "value_type", "source_url", "extract_confidence", "updated_at"]
    new = latest(updates, keys, F.desc(order), F.desc("raw_value"))
    u = new.select(*keys, F.struct(*values).alias("_u"))
    hit = F.col("_u").isNotNull()
    kept = existing.join(u, keys, "left").withColumns(
        {c: F.when(hit, F.col(f"_u.{c}")).otherwise(F.col(c)) for c in values}).select(*existing.columns)
    added = new.join(_present(existing, new, keys), keys, "left_anti").select(
        *[c if c in new.columns else F.lit(None).alias(c) for c in existing.columns])
    return kept.unionByName(added)


def check_manual_rows(rows: DataFrame, row_no: str = "row_no") -> DataFrame:
    """Adds ``missing`` (blank required columns) and ``error``; rows that are blank throughout are dropped."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    missing = F.filter(F.array(*[F.when(empty(c), F.lit(c)) for c in R.MANUAL_SHEET]), lambda x: x.isNotNull())
    listed = F.concat(F.lit("['"), F.array_join(missing, "', '"), F.lit("']"))
    return rows.withColumn("missing", missing).where(F.size("missing") < len(R.MANUAL_SHEET)).withColumn(
        "error", F.when(F.size("missing") > 0, F.concat(F.lit("Row "), F.col(row_no).cast("string"),
                                                        F.lit(": Missing required fields: "), listed)))


