"""Data-quality rules (Q1-Q10) and the rule surface."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from specloom import registry as R
from specloom.functions.text import is_blank
from specloom.operators import diff
from specloom.operators.common import natural_key, select_where

KEY = ["run_id", "brand", "series_l1", "series_l2", "product_model"]


@dataclass(frozen=True)
class Rule:
    """A record rule. Condition and detail are column expressions over a spec row.

    ``fields`` limits the rule to some field codes; None means all.
    """
    rule_id: str
    issue_type: str
    severity: str
    condition: Callable[[], Column]
    detail: Callable[[], Column]
    fields: tuple[str, ...] | None = None

    def applies_to(self, field: str) -> bool:
        return self.fields is None or field in self.fields

    def check(self) -> Column:
        """NULL-free truth value for one row."""
        cond = F.coalesce(self.condition(), F.lit(False))
        return cond if self.fields is None else F.col("field_code").isin(*self.fields) & cond


def _confidence() -> Column:
    return F.coalesce(F.col("extract_confidence"), F.lit(1.0))


def missing_field() -> Column:
    """Q1: raw text blank or normalized value missing."""
    return is_blank(F.col("raw_value")) | is_blank(F.col("normalized_value"))


def parse_failed() -> Column:
    """Q2: low confidence, a raw text without a value, or an error marker in the raw text."""
    raw = F.coalesce(F.col("raw_value"), F.lit(""))
    marked = [F.contains(F.upper(raw), F.lit(m)) for m in R.FAILURE_MARKERS]
    return (_confidence() < 0.5) | ((raw != "") & F.col("normalized_value").isNull()) | marked[0] | marked[1] | marked[2]


def unit_abnormal() -> Column:
    """Q3: unit missing or different from the expected one, unless the value failed to parse."""
    unit, expected = F.col("unit"), R.expected_unit(F.col("field_code"))
    allowed = (F.lower(unit) == F.lower(expected)) | ((expected == "fps+px") & unit.isin(*R.FPS_UNITS))
    return (_confidence() >= 0.5) & expected.isNotNull() & (is_blank(unit) | ~allowed)


def _text(template: str, *args: Column) -> Column:
    return F.format_string(template, *args)


RULES: tuple[Rule, ...] = (
    Rule("missing_required_field", R.MISSING_FIELD, "P2", missing_field,
         lambda: _text("Required field '%s' is missing or empty", F.col("field_code")), R.REQUIRED_FIELDS),
    Rule("parse_failed_low_confidence", R.PARSE_FAILED, "P1", parse_failed,
         lambda: _text("Field '%s' parsing failed (confidence: %.2f)", F.col("field_code"), _confidence())),
    Rule("unit_mismatch_expected", R.UNIT_ABNORMAL, "P3", unit_abnormal,
         lambda: _text("Unit '%s' is abnormal or doesn't match expected for field '%s'",
                       F.coalesce("unit", F.lit("None")), F.col("field_code")), tuple(R.UNIT_BY_FIELD)),
)


def get_rules(issue_type: str | None = None, severity: str | None = None, field: str | None = None,
              rules: Iterable[Rule] = RULES) -> list[Rule]:
    """Rules by type, severity and field."""
    return [r for r in rules if (issue_type is None or r.issue_type == issue_type)
            and (severity is None or r.severity == severity) and (field is None or r.applies_to(field))]


def detect_spec_issues(specs: DataFrame, rules: Iterable[Rule] = RULES, severities: Iterable[str] | None = None,
                       **filters: object) -> DataFrame:
    """Q7: all record rules in one pass over the table, one row per violated rule.

    The rules become one array expression, so adding a rule adds no scan and no shuffle.
    """
    chosen = [r for r in rules if severities is None or r.severity in set(severities)]
    found = F.array(*[F.when(r.check(), F.struct(F.lit(r.issue_type).alias("issue_type"), r.detail().alias("issue_detail"),
                                                 F.lit(r.severity).alias("severity"))) for r in chosen])
    return select_where(specs, **filters).select(
        *KEY, "field_code", F.inline(F.filter(found, lambda x: x.isNotNull())))


COPIES = 65536  # equal rows that one step writes out


def duplicate_models(specs: DataFrame, **filters: object) -> DataFrame:
    """Q4: every row of a product field that has conflicting values within its run.

    One aggregate with map-side combine: the values of a key are folded to count, min and max. The rows of a conflicting key are equal in
    all columns asked for, so they are written out from the count, without a second scan or a join back; a key with very many rows is
    first dealt over the tasks in blocks.
    """
    rows = select_where(specs, **filters).where(F.coalesce("field_code", F.lit("")) != "")
    keys = [*KEY, "field_code"]
    value = F.coalesce("normalized_value", F.lit(""))
    conflicts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).where("lo <> hi")
    blocks = conflicts.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))).alias("block")).hint("rebalance")
    left = F.least(F.lit(COPIES), F.col("n") - F.col("block") * COPIES)
    return blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), left))).select(
        *keys, F.lit(R.DUPLICATE_MODEL).alias("issue_type"),
        _text("Model has conflicting values for field '%s'", F.col("field_code")).alias("issue_detail"),
        F.lit("P2").alias("severity"))


def empty_subseries(hierarchy: DataFrame, catalog: DataFrame) -> DataFrame:
    """Q5: issue rows for J10."""
    return diff.empty_subseries(hierarchy, catalog).select(
        "run_id", "brand", "series_l1", "series_l2", F.lit("").alias("product_model"),
        F.lit(None).cast("string").alias("field_code"), F.lit(R.SUBSERIES_EMPTY).alias("issue_type"),
        _text("Subseries '%s' has no products", F.col("series_l2")).alias("issue_detail"), F.lit("P2").alias("severity"))


def hierarchy_changed(changes: DataFrame) -> DataFrame:
    """Q6: issue rows for hierarchy changes."""
    path = F.concat_ws("|", "brand", "series_l1", F.coalesce("series_l2", F.lit("")))
    detail = F.concat(F.when(F.col("change") == "added", "New hierarchy node added: ")
                      .otherwise("Hierarchy node disappeared: "), path)
    return changes.select("run_id", "brand", "series_l1", F.coalesce("series_l2", F.lit("")).alias("series_l2"),
                          F.lit("").alias("product_model"), F.lit(None).cast("string").alias("field_code"),
                          F.lit(R.HIERARCHY_CHANGED).alias("issue_type"), detail.alias("issue_detail"),
                          F.lit("P3").alias("severity"))


def all_issues(specs: DataFrame, hierarchy: DataFrame, catalog: DataFrame,
               severities: Iterable[str] | None = None) -> DataFrame:
    """Q10: every rule over every run present in the tables."""
    out = (detect_spec_issues(specs).unionByName(duplicate_models(specs))
           .unionByName(empty_subseries(hierarchy, catalog))
           .unionByName(hierarchy_changed(diff.hierarchy_changes(hierarchy))))
    return out if severities is None else out.where(F.col("severity").isin(*severities))


def export_shape(issues: DataFrame, created_at: Column) -> DataFrame:
    """Q8: stored issue rows; an empty model becomes NULL."""
    return issues.select("run_id", "brand", "series_l1", "series_l2", F.nullif("product_model", F.lit("")).alias("product_model"),
                         "issue_type", "field_code", "issue_detail", "severity", F.lit("open").alias("status"),
                         F.lit(None).cast("string").alias("owner"), created_at.alias("created_at"))


def issue_key() -> Column:
    """Row identity of an issue: a digest of its natural key, in which NULL is a value like any other."""
    return natural_key("run_id", "brand", "series_l1", "series_l2", "product_model", "issue_type", "field_code", "issue_detail")


def update_issues(issues: DataFrame, updates: DataFrame) -> DataFrame:
    """Q9: new status and owner by issue key; updates(issue_key, status, owner, updated_at).

    The last update of an issue counts as a whole (ties: the larger status, then owner); a NULL in it keeps the old value.
    """
    u = updates.groupBy("issue_key").agg(F.max(F.struct("updated_at", "status", "owner")).alias("update"))
    rows = issues.withColumn("issue_key", issue_key()).join(u, "issue_key", "left")
    return rows.withColumns({"status": F.coalesce("update.status", "status"), "owner": F.coalesce("update.owner", "owner")}
                            ).select(*issues.columns)


def batch_update_status(issues: DataFrame, run_id: str, issue_type: str, status: str) -> DataFrame:
    hit = (F.col("run_id") == run_id) & (F.col("issue_type") == issue_type)
    return issues.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))
