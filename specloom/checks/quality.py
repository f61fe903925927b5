"""Checks of the filters and quality rules."""

from pyspark.sql import functions as F

from specloom.checks.base import check
from specloom.operators import diff, quality, report, select
from specloom.operators.common import problems  # noqa: F401

RUN, BRAND = "19960101_monthly_01", "Brand#12"
BLANK = lambda c: f"coalesce(trim({c}), '') = ''"
MISSING = f"({BLANK('raw_value')} OR {BLANK('normalized_value')})"
FAILED = ("(extract_confidence < 0.5 OR (coalesce(raw_value, '') <> '' AND normalized_value IS NULL) "
          "OR upper(coalesce(raw_value, '')) LIKE '%ERROR:%' OR upper(coalesce(raw_value, '')) LIKE '%PARSE_FAILED:%' "
          "OR upper(coalesce(raw_value, '')) LIKE '%N/A%')")
EXPECTED = ("CASE field_code WHEN 'max_resolution' THEN 'px' WHEN 'aperture' THEN 'f' WHEN 'supplement_light_range' THEN 'm' "
            "WHEN 'main_stream_max_fps_resolution' THEN 'fps+px' WHEN 'stream_count' THEN 'count' "
            "WHEN 'approval_protection' THEN 'grade' WHEN 'approval_anti_corrosion_protection' THEN 'grade' END")
ABNORMAL = (f"(extract_confidence >= 0.5 AND {EXPECTED} IS NOT NULL AND ({BLANK('unit')} OR (lower(unit) <> {EXPECTED} "
            f"AND NOT ({EXPECTED} = 'fps+px' AND unit IN ('fps', 'px', 'fps+px')))))")
KEYS = "run_id, brand, series_l1, series_l2, product_model"
RECORD_ISSUES = f"""
  SELECT {KEYS}, field_code, 'missing_field' AS issue_type,
         'Required field ''' || field_code || ''' is missing or empty' AS issue_detail, 'P2' AS severity
  FROM specs WHERE {MISSING}
  UNION ALL
  SELECT {KEYS}, field_code, 'parse_failed',
         'Field ''' || field_code || ''' parsing failed (confidence: ' || printf('%.2f', extract_confidence) || ')', 'P1'
  FROM specs WHERE {FAILED}
  UNION ALL
  SELECT {KEYS}, field_code, 'unit_abnormal',
         'Unit ''' || coalesce(unit, 'None') || ''' is abnormal or doesn''t match expected for field ''' || field_code || '''', 'P3'
  FROM specs WHERE {ABNORMAL}"""
DUPLICATES = f"""
  SELECT s.* FROM (SELECT {KEYS}, field_code, 'duplicate_model' AS issue_type,
         'Model has conflicting values for field ''' || field_code || '''' AS issue_detail, 'P2' AS severity,
         count(DISTINCT coalesce(normalized_value, '')) OVER (PARTITION BY {KEYS}, field_code) AS n FROM specs) AS s"""
EMPTY = """
  SELECT h.run_id, h.brand, h.series_l1, h.series_l2 FROM
    (SELECT DISTINCT run_id, brand, series_l1, series_l2 FROM {h} WHERE series_l2 IS NOT NULL) AS h
  WHERE NOT EXISTS (SELECT 1 FROM {c} AS c WHERE c.run_id = h.run_id AND c.brand = h.brand AND c.series_l1 = h.series_l1
                    AND c.series_l2 = h.series_l2)"""
PATHS = """
  p AS (SELECT DISTINCT run_id, brand, series_l1, '' AS series_l2 FROM hierarchy WHERE coalesce(series_l1, '') <> ''
        UNION SELECT DISTINCT run_id, brand, series_l1, series_l2 FROM hierarchy WHERE coalesce(series_l2, '') <> ''),
  r AS (SELECT brand, run_id, lag(run_id) OVER (PARTITION BY brand ORDER BY run_id) AS prev
        FROM (SELECT DISTINCT brand, run_id FROM hierarchy) AS d),
  ch AS (
    SELECT p.run_id, p.brand, p.series_l1, p.series_l2, 'added' AS change FROM p JOIN r USING (brand, run_id)
    WHERE r.prev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p AS q WHERE q.run_id = r.prev AND q.brand = p.brand
      AND q.series_l1 = p.series_l1 AND q.series_l2 = p.series_l2)
    UNION ALL
    SELECT r.run_id, p.brand, p.series_l1, p.series_l2, 'removed' FROM p JOIN r ON r.prev = p.run_id AND r.brand = p.brand
    WHERE NOT EXISTS (SELECT 1 FROM p AS q WHERE q.run_id = r.run_id AND q.brand = p.brand
      AND q.series_l1 = p.series_l1 AND q.series_l2 = p.series_l2))"""
CHANGED = """
  SELECT run_id, brand, series_l1, series_l2, '' AS product_model, CAST(NULL AS VARCHAR) AS field_code,
         'hierarchy_changed' AS issue_type,
         CASE change WHEN 'added' THEN 'New hierarchy node added: ' ELSE 'Hierarchy node disappeared: ' END
           || brand || '|' || series_l1 || '|' || series_l2 AS issue_detail, 'P3' AS severity FROM ch"""


# --- rules -----------------------------------------------------------------------------------------

for _name, _type in (("Q1_missing_field", "missing_field"), ("Q2_parse_failed", "parse_failed"), ("Q3_unit_abnormal", "unit_abnormal")):
    check(_name, f"SELECT * FROM ({RECORD_ISSUES}) AS i WHERE issue_type = '{_type}'", "specs")(
        lambda t, _type=_type: quality.detect_spec_issues(t.specs, quality.get_rules(issue_type=_type)))

check("Q4_duplicate_model", f"SELECT {KEYS}, field_code, issue_type, issue_detail, severity FROM ({DUPLICATES}) AS d WHERE n > 1",
      "specs")(lambda t: quality.duplicate_models(t.specs))


@check("Q5_subseries_empty", f"""SELECT run_id, brand, series_l1, series_l2, '' AS product_model, CAST(NULL AS VARCHAR) AS field_code,
  'subseries_empty' AS issue_type, 'Subseries ''' || series_l2 || ''' has no products' AS issue_detail, 'P2' AS severity
  FROM ({EMPTY.format(h='hierarchy', c="catalog")}) AS e""", "hierarchy", "catalog")
def _(t):
    return quality.empty_subseries(t.hierarchy, t.catalog)


check("Q6_hierarchy_changed", f", {PATHS} {CHANGED}", "hierarchy")(
    lambda t: quality.hierarchy_changed(diff.hierarchy_changes(t.hierarchy)))
check("Q7_rule_engine", RECORD_ISSUES, "specs")(lambda t: quality.detect_spec_issues(t.specs))
check("Q7_severity_filter", f"SELECT * FROM ({RECORD_ISSUES}) AS i WHERE severity IN ('P1', 'P3') AND brand = '{BRAND}'", "specs")(
    lambda t: quality.detect_spec_issues(t.specs, severities=("P1", "P3"), brand=BRAND))


@check("Q8_export_shape", f"""SELECT {KEYS.replace('product_model', "nullif(product_model, '') AS product_model")}, field_code, issue_type,
  issue_detail, severity, 'open' AS status, CAST(NULL AS VARCHAR) AS owner, TIMESTAMP '2002-01-01 00:00:00' AS created_at
  FROM ({RECORD_ISSUES}) AS i""", "specs")
def _(t):
    return quality.export_shape(quality.detect_spec_issues(t.specs), F.lit("2002-01-01 00:00:00").cast("timestamp"))


@check("Q9_issue_workflow", """SELECT run_id, brand, series_l1, series_l2, product_model, issue_type, field_code, issue_detail, severity,
  CASE WHEN severity = 'P1' THEN 'ignored' ELSE status END AS status,
  CASE WHEN severity = 'P1' AND product_model IS NOT NULL THEN 'clerk of ' || product_model ELSE owner END AS owner, created_at
  FROM issues""", "issues")
def _(t):
    # every critical issue is resolved by the owner of its model and ignored by a clerk a day later: the last one counts
    critical = t.issues.where("severity = 'P1'").select(quality.issue_key().alias("issue_key"), "product_model")
    update = lambda status, who, day: critical.select(
        "issue_key", F.lit(status).alias("status"), F.concat(F.lit(who), "product_model").alias("owner"),
        F.lit(day).cast("timestamp").alias("updated_at"))
    updates = update("resolved", "owner of ", "2002-01-01").unionByName(update("ignored", "clerk of ", "2002-01-02"))
    return quality.update_issues(t.issues, updates)


@check("Q9_null_keys", """SELECT product_model, series_l2, CASE WHEN series_l2 IS NULL THEN 'resolved' ELSE 'open' END AS status FROM (
  SELECT CAST(NULL AS VARCHAR) AS series_l2, 'M' || p_partkey AS product_model FROM part UNION ALL SELECT 'M' || p_partkey, CAST(NULL AS VARCHAR) FROM part) AS i""")
def _(t):
    # two issues whose keys differ only in which column is NULL
    name, none = F.concat(F.lit("M"), F.col("p_partkey").cast("string")), F.lit(None).cast("string")
    rows = t.part.select(none.alias("series_l2"), name.alias("product_model")).unionByName(t.part.select(name.alias("series_l2"), none.alias("product_model")))
    issues = rows.select(*[F.lit("x").alias(c) for c in ("run_id", "brand", "series_l1")], "series_l2", "product_model",
                         *[F.lit("y").alias(c) for c in ("issue_type", "field_code", "issue_detail")], F.lit("open").alias("status"), none.alias("owner"))
    updates = issues.where("series_l2 IS NULL").select(quality.issue_key().alias("issue_key"), F.lit("resolved").alias("status"), none.alias("owner"),
                                                        F.current_timestamp().alias("updated_at"))
    return quality.update_issues(issues, updates).select("product_model", "series_l2", "status")


@check("Q9_batch_status", f"""SELECT status, issue_type, run_id, count(*) AS n FROM (SELECT run_id, issue_type,
  CASE WHEN run_id = '{RUN}' AND issue_type = 'unit_abnormal' THEN 'ignored' ELSE status END AS status FROM issues) AS i
  GROUP BY status, issue_type, run_id""", "issues")
def _(t):
    return quality.batch_update_status(t.issues, RUN, "unit_abnormal", "ignored").groupBy("status", "issue_type", "run_id").agg(
        F.count("*").alias("n"))


@check("Q10_all_rules", f""", {PATHS}, a AS (
  SELECT run_id, issue_type, severity FROM ({RECORD_ISSUES}) AS i
  UNION ALL SELECT run_id, issue_type, severity FROM ({DUPLICATES}) AS d WHERE n > 1
  UNION ALL SELECT run_id, 'subseries_empty', 'P2' FROM ({EMPTY.format(h='hierarchy', c="catalog")}) AS e
  UNION ALL SELECT run_id, issue_type, severity FROM ({CHANGED}) AS c)
  SELECT run_id, issue_type, severity, count(*) AS n FROM a GROUP BY run_id, issue_type, severity""", "specs", "hierarchy", "catalog")
def _(t):
    return quality.all_issues(t.specs, t.hierarchy, t.catalog).groupBy("run_id", "issue_type", "severity").agg(
        F.count("*").alias("n"))


@check("E1_user_rule", f"""SELECT {KEYS}, field_code, 'long_value' AS issue_type, 'Value has ' || cast(length(raw_value) AS VARCHAR)
  || ' characters' AS issue_detail, 'P3' AS severity FROM specs
  WHERE field_code IN ('image_sensor', 'lens_type') AND length(raw_value) > 20
  UNION ALL SELECT {KEYS}, field_code, issue_type, issue_detail, severity FROM ({RECORD_ISSUES}) AS i WHERE severity = 'P2'""", "specs")
def _(t):
    own = quality.Rule("long_value", "long_value", "P3", lambda: F.length("raw_value") > 20,
                       lambda: F.format_string("Value has %d characters", F.length("raw_value")), ("image_sensor", "lens_type"))
    return quality.detect_spec_issues(t.specs, [*quality.get_rules(severity="P2"), own])


# --- filters ---------------------------------------------------------------------------------------

SPEC = "run_id, brand, series_l1, series_l2, product_model, field_code, raw_value"
_spec = lambda df: df.select(*SPEC.split(", "))
ISSUE = "run_id, brand, product_model, issue_type, field_code, severity, status, owner"
_issue = lambda df: df.select(*ISSUE.split(", "))

check("F1_key_filters", f"""SELECT {SPEC} FROM specs WHERE run_id = '{RUN}' AND brand = '{BRAND}' AND series_l1 = 'PROMO'
  AND field_code = 'max_resolution'""", "specs")(
    lambda t: _spec(select.select_run(t.specs, run_id=RUN, brand=BRAND, series_l1="PROMO", field_code="max_resolution")))
check("F2_issue_filters", f"""SELECT {ISSUE} FROM issues WHERE run_id = '{RUN}' AND severity = 'P1' AND status = 'open'
  AND issue_type = 'parse_failed' AND owner = 'owner text'""", "issues")(
    lambda t: _issue(select.select_issues(t.issues, run_id=RUN, severity="P1", status="open", issue_type="parse_failed",
                                          owner="owner text")))
check("F2_critical_issues", f"SELECT {ISSUE} FROM issues WHERE severity = 'P1'", "issues")(lambda t: _issue(select.critical_issues(t.issues)))
check("F3_open_issues", f"SELECT {ISSUE} FROM issues WHERE status = 'open' AND severity IN ('P1', 'P2')", "issues")(
    lambda t: _issue(select.open_issues(t.issues, min_severity="P2")))
check("F4_low_confidence", f"SELECT {SPEC} FROM specs WHERE extract_confidence < 0.7", "specs")(
    lambda t: _spec(select.low_confidence(t.specs)))
check("F5_overridden", f"SELECT {SPEC} FROM specs WHERE is_manual_override", "specs")(lambda t: _spec(select.overridden(t.specs)))
check("F6_rule_filters", f"SELECT * FROM ({RECORD_ISSUES}) AS i WHERE brand = '{BRAND}' AND series_l1 = 'PROMO'", "specs")(
    lambda t: quality.detect_spec_issues(t.specs, brand=BRAND, series_l1="PROMO"))
CAT = "run_id, brand, series_l1, series_l2, product_model, locale"
_cat = lambda df: df.select(*CAT.split(", "))
check("F7_series_allowlist", f"SELECT {CAT} FROM catalog WHERE series_l1 ILIKE '%promo%' OR series_l1 ILIKE '%med%'", "catalog")(
    lambda t: _cat(select.allowed_catalog(t.catalog, ["Promo", "med"])))
check("F8_valid_models", f"""SELECT {CAT} FROM catalog WHERE length(trim(product_model)) BETWEEN 5 AND 50
  AND (regexp_matches(product_model, '(?i)^DS-?2CD') OR (regexp_matches(product_model, '[A-Za-z]') AND regexp_matches(product_model, '[0-9]')))""",
      "catalog")(lambda t: _cat(select.valid_models(t.catalog)))


@check("F9_incomplete_catalog", """SELECT run_id, brand, product_model, locale, problem FROM (
  SELECT *, unnest(list_filter([CASE WHEN coalesce(brand, '') = '' THEN 'Missing brand' END,
    CASE WHEN coalesce(series_l1, '') = '' THEN 'Missing series_l1' END, CASE WHEN coalesce(series_l2, '') = '' THEN 'Missing series_l2' END,
    CASE WHEN coalesce(product_model, '') = '' THEN 'Missing model' END, CASE WHEN coalesce(product_url, '') = '' THEN 'Missing URL' END,
    CASE WHEN coalesce(product_name, '') = '' THEN 'Missing name' END,
    CASE WHEN product_url <> '' AND NOT regexp_matches(product_url, '^https?://') THEN 'Invalid URL format' END],
    lambda x: x IS NOT NULL)) AS problem FROM catalog) AS q""", "catalog")
def _(t):
    return select.incomplete_catalog(t.catalog).select("run_id", "brand", "product_model", "locale", "problem")


check("F10_incomplete_hierarchy", """SELECT run_id, brand, CAST(NULL AS VARCHAR) AS series_l1, 'no L1 series' AS problem FROM hierarchy
  GROUP BY run_id, brand HAVING sum(CASE WHEN series_l2 IS NULL THEN 1 ELSE 0 END) = 0
  UNION ALL SELECT run_id, brand, series_l1, 'no L2 subseries' FROM hierarchy GROUP BY run_id, brand, series_l1
  HAVING sum(CASE WHEN series_l2 IS NULL THEN 1 ELSE 0 END) > 0 AND count(series_l2) = 0""", "hierarchy")(
    lambda t: select.incomplete_hierarchy(t.hierarchy))
check("F11_manual_inputs", """SELECT input_id, field_code, manual_value, created_at FROM manual WHERE brand = 'Brand#12'
  AND series_l1 = 'PROMO'""", "manual")(
    lambda t: select.manual_for_series(t.manual, "Brand#12", "PROMO").select("input_id", "field_code", "manual_value", "created_at"))
check("F12_series_levels", """SELECT brand, series_l1, CAST(NULL AS VARCHAR) AS series_l2 FROM hierarchy GROUP BY brand, series_l1
  UNION ALL SELECT brand, series_l1, series_l2 FROM hierarchy WHERE series_l2 IS NOT NULL GROUP BY brand, series_l1, series_l2""",
      "hierarchy")(
    lambda t: select.series_l1(t.hierarchy).withColumn("series_l2", F.lit(None).cast("string")).unionByName(select.series_l2(t.hierarchy)))
check("F12_hierarchy_node", f"""SELECT run_id, brand, series_l1, series_l2, series_status FROM hierarchy
  WHERE run_id = '{RUN}' AND brand = '{BRAND}' AND series_l1 = 'PROMO' AND series_l2 IS NULL""", "hierarchy")(
    lambda t: select.hierarchy_node(t.hierarchy, RUN, BRAND, "PROMO", None).select(
        "run_id", "brand", "series_l1", "series_l2", "series_status"))


# --- issue counts ----------------------------------------------------------------------------------

def summary_sql(source: str, *dims: str) -> str:
    parts = [f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS n FROM {source} GROUP BY {d}" for d in dims]
    return " UNION ALL ".join([*parts, f"SELECT 'total', CAST(NULL AS VARCHAR), count(*) FROM {source}"])


check("A6_issue_summary", summary_sql(f"({RECORD_ISSUES})", "severity", "issue_type", "field_code"), "specs")(
    lambda t: report.issue_summary(quality.detect_spec_issues(t.specs), "severity", "issue_type", "field_code"))
check("A6_stored_issue_summary", summary_sql("issues", "severity", "issue_type", "status"), "issues")(
    lambda t: report.issue_summary(t.issues))
check("A7_detection_statistics", summary_sql("issues", "issue_type", "severity", "brand"), "issues")(
    lambda t: report.issue_summary(t.issues, "issue_type", "severity", "brand"))
