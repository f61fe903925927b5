"""Checks of counts, coverage, comparisons between runs and reports."""

from pyspark.sql import functions as F

from specloom import registry as R
from specloom.checks.base import check
from specloom.checks.quality import CHANGED, EMPTY, PATHS, RECORD_ISSUES
from specloom.operators import diff, quality, report, select

BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
FIELD_LIST = ", ".join(f"'{c}'" for c in R.FIELD_CODES)

# --- counts ----------------------------------------------------------------------------------------

check("A1_counts", "SELECT run_id, brand, count(*) AS n FROM specs GROUP BY run_id, brand", "specs")(
    lambda t: report.counts(t.specs, "run_id", "brand"))
check("A1_table_counts", """SELECT 'catalog' AS table_name, count(*) AS n FROM catalog UNION ALL SELECT 'specs', count(*) FROM specs
  UNION ALL SELECT 'hierarchy', count(*) FROM hierarchy UNION ALL SELECT 'manual', count(*) FROM manual""",
      "specs", "catalog", "hierarchy", "manual")(
    lambda t: report.table_counts(catalog=t.catalog, specs=t.specs, hierarchy=t.hierarchy, manual=t.manual))
check("A2_distinct_models", """SELECT brand, series_l1, series_l2, count(DISTINCT product_model) AS models,
  CASE grouping(brand, series_l1, series_l2) WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS level
  FROM catalog GROUP BY ROLLUP (brand, series_l1, series_l2)""", "catalog")(lambda t: report.distinct_models(t.catalog))
check("A3_coverage", """, c AS (SELECT brand, count(DISTINCT product_model) AS catalog_models FROM catalog GROUP BY brand),
  s AS (SELECT brand, count(DISTINCT product_model) AS spec_models FROM specs AS o GROUP BY brand),
  j AS (SELECT c.brand, catalog_models, coalesce(spec_models, 0) AS spec_models FROM c LEFT JOIN s ON c.brand = s.brand)
  SELECT brand, cast(sum(catalog_models) AS BIGINT) AS catalog_models, cast(sum(spec_models) AS BIGINT) AS spec_models,
         cast(sum(spec_models) AS BIGINT) * 100 / cast(cast(sum(catalog_models) AS BIGINT) AS DOUBLE) AS coverage_pct
  FROM j GROUP BY GROUPING SETS ((brand), ())""", "catalog", "specs")(
    lambda t: report.coverage(t.catalog, t.specs))
check("A4_field_coverage", "SELECT f.field_code, " + ", ".join(f"coalesce(cast(sum((brand = '{b}')::INT) AS BIGINT), 0) AS \"{b}\"" for b in BRANDS)
      + f", count(s.brand) AS total FROM (SELECT unnest([{FIELD_LIST}]) AS field_code) AS f LEFT JOIN specs AS s USING (field_code) GROUP BY 1",
      "specs")(lambda t: report.field_coverage(t.specs, BRANDS))
check("A5_average_fields", """SELECT brand, count(*) AS products, cast(sum(n) AS BIGINT) AS records, avg(fields) AS avg_fields FROM (
  SELECT brand, product_model, count(DISTINCT field_code) AS fields, count(*) AS n FROM specs GROUP BY brand, product_model) AS p
  GROUP BY brand""", "specs")(lambda t: report.average_fields(t.specs))
check("A8_field_statistics", f"""SELECT p.run_id, c.field_code, coalesce(n, 0) AS n, products - coalesce(with_field, 0) AS missing FROM (
  SELECT run_id, count(DISTINCT product_model) AS products FROM specs GROUP BY run_id) AS p CROSS JOIN (SELECT unnest([{FIELD_LIST}]) AS field_code) AS c
  LEFT JOIN (SELECT run_id, field_code, count(*) AS n, count(DISTINCT product_model) AS with_field FROM specs GROUP BY run_id, field_code) AS f
  ON f.run_id = p.run_id AND f.field_code = c.field_code""", "specs")(
    lambda t: report.field_statistics(t.specs))

SUMMARY = f""", {PATHS}, i AS ({RECORD_ISSUES}),
  c AS (SELECT run_id, count(*) AS catalog_count, count(DISTINCT brand || '/' || product_model) AS models FROM catalog GROUP BY run_id),
  s AS (SELECT run_id, count(*) AS spec_field_count, count(DISTINCT brand || '/' || product_model) AS with_specs FROM specs GROUP BY run_id),
  q AS (SELECT run_id, count(*) AS issue_count, count(DISTINCT product_model) AS failed FROM i GROUP BY run_id),
  h AS (SELECT run_id, cast(sum((change = 'added')::INT) AS BIGINT) AS added, cast(sum((change = 'removed')::INT) AS BIGINT) AS removed FROM ch GROUP BY run_id),
  summary AS (SELECT coalesce(r.run_id, c.run_id) AS run_id, schedule_type, started_at, ended_at,
    date_diff('second', started_at, ended_at) AS duration_seconds, coalesce(catalog_count, 0) AS catalog_count,
    coalesce(spec_field_count, 0) AS spec_field_count, coalesce(issue_count, 0) AS issue_count,
    coalesce(added, 0) AS new_series_count, coalesce(removed, 0) AS disappeared_series_count,
    CASE WHEN catalog_count > 0 THEN (catalog_count - coalesce(issue_count, 0)) / cast(catalog_count AS DOUBLE) ELSE 0 END AS success_rate,
    CASE WHEN catalog_count > 0 THEN round((catalog_count - coalesce(failed, 0)) / cast(catalog_count AS DOUBLE), 4) ELSE 0 END AS product_success_rate,
    CASE WHEN models > 0 THEN coalesce(with_specs, 0) / cast(models AS DOUBLE) ELSE 0 END AS spec_success_rate, status
  FROM runs AS r FULL JOIN c ON r.run_id = c.run_id LEFT JOIN s ON s.run_id = coalesce(r.run_id, c.run_id)
  LEFT JOIN q ON q.run_id = coalesce(r.run_id, c.run_id) LEFT JOIN h ON h.run_id = coalesce(r.run_id, c.run_id))"""


def summary_of(t):
    return report.run_summary(t.runs, t.catalog, t.specs, quality.detect_spec_issues(t.specs), diff.hierarchy_changes(t.hierarchy))


check("A9_run_summary", SUMMARY + " SELECT * EXCLUDE (product_success_rate, spec_success_rate) FROM summary",
      "runs", "catalog", "specs", "hierarchy")(lambda t: summary_of(t).drop("product_success_rate", "spec_success_rate"))
check("A10_success_rates", SUMMARY + " SELECT run_id, success_rate, product_success_rate, spec_success_rate FROM summary",
      "runs", "catalog", "specs", "hierarchy")(
    lambda t: summary_of(t).select("run_id", "success_rate", "product_success_rate", "spec_success_rate"))
check("A11_fetch_statistics", """SELECT count(*) AS total_items, cast(sum(success::INT) AS BIGINT) AS successful, cast(sum((NOT success)::INT) AS BIGINT) AS failed,
  cast(sum(success::INT) AS BIGINT) * 100.0::DOUBLE / count(*) AS success_rate, cast(sum(CASE WHEN success THEN size ELSE 0 END) AS BIGINT) AS total_bytes,
  cast(sum(CASE WHEN success THEN size ELSE 0 END) AS BIGINT)::DOUBLE / cast(sum(success::INT) AS BIGINT) AS avg_bytes_per_item FROM fetch_log""", "fetch_log")(
    lambda t: report.fetch_statistics(t.fetch_log))
check("A12_catalog_summary", """SELECT brand, count(*) AS total_items, count(DISTINCT brand) AS total_brands,
  count(DISTINCT series_l1) AS total_series_l1, count(DISTINCT series_l2) AS total_series_l2, count(DISTINCT product_model) AS total_models
  FROM catalog GROUP BY GROUPING SETS ((brand), ())""", "catalog")(
    lambda t: report.catalog_summary(t.catalog))
check("A13_hierarchy_summary", """SELECT run_id, count(*) AS total_nodes, count(DISTINCT brand) AS total_brands,
  cast(sum((series_l2 IS NULL)::INT) AS BIGINT) AS total_l1, count(series_l2) AS total_l2, min(discovered_at) AS discovery_time
  FROM hierarchy GROUP BY run_id""", "hierarchy")(lambda t: report.hierarchy_summary(t.hierarchy))
check("A14_duplicate_groups", """SELECT brand, series_l1, series_l2, product_model, product_url, product_name, group_size FROM (
  SELECT *, count(*) OVER (PARTITION BY brand, series_l1, series_l2, product_model) AS group_size FROM catalog) AS c
  WHERE group_size > 1""", "catalog")(lambda t: report.duplicate_groups(t.catalog))
check("A16_run_report", SUMMARY + """, k AS (SELECT run_id, brand FROM catalog UNION SELECT run_id, brand FROM specs),
  cb AS (SELECT run_id, brand, count(*) AS catalog_entries FROM catalog GROUP BY ALL), sb AS (SELECT run_id, brand, count(*) AS spec_records FROM specs GROUP BY ALL),
  ib AS (SELECT run_id, brand, count(*) AS issues, cast(sum((severity = 'P1')::INT) AS BIGINT) AS p1, cast(sum((severity = 'P2')::INT) AS BIGINT) AS p2, cast(sum((severity = 'P3')::INT) AS BIGINT) AS p3 FROM i GROUP BY run_id, brand)
  SELECT k.run_id, k.brand, coalesce(catalog_entries, 0) AS catalog_entries, coalesce(spec_records, 0) AS spec_records, coalesce(issues, 0) AS issues,
    coalesce(p1, 0) AS p1, coalesce(p2, 0) AS p2, coalesce(p3, 0) AS p3, status, success_rate
  FROM k LEFT JOIN cb USING (run_id, brand) LEFT JOIN sb USING (run_id, brand) LEFT JOIN ib USING (run_id, brand) LEFT JOIN summary USING (run_id)""",
      "runs", "catalog", "specs", "hierarchy")(
    lambda t: report.run_report(t.runs, t.catalog, t.specs, quality.detect_spec_issues(t.specs)))
check("A16_quality_report", """SELECT run_id, brand, issue_type, severity, count(*) AS n FROM issues WHERE severity = 'P2'
  AND issue_type = 'missing_field' GROUP BY ALL""", "issues")(lambda t: report.quality_report(t.issues, "P2", "missing_field"))
check("A17_wide_specs", "SELECT run_id, brand, series_l1, series_l2, product_model, " + ", ".join(
    f"max(CASE WHEN field_code = '{c}' AND normalized_value IS NOT NULL THEN {{'t': updated_at, 'v': normalized_value}} END).v AS {c}" for c in R.FIELD_CODES)
      + " FROM specs GROUP BY run_id, brand, series_l1, series_l2, product_model", "specs")(lambda t: report.wide_specs(t.specs))

# --- joins -----------------------------------------------------------------------------------------

check("J5_duplicate_models_in_run", """SELECT run_id, brand, product_model, locale FROM (
  SELECT *, count(*) OVER (PARTITION BY run_id, product_model) AS n FROM catalog) AS c WHERE n > 1""", "catalog")(
    lambda t: report.duplicate_models_in_run(t.catalog).select("run_id", "brand", "product_model", "locale"))
check("J6_products_without_specs", """SELECT run_id, brand, product_model, locale FROM catalog AS c WHERE NOT EXISTS (
  SELECT 1 FROM specs AS s WHERE s.brand = c.brand AND s.product_model = c.product_model)""", "catalog", "specs")(
    lambda t: report.products_without_specs(t.catalog, t.specs).select("run_id", "brand", "product_model", "locale"))
J7 = f""", m AS (SELECT p.brand, p.product_model, f.field_code FROM (SELECT DISTINCT brand, product_model FROM catalog) AS p,
  (SELECT unnest([{FIELD_LIST}]) AS field_code) AS f WHERE NOT EXISTS (SELECT 1 FROM specs AS s WHERE s.brand = p.brand
  AND s.product_model = p.product_model AND s.field_code = f.field_code))"""
check("J7_missing_fields", J7 + " SELECT * FROM m", "catalog", "specs")(
    lambda t: report.missing_fields(t.catalog, t.specs))
check("J7_missing_field_counts", J7 + " SELECT brand, field_code, count(*) AS missing_products FROM m GROUP BY brand, field_code",
      "catalog", "specs")(lambda t: report.missing_field_counts(t.catalog, t.specs))
check("J10_empty_subseries", EMPTY.format(h="hierarchy", c="catalog"), "hierarchy", "catalog")(
    lambda t: diff.empty_subseries(t.hierarchy, t.catalog))
check("J11_retry_candidates", """SELECT page_id, url FROM pages WHERE url IN (
  SELECT url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY attempt DESC, page_id DESC) AS k FROM fetch_log) AS l WHERE k = 1 AND NOT success)""", "fetch_log")(
    lambda t: report.retry_candidates(t.pages, t.fetch_log, "url", F.desc("attempt"), F.desc("page_id")).select("page_id", "url"))
check("J12_normalize_hierarchy", """SELECT item_id, product_model, node_brand AS brand, node_l1 AS series_l1, node_l2 AS series_l2,
  array_to_string(list_filter([CASE WHEN brand IS DISTINCT FROM node_brand THEN 'brand' END,
    CASE WHEN series_l1 IS DISTINCT FROM node_l1 THEN 'series_l1' END, CASE WHEN series_l2 IS DISTINCT FROM node_l2 THEN 'series_l2' END],
    lambda x: x IS NOT NULL), ',') AS mismatch FROM listing""", "listing")(lambda t: report.normalize_hierarchy(t.listing))
check("J9_new_entries", """SELECT brand, product_model, run_id, locale, series_l1 FROM (
  SELECT *, row_number() OVER (PARTITION BY brand, product_model ORDER BY run_id, locale, first_seen_at, series_l1) AS k FROM catalog) AS c
  WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM specs AS s WHERE s.brand = c.brand AND s.product_model = c.product_model)""", "specs", "catalog")(
    lambda t: diff.new_entries(t.catalog, t.specs, ["brand", "product_model"], "run_id", "locale", "first_seen_at", "series_l1").select(
        "brand", "product_model", "run_id", "locale", "series_l1"))

# --- runs against runs -----------------------------------------------------------------------------

check("U1_hierarchy_changes", f", {PATHS} SELECT * FROM ch", "hierarchy")(lambda t: diff.hierarchy_changes(t.hierarchy))
check("U1_two_runs", f""", {PATHS} SELECT brand, series_l1, series_l2, change FROM ch WHERE run_id = '19960701_monthly_01'""", "hierarchy")(
    lambda t: diff.compare_hierarchies(t.hierarchy.where("run_id = '19960701_monthly_01'"), t.hierarchy.where("run_id = '19960101_monthly_01'")))
check("U1_change_counts", f""", {PATHS} SELECT run_id, brand, cast(sum((change = 'added')::INT) AS BIGINT) AS new_series_count,
  cast(sum((change = 'removed')::INT) AS BIGINT) AS disappeared_series_count FROM ch GROUP BY run_id, brand""", "hierarchy")(
    lambda t: diff.series_change_counts(t.hierarchy))
check("U2_series_overlap", """SELECT a.name AS first, product_model FROM (SELECT DISTINCT series_l2 AS name, product_model FROM catalog) AS a
  SEMI JOIN (SELECT DISTINCT product_model FROM catalog WHERE series_l2 = 'large anvil') AS b USING (product_model) WHERE a.name = 'hot rod'""", "catalog")(
    lambda t: diff.series_overlap(t.catalog, "hot rod", "large anvil").withColumn("first", F.lit("hot rod")))
check("U3_union", """SELECT run_id, count(*) AS n, count(locale) AS located FROM (SELECT run_id, locale FROM catalog
  UNION ALL SELECT run_id, NULL FROM specs UNION ALL SELECT run_id, NULL FROM hierarchy) AS u GROUP BY run_id""", "catalog", "specs", "hierarchy")(
    lambda t: diff.union_all(t.catalog, t.specs, t.hierarchy).groupBy("run_id").agg(F.count("*").alias("n"), F.count("locale").alias("located")))
check("W5_latest_run", "SELECT brand, max({'t': discovered_at, 'r': run_id}).r AS latest_run_id FROM hierarchy GROUP BY brand", "hierarchy")(
    lambda t: diff.latest_run(t.hierarchy))
check("W5_previous_runs", """SELECT brand, run_id, lag(run_id) OVER (PARTITION BY brand ORDER BY run_id) AS previous_run_id
  FROM (SELECT DISTINCT brand, run_id FROM hierarchy) AS d""", "hierarchy")(lambda t: diff.previous_runs(t.hierarchy))
check("W6_lifecycle", """SELECT brand, series_l1, series_l2, product_model, min(first_seen_at) AS first_seen_at, max(last_seen_at) AS last_seen_at,
  CASE WHEN date_diff('day', CAST(max(last_seen_at) AS DATE), DATE '2001-11-05') > 60 THEN 'discontinued' ELSE 'current' END AS catalog_status
  FROM catalog GROUP BY brand, series_l1, series_l2, product_model""", "catalog")(
    lambda t: diff.lifecycle(t.catalog, F.lit("2001-11-05").cast("date")))
check("W7_spec_changes", """, r AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS n, lead(run_id) OVER (ORDER BY run_id) AS next_run
    FROM (SELECT DISTINCT run_id FROM specs) AS d),
  v AS (SELECT * FROM (SELECT run_id, brand, product_model, field_code, normalized_value AS value,
    row_number() OVER (PARTITION BY run_id, brand, product_model, field_code ORDER BY updated_at DESC, normalized_value DESC NULLS LAST) AS k FROM specs) AS q
    JOIN r USING (run_id) WHERE k = 1),
  j AS (SELECT coalesce(a.brand, b.brand) AS brand, coalesce(a.product_model, b.product_model) AS product_model,
    coalesce(a.field_code, b.field_code) AS field_code, a.run_id AS cur_run, b.next_run AS after_run, a.n AS an, a.value AS new_value, b.value AS old_value,
    a.run_id IS NOT NULL AS has_new, b.run_id IS NOT NULL AS has_old
    FROM v AS a FULL JOIN v AS b ON a.brand = b.brand AND a.product_model = b.product_model AND a.field_code = b.field_code AND a.n = b.n + 1)
  SELECT brand, product_model, field_code, CASE WHEN has_new THEN cur_run ELSE after_run END AS run_id,
    CASE WHEN has_new AND has_old THEN 'changed' WHEN has_new THEN 'new' ELSE 'removed' END AS change_type, old_value, new_value
  FROM j WHERE (has_new AND has_old AND new_value IS DISTINCT FROM old_value) OR (has_new AND NOT has_old AND an > 1)
    OR (NOT has_new AND after_run IS NOT NULL)""", "specs")(lambda t: diff.spec_changes(t.specs))

# --- top and first ---------------------------------------------------------------------------------

check("T1_recent_runs", "SELECT * FROM runs WHERE status = 'completed' ORDER BY started_at DESC, run_id DESC LIMIT 5", "runs")(
    lambda t: report.recent_runs(t.runs, 5, status="completed"))
check("T2_top_missing_fields", J7 + """ SELECT * FROM (SELECT brand, field_code, missing_products,
  cast(row_number() OVER (PARTITION BY brand ORDER BY missing_products DESC, field_code) AS INT) AS rank
  FROM (SELECT brand, field_code, count(*) AS missing_products FROM m GROUP BY brand, field_code) AS c) AS k WHERE rank <= 5""", "catalog", "specs")(
    lambda t: report.top_missing_fields(t.catalog, t.specs))
check("T3_first_uncovered", """SELECT DISTINCT brand, series_l1, series_l2, product_model FROM catalog AS c WHERE NOT EXISTS (
  SELECT 1 FROM specs AS s WHERE s.brand = c.brand AND s.product_model = c.product_model)
  ORDER BY brand, series_l1, product_model, series_l2 LIMIT 20""", "catalog", "specs")(
    lambda t: report.first_rows(report.products_without_specs(t.catalog, t.specs).select(
        "brand", "series_l1", "series_l2", "product_model").distinct(), 20, "brand", "series_l1", "product_model", "series_l2"))
