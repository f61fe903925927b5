"""Checks of sources, sinks and streams. Written tables go to the shared folder of the session."""

import os
import tempfile

from pyspark.sql import functions as F

from specloom import registry as R
from specloom.checks.base import check
from specloom.checks.merging import FULL, newest
from specloom.checks.quality import RECORD_ISSUES
from specloom.checks.reports import SUMMARY, summary_of
from specloom.plans import views
from specloom.sources import feed, manual, pages, snapshots
from specloom.streaming import issues as streams

RUN, RUN2 = "19960101_monthly_01", "19990701_monthly_01"
NODE = "run_id, brand, series_l1, series_l2"


def stored(t, table="hierarchy", df=None):
    """Write all runs of a table and return its folder."""
    base = folder(t)
    snapshots.write_runs(t.hierarchy if df is None else df, base, table)
    return base


def folder(t):
    """A fresh shared folder; a local session without the setting gets one of its own for the check."""
    if not t.spark.conf.get("spark.checkpoint.dir", None) and t.spark.sparkContext.master.startswith("local["):
        return tempfile.mkdtemp(prefix="specloom-")
    return snapshots.shared_dir(t.spark)


check("S1_page_keys", """SELECT page_id, replace(replace(url, '/', '_'), ':', '_') AS file_key, sha256(url) AS cache_key, substr(md5(url), 1, 12) AS short_key FROM pages""")(
    lambda t: pages.with_page_keys(t.pages).select("page_id", "file_key", "cache_key", "short_key"))


@check("S1_files_of_a_run", f"""SELECT url, sha256(html) AS html_sha256 FROM product_pages WHERE url IN (
  SELECT product_url FROM catalog WHERE run_id = '{RUN}')""", "product_pages", "catalog")
def _(t):
    base = os.path.join(folder(t), "html")
    pages.write_page_files(t.product_pages, base)
    run = t.catalog.where(F.col("run_id") == RUN)
    return pages.pages_of_run(t.spark, base, run).select("url", F.sha2("html", 256).alias("html_sha256"))


FEED = """f AS (SELECT p_partkey AS d, 0 AS pos, 'DS-' || p_partkey || '/A' AS m, p_type || ' Series' AS series, p_name AS sub,
    CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '/p/' || p_partkey ELSE 'https://y.example/p/' || p_partkey END AS path, 'Camera ' || p_partkey AS title FROM part
  UNION ALL SELECT p_partkey, 1, CASE WHEN p_size = 1 THEN '' ELSE 'SZ ' || p_size END, p_type, p_brand, '/s/' || p_partkey, NULL FROM part)"""
FEED_OUT = """SELECT 'BRAND' AS brand, 'Promo' AS series_l1, {l2} AS series_l2, m AS product_model, coalesce(title, m) AS product_name,
  CASE WHEN path LIKE 'https%' THEN path WHEN path <> '' THEN 'https://z.example' || path
       ELSE 'https://z.example/en/products/IP-Products/Network-Cameras/Promo-Series/' || replace(replace(lower(m), '/', '-'), ' ', '-') || '/' END AS product_url, 'en' AS locale
  FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY d, pos) AS k FROM f WHERE m <> '' AND lower(series) LIKE '%promo%' AND {where}) AS q WHERE k = 1"""
check("S2_feed_series", f"WITH {FEED} " + FEED_OUT.format(l2="'Promo'", where="TRUE"))(
    lambda t: feed.feed_products(feed.parse_feed(t.feed, "doc", "doc_pos"), "Promo", "Promo", "BRAND", "https://z.example", "doc_pos", "pos"))
check("S2_feed_subseries", f"WITH {FEED} " + FEED_OUT.format(l2="'ring'", where="lower(sub) LIKE '%ring%'"))(
    lambda t: feed.feed_products(feed.parse_feed(t.feed, "doc", "doc_pos"), "Promo", "ring", "BRAND", "https://z.example", "doc_pos", "pos"))
check("W1_first_models", """SELECT p_name AS product_model, p_type AS series, p_partkey AS pos FROM (SELECT *, row_number() OVER (PARTITION BY p_type, p_name ORDER BY p_partkey) AS k
  FROM part) AS q WHERE k = 1""")(
    lambda t: feed.first_models(t.part.select(F.col("p_name").alias("product_model"), F.col("p_type").alias("series"), F.col("p_partkey").alias("pos")),
                                "series", "product_model", "pos"))
check("S3_snapshot_write", f"""SELECT {NODE}, cast(substr(run_id, 1, 4) AS INT) AS year, cast(substr(run_id, 5, 2) AS INT) AS month FROM hierarchy""", "hierarchy")(
    lambda t: snapshots.read_table(t.spark, stored(t), "hierarchy").select(*NODE.split(", "), "year", "month"))
check("S4_read_run", f"SELECT {NODE}, discovered_at FROM hierarchy WHERE run_id = '{RUN}'", "hierarchy")(
    lambda t: snapshots.read_runs(t.spark, stored(t), "hierarchy", [RUN]).select(*NODE.split(", "), "discovered_at"))
check("S5_read_runs", f"SELECT {NODE} FROM hierarchy WHERE run_id IN ('{RUN}', '{RUN2}')", "hierarchy")(
    lambda t: snapshots.read_runs(t.spark, stored(t), "hierarchy", [RUN, RUN2]).select(*NODE.split(", ")))
check("S6_list_runs", "SELECT DISTINCT run_id FROM hierarchy ORDER BY run_id DESC", "hierarchy")(
    lambda t: snapshots.list_runs(t.spark, stored(t), "hierarchy"))


@check("S7_delete_run", f"SELECT {NODE} FROM hierarchy WHERE run_id <> '{RUN}'", "hierarchy")
def _(t):
    base = stored(t)
    snapshots.delete_run(t.spark, base, RUN, ["hierarchy"])
    return snapshots.read_table(t.spark, base, "hierarchy").select(*NODE.split(", "))


ODD = "CASE WHEN run_id = '19980101_monthly_01' THEN '20261399_monthly_01' WHEN run_id = '19980701_monthly_01' THEN 'trial/a=b' ELSE run_id END"


def odd_runs(t):
    """Two runs with ids that hold no date, and one that is written again without rows."""
    rows = t.hierarchy.withColumn("run_id", F.expr(ODD))
    base = stored(t, df=rows)
    snapshots.write_runs(rows.where("false"), base, "hierarchy", replaces=[RUN])
    return base


check("S3_empty_rewrite", f"SELECT run_id, count(*) AS n FROM (SELECT {ODD} AS run_id FROM hierarchy) AS h WHERE run_id <> '{RUN}' GROUP BY run_id", "hierarchy")(
    lambda t: snapshots.read_table(t.spark, odd_runs(t), "hierarchy").groupBy("run_id").agg(F.count("*").alias("n")))
check("S5_runs_without_date", f"""SELECT {NODE} FROM (SELECT * REPLACE ({ODD} AS run_id) FROM hierarchy) AS h
  WHERE run_id IN ('20261399_monthly_01', 'trial/a=b', '{RUN2}')""", "hierarchy")(
    lambda t: snapshots.read_runs(t.spark, odd_runs(t), "hierarchy", ["20261399_monthly_01", "trial/a=b", RUN2, RUN]).select(*NODE.split(", ")))


@check("S7_delete_run_without_date", f"SELECT run_id, count(*) AS n FROM (SELECT {ODD} AS run_id FROM hierarchy) AS h WHERE run_id NOT IN ('{RUN}', 'trial/a=b') GROUP BY run_id", "hierarchy")
def _(t):
    base = odd_runs(t)
    snapshots.delete_run(t.spark, base, "trial/a=b", ["hierarchy"])
    return snapshots.read_table(t.spark, base, "hierarchy").groupBy("run_id").agg(F.count("*").alias("n"))


check("S7_without_run", f"SELECT {NODE}, locale FROM catalog WHERE run_id <> '{RUN}'", "catalog")(
    lambda t: snapshots.without_run(t.catalog, RUN).select(*NODE.split(", "), "locale"))
check("S9_spec_sheet", f"SELECT {', '.join(R.SPEC_SHEET)} FROM specs WHERE upper(brand) = 'BRAND#12'", "specs")(
    lambda t: manual.sheet(t.specs, R.SPEC_SHEET, "Brand#12", "series_l1", "series_l2", "product_model", "field_code"))
check("S9_catalog_sheet", f"SELECT {', '.join(R.CATALOG_SHEET)} FROM catalog WHERE upper(brand) = 'BRAND#7'", "catalog")(
    lambda t: manual.sheet(t.catalog, R.CATALOG_SHEET, "brand#7"))
check("S9_issue_sheet", f"SELECT {', '.join(R.ISSUE_SHEET)} FROM issues", "issues")(lambda t: manual.sheet(t.issues, R.ISSUE_SHEET))
check("S9_summary_sheet", SUMMARY + """ SELECT run_id, schedule_type, coalesce(strftime(started_at, '%Y-%m-%d %H:%M:%S'), '') AS started_at,
  coalesce(strftime(ended_at, '%Y-%m-%d %H:%M:%S'), '') AS ended_at, catalog_count, spec_field_count, issue_count, new_series_count, disappeared_series_count,
  printf('%.2f%%', success_rate * 100) AS success_rate, status FROM summary""", "runs", "catalog", "specs", "hierarchy")(
    lambda t: manual.summary_sheet(summary_of(t)))


@check("S8_sheet_files", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in R.MANUAL_SHEET) + ", 1 < 2 AS numbered FROM manual", "manual")
def _(t):
    base = folder(t)
    sheets = t.manual.select(*R.MANUAL_SHEET).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    sheets.mode("overwrite").csv(os.path.join(base, "sheet"))
    rows = manual.read_manual_sheet(t.spark, os.path.join(base, "sheet"))
    return rows.select(*R.MANUAL_SHEET, (F.col("row_no") > 1).alias("numbered"))


@check("S8_upsert", f"""SELECT {FULL}, manual_value, operator, created_at FROM {newest(FULL)} AS q""", "manual")
def _(t):
    """Corrections of the later half of days replace stored ones with the same key."""
    late = F.dayofmonth("created_at") > 15
    return manual.upsert_manual(t.manual.where(~late), t.manual.where(late)).select(*FULL.split(", "), "manual_value", "operator", "created_at")


@check("S10_append_records", f"""SELECT {NODE}, product_model, product_name, CAST(NULL AS VARCHAR) AS product_url, 'en' AS locale, 'current' AS catalog_status FROM catalog""", "catalog")
def _(t):
    base = folder(t)
    rows = t.catalog.select(*NODE.split(", "), "product_model", "product_name")
    snapshots.append_records(rows, base, "catalog", locale=F.lit("en"), catalog_status=F.lit("current"))
    return snapshots.read_table(t.spark, base, "catalog").select(
        *NODE.split(", "), "product_model", "product_name", "product_url", "locale", "catalog_status")


check("S11_page_triage", """SELECT page_id, cast(length(html) AS INT) AS size, FALSE AS stale, length(html) < 1000 OR NOT regexp_matches(html, '(?i)<body') AS needs_render,
  length(html) < 2000 AS too_short FROM pages""")(lambda t: pages.triage(t.pages).drop("url"))
check("E2_site_products", """SELECT name, count(*) AS pages FROM (SELECT 'DS-2CD' || s_suppkey || ' G2' AS name FROM supplier UNION ALL SELECT 'model ' || s_suppkey FROM supplier) AS n
  GROUP BY name""")(lambda t: _site_products(t))


def _site_products(t):
    from specloom.operators import extract
    links = extract.site_links(t.link_pages, ["page_id"], "catalog", "https://z.example")
    return links.where("kind = 'product'").groupBy("name").agg(F.count("*").alias("pages"))


# --- streams ---------------------------------------------------------------------------------------

def file_stream(t, name):
    schema = getattr(t, name).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.sf_dir)


@check("R1_issue_stream", f"SELECT run_id, issue_type, severity, count(*) AS n FROM ({RECORD_ISSUES}) AS i GROUP BY run_id, issue_type, severity", "specs")
def _(t):
    base = folder(t)
    specs = t.spark.sql(views.VIEWS["specs"], lineitem=file_stream(t, "lineitem"), part=t.part)
    streams.issue_counts_stream(specs, os.path.join(base, "counts"), os.path.join(base, "state")).awaitTermination()
    return streams.issue_counts(t.spark, os.path.join(base, "counts"))


@check("R2_event_rate", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def _(t):
    base = folder(t)
    rate = streams.event_rate(file_stream(t, "events"), "ts", "event_id", "event_type")
    streams.run_to_table(rate, os.path.join(base, "rate"), os.path.join(base, "state")).awaitTermination()
    return streams.last_state(t.spark, os.path.join(base, "rate"), "window_start", "event_type")


