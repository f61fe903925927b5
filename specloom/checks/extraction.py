"""Checks of HTML extraction.

The oracles for product pages do not parse HTML: they state, from the part columns the pages are made of, what
has to come out.
"""

from pyspark.sql import functions as F

from specloom import registry as R
from specloom.checks.base import check
from specloom.checks.values import _pick as pick, as_json, items
from specloom.functions import html as H
from specloom.functions.values import light_type
from specloom.operators import aliases, extract
from specloom.plans import views

K = ["page_id"]


def product_pages(t):
    return spread_view(t, "product_pages")


def spread_view(t, name):
    """A view of pages over ``part`` dealt out by its key: the narrow rows move, not the HTML made from them."""
    parts = t.part.repartition(t.spark.sparkContext.defaultParallelism, "p_partkey")
    return t.spark.sql(views.VIEWS[name], part=parts)


def merged_catalog(t):
    """The catalog with ``part`` merge-joined: where only its keys are read, millions of them look small beside the file, and a broadcast of them would pass through the driver."""
    return t.spark.sql(views.VIEWS["catalog"], lineitem=t.lineitem, part=t.part.hint("merge"))


# decoded values of the page cells
PP = """pp AS (SELECT p_partkey AS page_id, p_partkey % 6 AS kind, p_size AS s, cast(p_size AS VARCHAR) AS t,
    CASE p_size % 3 WHEN 0 THEN '1/2.8" Progressive Scan CMOS' WHEN 1 THEN '1/3" CMOS' ELSE '-' END AS sensor,
    (640 + 16 * p_size) || ' × ' || (480 + 8 * p_size) AS res, 'Fixed & ' || p_size || ' mm' AS lens,
    CASE p_size % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN p_size || ' ft' ELSE 'Up to ' || p_size || ' m' END AS rng,
    '50Hz: 25 fps (' || (640 + 16 * p_size) || ' × 720)' AS stream,
    CASE p_size % 5 WHEN 0 THEN 'No' ELSE 'Line crossing, Face ' || p_size END AS smart FROM part)"""
FUNCS = "'[\"Line crossing\", \"Face ' || t || '\"]'"
ROW8 = """[{'l': 'imagesensor', 'v': sensor}, {'l': 'max. resolution', 'v': res}, {'l': 'lens type', 'v': lens}, {'l': 'ir range', 'v': rng},
  {'l': 'main stream', 'v': stream}, {'l': 'interface', 'v': 'RJ45Audio ' || t}, {'l': 'smart event', 'v': smart}, {'l': 'protection', 'v': 'IP67, IK10'}]"""
ROW7 = """[{'l': 'max. resolution', 'v': res}, {'l': 'image sensor', 'v': sensor}, {'l': 'lens type', 'v': lens}, {'l': 'aperture', 'v': 'F1.' || t},
  {'l': 'ivs', 'v': 'Yes'}, {'l': 'intelligence', 'v': smart}, {'l': 'sub stream', 'v': 'none'}]"""


def rows_sql(kind: int, rows: str, confidence: float) -> str:
    return f"""SELECT page_id, cast(i - 1 AS INT) AS row_pos, 0 AS cell_pos, x.l AS label, x.v AS value, {confidence}::DOUBLE AS confidence
      FROM (SELECT page_id, unnest({rows}) AS x, generate_subscripts({rows}, 1) AS i FROM pp WHERE kind = {kind}) AS q"""


check("X1_page_text", r"""SELECT page_id, replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
  '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'), '(?s)<[/!?a-zA-Z][^>]*>', '', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&') AS page_text FROM pages""")(
    lambda t: extract.page_texts(t.pages, K))
check("X2_table_pairs", f"WITH {PP} {rows_sql(0, ROW8, 1.0)} UNION ALL {rows_sql(1, ROW7, 1.0)}")(
    lambda t: extract.pairs(product_pages(t), K, "table"))
check("X3_vendor_blocks", f"WITH {PP} {rows_sql(2, ROW8, 1.0)}")(lambda t: extract.pairs(product_pages(t), K, "block"))
ROW_LI = ROW8.replace("{'l': 'interface', 'v': 'RJ45Audio ' || t}, ", "")
check("X4_list_pairs", f"""WITH {PP} SELECT page_id, row_pos, cell_pos, label || ': ' || lower(value) AS label, value, confidence FROM ({rows_sql(3, ROW_LI, 0.9)}) AS q
  UNION ALL SELECT page_id, 0, 0, 'rj45', 'Audio ' || t, 0.8::DOUBLE FROM pp WHERE kind IN (0, 2, 4)""")(
    lambda t: extract.pairs(product_pages(t), K, "list"))
check("X5_definition_pairs", f"WITH {PP} {rows_sql(4, ROW8, 1.0)}")(lambda t: extract.pairs(product_pages(t), K, "definition"))


def nested_sql(confidence: float, *rows: str) -> str:
    return " UNION ALL ".join(f"SELECT p_partkey AS page_id, {row}, {confidence}::DOUBLE AS confidence FROM part" for row in rows)


T = "cast(p_size AS VARCHAR)"
check("X2_nested_tables", nested_sql(1.0, f"0 AS row_pos, 0 AS cell_pos, 'size' AS label, 'Width' || {T} AS value", f"0, 1, 'width' || {T}, 'Width'",
                                     f"0, 2, 'width', {T}", f"1, 0, 'width', {T}", "2, 0, 'lens type', p_type"))(
    lambda t: extract.pairs(t.nested_pages, K, "table"))
check("X4_nested_lists", nested_sql(0.9, f"0 AS row_pos, 0 AS cell_pos, 'portsrj45: ' || {T} AS label, {T} AS value", f"1, 0, 'rj45: ' || {T}, {T}",
                                    "2, 0, 'colour: ' || lower(p_name), p_name"))(
    lambda t: extract.pairs(t.nested_pages, K, "list"))
check("X5_nested_definitions", nested_sql(1.0, "0 AS row_pos, 0 AS cell_pos, 'shared' AS label, p_name || 'Brand' || p_brand || 'Open' AS value",
                                          "1, 0, 'housing', p_name || 'Brand' || p_brand || 'Open'", "2, 0, 'brand', p_brand", f"4, 0, 'weight', {T}"))(
    lambda t: extract.pairs(t.nested_pages, K, "definition"))
check("X6_position", f"""WITH {PP} SELECT * FROM (
  SELECT page_id, 'max_resolution' AS field_code, CASE kind WHEN 0 THEN sensor ELSE res END AS raw_value, 0.7::DOUBLE AS confidence FROM pp WHERE kind IN (0, 1)
  UNION ALL SELECT page_id, 'image_sensor', CASE kind WHEN 0 THEN res ELSE sensor END, 0.7 FROM pp WHERE kind IN (0, 1)
  UNION ALL SELECT page_id, 'lens_type', lens, 0.7 FROM pp WHERE kind IN (0, 1)) AS q WHERE raw_value <> '-'""")(
    lambda t: extract.position_values(product_pages(t), K))
check("X7_pattern", f"""WITH {PP} SELECT page_id, 'max_resolution' AS field_code, CASE kind WHEN 5 THEN '1280x720' ELSE replace(res, ' × ', 'x') END AS raw_value, 0.6::DOUBLE AS confidence FROM pp
  UNION ALL SELECT page_id, 'supplement_light_range', t || 'm', 0.6 FROM pp WHERE kind = 5
  UNION ALL SELECT page_id, 'aperture', CASE kind WHEN 5 THEN 'F/1.' ELSE 'F1.' END || t, 0.6 FROM pp WHERE kind IN (1, 5)""")(
    lambda t: extract.pattern_values(product_pages(t), K))

STREAMS = "CASE kind WHEN 1 THEN '2' WHEN 5 THEN NULL ELSE '1' END"
LIGHT = "CASE kind WHEN 1 THEN 'IR + Warm Light' WHEN 5 THEN 'White Light' ELSE 'IR' END"
SMART = f"""CASE kind WHEN 0 THEN CASE WHEN smart <> 'No' THEN {FUNCS} END
  WHEN 1 THEN CASE smart WHEN 'No' THEN '["IVS"]' ELSE replace({FUNCS}, '["', '["IVS", "') END
  WHEN 2 THEN CASE smart WHEN 'No' THEN '["No"]' ELSE {FUNCS} END END"""
for _name, _column, _sql in (("X10_smart_functions", "smart_functions", SMART), ("X11_stream_count", "stream_count", STREAMS),
                             ("X12_light_type", "light_type", LIGHT), ("X13_ip_rating", "ip_rating", "CASE kind WHEN 0 THEN 'IP67, IK10' END")):
    check(_name, f"WITH {PP} SELECT page_id, {_sql} AS {_column} FROM pp")(
        lambda t, _column=_column: extract.page_inference(product_pages(t), K).select("page_id", _column))

RAW = f"""raw AS (SELECT page_id, x.f AS field_code, x.v AS raw_value, x.c::DOUBLE AS confidence FROM (SELECT page_id, unnest([
  {{'f': 'image_sensor', 'v': CASE kind WHEN 0 THEN res WHEN 1 THEN nullif(sensor, '-') END, 'c': CASE kind WHEN 0 THEN 0.7 ELSE 1.0 END}},
  {{'f': 'max_resolution', 'v': CASE kind WHEN 5 THEN '1280x720' ELSE res END, 'c': CASE kind WHEN 5 THEN 0.6 WHEN 3 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'lens_type', 'v': CASE kind WHEN 5 THEN NULL ELSE lens END, 'c': CASE kind WHEN 3 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'aperture', 'v': CASE kind WHEN 1 THEN 'F1.' || t WHEN 5 THEN 'F/1.' || t END, 'c': CASE kind WHEN 5 THEN 0.6 ELSE 1.0 END}},
  {{'f': 'supplement_light_type', 'v': {LIGHT}, 'c': CASE kind WHEN 1 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'supplement_light_range', 'v': CASE WHEN kind = 5 THEN t || 'm' WHEN kind IN (0, 4) THEN nullif(rng, 'N/A') WHEN kind <> 1 THEN rng END,
    'c': CASE kind WHEN 5 THEN 0.6 WHEN 3 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'main_stream_max_fps_resolution', 'v': CASE WHEN kind NOT IN (1, 5) THEN stream END, 'c': CASE kind WHEN 3 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'stream_count', 'v': {STREAMS}, 'c': 1.0}},
  {{'f': 'interface_items', 'v': CASE WHEN kind IN (0, 4) THEN '["RJ45", "Audio ' || t || '"]' WHEN kind = 2 THEN 'RJ45Audio ' || t END, 'c': 1.0}},
  {{'f': 'deep_learning_function_categories', 'v': {SMART}, 'c': CASE kind WHEN 2 THEN 1.0 ELSE 0.9 END}},
  {{'f': 'approval_protection', 'v': CASE WHEN kind NOT IN (1, 5) THEN 'IP67, IK10' END, 'c': CASE kind WHEN 3 THEN 0.9 ELSE 1.0 END}},
  {{'f': 'approval_anti_corrosion_protection', 'v': CASE kind WHEN 0 THEN 'IP67, IK10' END, 'c': 1.0}}]) AS x FROM pp) AS q WHERE x.v IS NOT NULL)"""
check("X8_best_value", f"WITH {PP}, {RAW} SELECT * FROM raw")(
    lambda t: extract.extract_raw(product_pages(t), K).select("page_id", "field_code", "raw_value", "confidence"))
check("W4_one_value_per_field", f"WITH {PP}, {RAW} SELECT field_code, count(*) AS n, count(DISTINCT page_id) AS pages FROM raw GROUP BY field_code")(
    lambda t: extract.extract_raw(product_pages(t), K).groupBy("field_code").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages")))
QUOTED = f"""list_transform({items}, lambda x: replace(x, '"', chr(92) || '"'))"""
CELL = "run_id, product_model, field_code, raw_value"
check("X9_cell_values", f"""SELECT {CELL}, CASE WHEN lower(trim(raw_value)) NOT IN ('', '-', 'n/a', 'none') THEN trim(raw_value) END AS text_value,
  CASE WHEN lower(trim(r)) NOT IN ('', '-', 'n/a', 'none') AND len({items}) > 0 THEN {as_json(QUOTED)} END AS list_value FROM (SELECT *, raw_value AS r FROM specs
  WHERE field_code = 'interface_items') AS s""", "specs")(
    lambda t: t.specs.where("field_code = 'interface_items'").select(
        *CELL.split(", "), H.cell_value(F.col("raw_value")).alias("text_value"), H.cell_value(F.col("raw_value"), True).alias("list_value")))

# --- catalog and pages -----------------------------------------------------------------------------

check("J1_missing_pages", "SELECT run_id, product_model, locale, product_url FROM catalog WHERE coalesce(product_url, '') NOT LIKE 'https%'", "catalog")(
    lambda t: extract.missing_pages(t.catalog, t.product_pages).select("run_id", "product_model", "locale", "product_url"))
SPECS_OF = f""", {PP}, {RAW}, e AS (SELECT c.run_id, c.brand, coalesce(c.series_l1, '') AS series_l1, coalesce(c.series_l2, '') AS series_l2, c.product_model,
  r.field_code, r.raw_value, r.confidence AS extract_confidence FROM catalog AS c JOIN raw AS r ON c.product_url = 'https://x.example/' || r.page_id)"""
check("J1_extract_specs", SPECS_OF + f""" SELECT run_id, brand, series_l1, series_l2, product_model, field_code, raw_value, extract_confidence,
  {pick(1, 'NULL')} AS normalized_value, {pick(2, 'NULL')} AS unit, {pick(3, repr('Empty value'))} AS issues FROM (SELECT *, raw_value AS r FROM e) AS s""", "catalog")(
    lambda t: extract.extract_specs(t.catalog, product_pages(t)).select(
        "run_id", "brand", "series_l1", "series_l2", "product_model", "field_code", "raw_value", "extract_confidence", "normalized_value", "unit",
        F.array_join("issues", "; ").alias("issues")))


@check("J1_copies_of_a_page", f""" , {PP}, {RAW} SELECT 'https://x.example/' || page_id AS url, field_code, raw_value FROM raw""".replace(" ,", "WITH", 1))
def _(t):
    # every page is stored three times: an old copy of another page, and the newest one twice
    newest = product_pages(t).select("url", "html", F.lit(2).alias("version"))
    old = newest.select("url", F.lit("<table><tr><td>Lens Type</td><td>old</td></tr></table>").alias("html"), F.lit(1).alias("version"))
    return extract.newest_raw(newest.unionByName(newest).unionByName(old), "version").select("url", "field_code", "raw_value")
check("A15_extraction_counts", SPECS_OF + """ SELECT run_id, p AS products_processed, coalesce(n, 0) AS specs_extracted,
    CASE WHEN p > 0 THEN round(coalesce(n, 0) / cast(p AS DOUBLE), 2) ELSE 0 END AS avg_specs_per_product, f AS extraction_failures
  FROM (SELECT run_id, cast(sum((coalesce(product_url, '') LIKE 'https%')::INT) AS BIGINT) AS p, cast(sum((coalesce(product_url, '') NOT LIKE 'https%')::INT) AS BIGINT) AS f FROM catalog GROUP BY run_id) AS c
  LEFT JOIN (SELECT run_id, count(*) AS n FROM e GROUP BY run_id) AS k USING (run_id)""", "catalog")(
    lambda t: extract.extraction_counts(merged_catalog(t), t.product_pages, extract.extract_specs(merged_catalog(t), product_pages(t))))
TERMS = ", ".join(f"('{f.code}', {i}, '{term}')" for f in R.FIELDS for i, term in enumerate(f.terms))
check("J2_label_fields", f"""SELECT s.run_id, s.product_model, s.raw_value, a.f AS field_code, min(a.k) AS alias_rank FROM
  (SELECT run_id, product_model, raw_value, row_number() OVER () AS id FROM specs) AS s JOIN (VALUES {TERMS}) AS a(f, k, term) ON contains(lower(s.raw_value), a.term)
  GROUP BY s.id, s.run_id, s.product_model, s.raw_value, a.f""", "specs")(
    lambda t: extract.field_labels(t.specs.select("run_id", "product_model", "raw_value"), "raw_value"))


# names cut from the parts of the catalog as aliases, so that index and labels grow with the tables
CUTS = """SELECT p_type AS field_code, substr(p_name, 1 + p_partkey % 4, 1 + p_size % 9) AS alias, p_size AS alias_rank FROM part"""
check("J2_alias_index", f"""SELECT p_partkey, p_name, a.field_code, min(alias_rank) AS alias_rank
  FROM part JOIN (SELECT field_code, lower(alias) AS alias, min(alias_rank) AS alias_rank FROM ({CUTS}) AS c WHERE alias <> '' GROUP BY 1, 2) AS a
  ON contains(lower(p_name), alias) GROUP BY 1, 2, 3""")(
    lambda t: aliases.label_fields(t.part.select("p_partkey", "p_name"), "p_name", t.spark.sql(CUTS.replace(" part", " {part}"), part=t.part)))


@check("X16_replace_product", """SELECT run_id, product_model, field_code, CASE WHEN run_id = '19980101_monthly_01' AND product_model = 'M4'
  THEN 'fresh ' || coalesce(raw_value, '') ELSE raw_value END AS raw_value FROM specs""", "specs")
def _(t):
    rows = t.specs.select("run_id", "product_model", "field_code", "raw_value")
    fresh = rows.withColumn("raw_value", F.concat(F.lit("fresh "), F.coalesce("raw_value", F.lit(""))))
    return extract.replace_product(rows, fresh, "19980101_monthly_01", "M4")


check("N15_light_type_on_page", f"""WITH {PP} SELECT page_id, CASE kind WHEN 1 THEN '' WHEN 5 THEN 'White Light' ELSE 'IR' END AS light FROM pp""")(
    lambda t: extract.page_texts(product_pages(t), K).select("page_id", light_type(F.lit("smart"), F.col("page_text")).alias("light")))

# --- list pages ------------------------------------------------------------------------------------

LP = """SELECT p_partkey AS page_id, p_size AS s, (640 + p_size) || ' × 480' AS res, 'RJ45 ' || p_size AS port, 'RJ45 ' || (p_partkey % 50 + 1) AS storage,
  CASE WHEN p_size % 3 = 0 THEN 'No' ELSE 'HDMI' END AS video, 'IP' || (60 + p_size % 8) || ' & more' AS grade,
  '50Hz: 20 fps (' || (640 + p_size) || ' × 480), 25 fps (320 × 240)' AS stream FROM part"""
check("X14_list_labels", f"""WITH lp AS ({LP}) SELECT page_id, x.l AS label, x.v AS value, x.p AS pos FROM (SELECT page_id, unnest([
  {{'l': 'Max Resolution', 'v': res, 'p': 0}}, {{'l': 'IR Range', 'v': 'Up to ' || s || ' m', 'p': 1}}, {{'l': 'Aperture', 'v': 'F1.' || s, 'p': 2}},
  {{'l': CASE WHEN s % 2 = 0 THEN 'Third Stream' ELSE 'Sub-stream' END, 'v': 'yes', 'p': 3}}, {{'l': 'Main Stream', 'v': stream, 'p': 4}},
  {{'l': 'Communication Interface', 'v': port, 'p': 5}}, {{'l': 'Video Output', 'v': video, 'p': 6}}, {{'l': 'On-board Storage', 'v': storage, 'p': 7}},
  {{'l': 'Smart Event', 'v': 'Line crossing, face, other', 'p': 8}}, {{'l': 'Weatherproof Protection', 'v': grade, 'p': 10}}]) AS x FROM lp) AS q""")(
    lambda t: extract.list_page_labels(t.list_pages, K))
check("X14_list_page_specs", f"""WITH lp AS ({LP}), v AS (SELECT *, list_filter([port, CASE WHEN video <> 'No' THEN video END, CASE WHEN storage <> port THEN storage END],
  lambda x: x IS NOT NULL) AS ports FROM lp)
  SELECT page_id, x.f AS field_code, x.r AS raw_value, x.n AS normalized_value, x.u AS unit FROM (SELECT page_id, unnest([
  {{'f': 'max_resolution', 'r': res, 'n': replace(res, ' × ', 'x'), 'u': 'px'}}, {{'f': 'aperture', 'r': 'F1.' || s, 'n': 'f/1.' || s, 'u': 'f'}},
  {{'f': 'supplement_light_range', 'r': 'Up to ' || s || ' m', 'n': s || '.0', 'u': 'm'}},
  {{'f': 'main_stream_max_fps_resolution', 'r': stream, 'n': '20fps@' || (640 + s) || 'x480', 'u': 'fps+px'}},
  {{'f': 'stream_count', 'r': CASE WHEN s % 2 = 0 THEN '3' ELSE '2' END, 'n': CASE WHEN s % 2 = 0 THEN '3' ELSE '2' END, 'u': 'count'}},
  {{'f': 'interface_items', 'r': port, 'n': {as_json('ports')}, 'u': NULL}},
  {{'f': 'deep_learning_function_categories', 'r': 'Line crossing, face, other', 'n': '["Face Detection", "Line Crossing Detection"]', 'u': NULL}},
  {{'f': 'approval_protection', 'r': grade, 'n': grade, 'u': 'grade'}}]) AS x FROM v) AS q""")(
    lambda t: extract.list_page_specs(spread_view(t, "list_pages"), K))
check("N14_interfaces", f"""WITH lp AS ({LP}) SELECT page_id, array_to_string(list_filter([port, CASE WHEN video <> 'No' THEN video END, CASE WHEN storage <> port THEN storage END],
  lambda x: x IS NOT NULL), '|') AS ports FROM lp""")(
    lambda t: t.list_pages.select("page_id", H.list_page_pairs(H.clean_html(F.col("html"))).alias("pairs")).select(
        "page_id", F.array_join(H.interfaces(F.col("pairs"), H.list_page_value(F.col("pairs"), R.LIST_PAGE_LABELS["interface_items"])), "|").alias("ports")))

# --- links -----------------------------------------------------------------------------------------

SITE = "https://z.example"
check("E2_own_site_rules", r"""SELECT page_id, 'word' AS kind, upper(w) AS name, 'https://z.example/' || w AS url FROM (
  SELECT DISTINCT page_id, regexp_extract(tag, 'href="/([a-z]+)"', 1) AS w FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*>')) AS tag FROM pages) AS a) AS l WHERE w <> ''""")(
    lambda t: extract.site_links(t.pages, K, extract.SiteRules((("word", "^/([a-z]+)$", 1),), lambda kind, slug, heading, allowed: F.upper(slug)), SITE).select(
        "page_id", "kind", "name", "url"))
LONG_NAME = "one two three four five six seven eight nine ten eleven twelve"
check("X15_page_links", r"""SELECT page_id, cast(pos - 1 AS INT) AS pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href,
    trim(regexp_replace(regexp_extract(tag, '>(.*)</a>', 1), '\s+', ' ', 'g')) AS text FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a [^>]*>.*?</a>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?s)<a [^>]*>.*?</a>'), 1) AS pos FROM pages) AS a""")(
    lambda t: extract.page_links(t.pages, K).select("page_id", "pos", "href", "text"))
check("X15_long_link_text", f"SELECT page_id, '{LONG_NAME}' AS text FROM pages")(
    lambda t: extract.page_links(t.pages.select("page_id", F.lit(f"<a href='/x'>{LONG_NAME}</a>").alias("html")), K).select("page_id", "text"))
check("X15_tabbed_site", f"""WITH l AS (SELECT s_suppkey AS page_id, s_suppkey AS k, s_nationkey AS n FROM supplier)
  SELECT page_id, 'series' AS kind, 'wizsense-' || n AS name, '{SITE}/products/network-products/network-cameras/wizsense-' || n AS url FROM l
  UNION ALL SELECT page_id, 'subseries', '2 Line', '{SITE}/network-cameras/pro/2-line/IPC-' || k || '-a' FROM l
  UNION ALL SELECT page_id, 'product', 'IPC-' || k || '-A', '{SITE}/network-cameras/pro/2-line/IPC-' || k || '-a' FROM l
  UNION ALL SELECT page_id, 'product', 'DH-' || n, '{SITE}/network-cameras/pro/2-line/dh-' || n FROM l""")(
    lambda t: extract.site_links(t.link_pages, K, "tabbed", SITE).select("page_id", "kind", "name", "url"))
check("X15_catalog_site", f"""WITH l AS (SELECT s_suppkey AS page_id, s_suppkey AS k, '{SITE}/hk/products/IP-Products/Network-Cameras/Value-Series/' AS v,
    '{SITE}/en/products/IP-Products/Network-Cameras/Pro-Series-EasyIP-/DS-2CD' || s_suppkey || '/' AS p FROM supplier)
  SELECT page_id, 'series' AS kind, 'Value' AS name, v AS url FROM l UNION ALL SELECT page_id, 'product_series', 'Value', v FROM l
  UNION ALL SELECT page_id, 'product_series', 'Pro', p FROM l UNION ALL SELECT page_id, 'product', 'DS-2CD' || k || ' G2', p FROM l
  UNION ALL SELECT page_id, 'product', 'model ' || k, 'https://y.example/products/IP-Products/Network-Cameras/pt/model-' || k FROM l""")(
    lambda t: extract.site_links(t.link_pages, K, "catalog", SITE).select("page_id", "kind", "name", "url"))
