"""Domain tables as views over the given star-schema tables.

Each view is one SQL text that Spark and DuckDB both run, so a query and its oracle start from the same rows.
The texts name base tables and other views in braces; ``table`` resolves them to DataFrames, ``sql_text``
to nested subqueries.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations")

# half-year runs, for example 19950101_monthly_01
_RUN = "cast(year({0}) AS string) || CASE WHEN month({0}) <= 6 THEN '0101' ELSE '0701' END || '_monthly_01'"

VIEWS: dict[str, str] = {}

# One specification record per line item: the line picks the field, the quantity picks the raw text.
VIEWS["specs"] = f"""
SELECT {_RUN.format('l_shipdate')} AS run_id, p_brand AS brand, p_type AS series_l1,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS series_l2,
       CASE WHEN p_partkey % 101 = 5 THEN '' WHEN p_partkey % 11 = 3 THEN 'S' || cast(p_partkey % 7 AS string)
            ELSE 'M' || cast(p_partkey AS string) END AS product_model,
       field_code, field_name, raw_value,
       CASE WHEN l_suppkey % 17 = 3 THEN NULL WHEN l_suppkey % 19 = 4 THEN '  '
            ELSE lower(raw_value) END AS normalized_value,
       CASE WHEN unit IS NULL THEN NULL WHEN p_partkey % 7 = 0 THEN 'ft' WHEN p_partkey % 7 = 1 THEN NULL
            WHEN p_partkey % 7 = 2 THEN upper(unit) WHEN p_partkey % 7 = 3 AND unit = 'fps+px' THEN 'fps'
            WHEN p_partkey % 7 = 4 AND unit = 'fps+px' THEN 'FPS'
            ELSE unit END AS unit,
       value_type, 'https://x.example/' || cast(p_partkey AS string) AS source_url,
       CASE WHEN l_discount > 0.085 THEN cast(0.3 AS double) WHEN l_discount > 0.055 THEN cast(0.5 AS double)
            WHEN l_discount > 0.025 THEN cast(0.65 AS double) ELSE cast(1.0 AS double) END
         AS extract_confidence,
       l_tax > 0.065 AS is_manual_override, l_shipdate AS updated_at
FROM (
  SELECT *,
    CASE f WHEN 0 THEN 'image_sensor' WHEN 1 THEN 'max_resolution' WHEN 2 THEN 'lens_type'
           WHEN 3 THEN 'aperture' WHEN 4 THEN 'supplement_light_type' WHEN 5 THEN 'supplement_light_range'
           WHEN 6 THEN 'main_stream_max_fps_resolution' WHEN 7 THEN 'stream_count'
           WHEN 8 THEN 'interface_items' WHEN 9 THEN 'deep_learning_function_categories'
           WHEN 10 THEN 'approval_protection' ELSE 'approval_anti_corrosion_protection' END AS field_code,
    CASE f WHEN 0 THEN 'Image Sensor' WHEN 1 THEN 'Max. Resolution' WHEN 2 THEN 'Lens Type'
           WHEN 3 THEN 'Aperture' WHEN 4 THEN 'Supplement Light Type' WHEN 5 THEN 'Supplement Light Range'
           WHEN 6 THEN 'Main Stream Max FPS@Resolution' WHEN 7 THEN 'Stream Count'
           WHEN 8 THEN 'Interface' WHEN 9 THEN 'Deep Learning Function Categories'
           WHEN 10 THEN 'Approval.Protection' ELSE 'Approval.Anti-Corrosion Protection' END AS field_name,
    CASE f WHEN 1 THEN 'px' WHEN 3 THEN 'f' WHEN 5 THEN 'm' WHEN 6 THEN 'fps+px' WHEN 7 THEN 'count'
           WHEN 10 THEN 'grade' WHEN 11 THEN 'grade' ELSE NULL END AS unit,
    CASE f WHEN 5 THEN 'number_or_text' WHEN 7 THEN 'integer' WHEN 8 THEN 'list_text' WHEN 9 THEN 'list_text'
           ELSE 'text' END AS value_type,
    CASE WHEN l_suppkey % 23 = 1 THEN NULL WHEN l_suppkey % 29 = 2 THEN '' WHEN l_suppkey % 31 = 3 THEN '   '
         WHEN l_suppkey % 37 = 4 THEN 'Error: no value ' || t
         WHEN f = 0 THEN CASE v % 7 WHEN 0 THEN '1/2.8" Progressive Scan CMOS' WHEN 1 THEN '1/1.8" cmos'
              WHEN 2 THEN '1/2.7" Progressive Scan CMOS' WHEN 3 THEN 'CCD' WHEN 4 THEN ' 1/3" Progressive Scan CMOS '
              WHEN 5 THEN 'sensor type ' || t ELSE '1/2.8"' END
         WHEN f = 1 THEN CASE v % 8 WHEN 0 THEN '1920x1080' WHEN 1 THEN '4608 × 2592' WHEN 2 THEN '2592P'
              WHEN 3 THEN '5MP' WHEN 4 THEN '4 mp' WHEN 5 THEN '4K (3840x2160)'
              WHEN 6 THEN cast(320 + 48 * v AS string) || ' X ' || cast(240 + 36 * v AS string)
              ELSE 'unknown ' || t END
         WHEN f = 2 THEN CASE v % 3 WHEN 0 THEN 'Fixed focal  lens, ' || t || ' mm;' WHEN 1 THEN ' Vari-focal. '
              ELSE 'Motorized' END
         WHEN f = 3 THEN CASE v % 5 WHEN 0 THEN 'F1.6' WHEN 1 THEN 'f/2.0' WHEN 2 THEN '1.' || t
              WHEN 3 THEN 'Max F1.8' ELSE 'not stated' END
         WHEN f = 4 THEN CASE v % 6 WHEN 0 THEN 'IR + Warm Light' WHEN 1 THEN 'Infrared' WHEN 2 THEN 'White Light'
              WHEN 3 THEN 'Xenon' WHEN 4 THEN 'LED array' ELSE 'laser' END
         WHEN f = 5 THEN CASE v % 9 WHEN 0 THEN t || ' m' WHEN 1 THEN t || ' ft' WHEN 2 THEN '10-' || t || 'm'
              WHEN 3 THEN 'up to ' || t || 'm' WHEN 4 THEN t || ' inches' WHEN 5 THEN t || ' yd'
              WHEN 6 THEN t || '.5' WHEN 7 THEN 'far away' ELSE '5 ft ~ ' || t || ' ft' END
         WHEN f = 6 THEN CASE v % 6 WHEN 0 THEN t || 'fps (1920x1080)' WHEN 1 THEN '60fps@2560x1440'
              WHEN 2 THEN '25 FPS 2048x1536, 50 fps (1280 × 720)' WHEN 3 THEN t || ' fps'
              WHEN 4 THEN '1280x720 picture' ELSE 'n/a' END
         WHEN f = 7 THEN CASE v % 4 WHEN 0 THEN t || ' streams' WHEN 1 THEN 'Third Stream' WHEN 2 THEN t
              ELSE 'none' END
         WHEN f = 8 THEN CASE v % 5 WHEN 0 THEN 'RJ45, Audio, Alarm' WHEN 1 THEN 'a, A, b；c'
              WHEN 2 THEN '["HDMI","USB"]' WHEN 3 THEN ' ;, ' ELSE 'RS-485、BNC，HDMI ' || t END
         WHEN f = 9 THEN CASE v % 4 WHEN 0 THEN 'Line crossing detection, intrusion detection, face detection'
              WHEN 1 THEN 'SMD; IVS;SMD' WHEN 2 THEN 'Object removal、unattended baggage' ELSE 'AcuPick ' || t END
         WHEN f = 10 THEN CASE v % 4 WHEN 0 THEN 'IP67' WHEN 1 THEN 'ip66, IK10' WHEN 2 THEN 'IP54' ELSE 'IK08 ' END
         ELSE CASE v % 3 WHEN 0 THEN 'NEMA 4X' WHEN 1 THEN 'N/A' ELSE 'WF2 ' || t END END AS raw_value
  FROM (SELECT *, cast(cast(l_quantity AS int) AS string) AS t, cast(l_quantity AS int) AS v,
               (l_orderkey + l_linenumber * 5 + l_suppkey) % 12 AS f
        FROM {{lineitem}}) AS l0
) AS l JOIN {{part}} ON l_partkey = p_partkey
-- gaps: products without specs, products without one field, runs without another
WHERE p_partkey % 23 <> 6 AND NOT (f = 9 AND p_partkey % 5 = 2) AND NOT (f = 11 AND year(l_shipdate) = 1997)
"""

# One catalog entry per run, product and locale.
VIEWS["catalog"] = f"""
SELECT run_id, p_brand AS brand, p_type AS series_l1,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS series_l2,
       CASE WHEN p_partkey % 101 = 5 THEN '' WHEN p_partkey % 11 = 3 THEN 'S' || cast(p_partkey % 7 AS string)
            ELSE 'M' || cast(p_partkey AS string) END AS product_model,
       CASE WHEN p_partkey % 31 = 7 THEN '' ELSE p_name || ' ' || cast(p_size AS string) END AS product_name,
       CASE WHEN p_partkey % 41 = 8 THEN NULL WHEN p_partkey % 37 = 9 THEN 'ftp://x.example/' || cast(p_partkey AS string)
            ELSE 'https://x.example/' || cast(p_partkey AS string) END AS product_url,
       CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'N' THEN 'de' ELSE 'fr' END AS locale,
       first_seen_at, last_seen_at, 'current' AS catalog_status
FROM (SELECT {_RUN.format('l_shipdate')} AS run_id, l_partkey, l_returnflag,
             min(l_shipdate) AS first_seen_at, max(l_shipdate) AS last_seen_at
      FROM {{lineitem}} GROUP BY {_RUN.format('l_shipdate')}, l_partkey, l_returnflag) AS c
JOIN {{part}} ON l_partkey = p_partkey
"""

# One node per run and (brand, type, name); products without a name level give first-level nodes. One second-level
# node per brand is announced without products.
VIEWS["hierarchy"] = """
SELECT run_id, brand, CASE WHEN grouping(series_l1) = 1 THEN 'PROMO' ELSE series_l1 END AS series_l1,
       CASE WHEN grouping(series_l1) = 1 THEN 'announced' ELSE series_l2 END AS series_l2,
       'listing' AS series_source, 'active' AS series_status, min(first_seen_at) AS discovered_at
FROM {catalog} AS c GROUP BY GROUPING SETS ((run_id, brand, series_l1, series_l2), (run_id, brand))
"""

# One human correction per order.
VIEWS["manual"] = """
SELECT 'I' || cast(o_orderkey AS string) AS input_id,
       CASE WHEN o_orderkey % 29 = 3 THEN NULL ELSE p_brand END AS brand,
       CASE WHEN o_orderkey % 31 = 4 THEN '' ELSE p_type END AS series_l1,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS series_l2,
       CASE WHEN o_orderkey % 37 = 5 THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'X' || cast(o_custkey AS string)
            ELSE 'M' || cast(o_custkey AS string) END AS product_model,
       CASE o_orderkey % 12 WHEN 0 THEN 'image_sensor' WHEN 1 THEN 'max_resolution' WHEN 2 THEN 'lens_type'
           WHEN 3 THEN 'aperture' WHEN 4 THEN 'supplement_light_type' WHEN 5 THEN 'supplement_light_range'
           WHEN 6 THEN 'main_stream_max_fps_resolution' WHEN 7 THEN 'stream_count'
           WHEN 8 THEN 'interface_items' WHEN 9 THEN 'deep_learning_function_categories'
           WHEN 10 THEN 'approval_protection' ELSE 'approval_anti_corrosion_protection' END AS field_code,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'manual ' || cast(o_custkey AS string) || '/' || o_orderstatus END
         AS manual_value,
       CASE WHEN o_orderkey % 41 = 6 THEN '  ' ELSE o_orderpriority END AS operator,
       'checked by hand' AS reason, o_orderdate AS created_at
FROM {orders} JOIN {part} ON o_custkey = p_partkey
"""

# Stored issues with a workflow state: one per spec record with an unexpected unit or a blank value.
VIEWS["issues"] = """
SELECT run_id, brand, series_l1, series_l2, CASE WHEN product_model = '' THEN NULL ELSE product_model END AS product_model,
       CASE WHEN extract_confidence < 0.5 THEN 'parse_failed' WHEN raw_value IS NULL OR raw_value = '' THEN 'missing_field'
            WHEN unit = 'ft' THEN 'unit_abnormal' ELSE 'duplicate_model' END AS issue_type,
       field_code, 'stored issue' AS issue_detail,
       CASE WHEN extract_confidence < 0.5 THEN 'P1' WHEN unit = 'ft' THEN 'P3' ELSE 'P2' END AS severity,
       CASE WHEN is_manual_override THEN 'resolved' WHEN series_l2 IS NULL THEN 'in_progress' ELSE 'open' END AS status,
       CASE WHEN value_type = 'integer' THEN NULL ELSE 'owner ' || value_type END AS owner,
       updated_at AS created_at
FROM {specs} AS s
"""

# Two attempts per page; every third page is right at first and short later, the others the other way round.
VIEWS["fetch_log"] = """
SELECT url AS item_key, size >= 2000 AS success, url, size, CASE WHEN size >= 2000 THEN NULL ELSE 'too short' END AS error, page_id, attempt
FROM (SELECT url, page_id, attempt, cast(length(html) + CASE WHEN page_id % 3 = attempt - 1 THEN 2000 ELSE 0 END AS bigint) AS size
      FROM {pages} CROSS JOIN (VALUES (1), (2)) AS a(attempt)) AS l
"""

# One run record per half year of orders.
VIEWS["runs"] = f"""
SELECT {_RUN.format('o_orderdate')} AS run_id,
       CASE WHEN max(month(o_orderdate)) <= 6 THEN 'MONTHLY' ELSE 'BIWEEKLY' END AS schedule_type,
       min(o_orderdate) AS started_at, max(o_orderdate) AS ended_at,
       CASE WHEN min(year(o_orderdate)) % 3 = 0 THEN 'failed' ELSE 'completed' END AS status
FROM {{orders}} GROUP BY {_RUN.format('o_orderdate')}
"""

# Listing rows: the item as found next to the node it was collected under.
VIEWS["listing"] = """
SELECT p_partkey AS item_id, p_brand AS node_brand, p_type AS node_l1, p_name AS node_l2,
       CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) ELSE p_brand END AS brand,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS series_l1,
       CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE p_name END AS series_l2,
       'M' || cast(p_partkey AS string) AS product_model
FROM {part}
"""

# Product feed documents: one JSON text per part, two products each (the second repeats a shared model).
VIEWS["feed"] = """
SELECT p_partkey AS doc_pos,
  '{{"products":[{{"productModel":" DS-' || cast(p_partkey AS string) || '/A ","series":"' || p_type
  || ' Series","subseries":"' || p_name || '","detailPath":"'
  || CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN '/p/' || cast(p_partkey AS string)
          ELSE 'https://y.example/p/' || cast(p_partkey AS string) END
  || '","title":"Camera ' || cast(p_partkey AS string) || '"}},{{"productModel":"'
  || CASE WHEN p_size = 1 THEN '' ELSE 'SZ ' || cast(p_size AS string) END || '","series":"' || p_type
  || '","subseries":"' || p_brand || '","detailPath":"/s/' || cast(p_partkey AS string) || '"}}],"filters":{{}}}}' AS doc
FROM {part}
"""

# Product detail pages, one per part, in six layouts.
_CELLS = {
    "sensor": "CASE p_size % 3 WHEN 0 THEN '1/2.8&quot; Progressive Scan CMOS' WHEN 1 THEN '1/3&#34; CMOS' ELSE '-' END",
    "resolution": "cast(640 + 16 * p_size AS string) || ' &times; ' || cast(480 + 8 * p_size AS string)",
    "lens": "'Fixed &amp; ' || cast(p_size AS string) || ' mm'",
    "range": "CASE p_size % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN cast(p_size AS string) || ' ft' ELSE 'Up to ' || cast(p_size AS string) || ' m' END",
    "stream": "'50Hz: 25 fps (' || cast(640 + 16 * p_size AS string) || ' × 720)'",
    "interface": "'<ul><li>RJ45</li><li> Audio ' || cast(p_size AS string) || '</li></ul>'",
    "smart": "CASE p_size % 5 WHEN 0 THEN 'No' ELSE 'Line crossing, Face ' || cast(p_size AS string) END",
}


def _page(open_: str, between: str, end: str, close: str, rows: tuple[tuple[str, str], ...], before: str, after: str) -> str:
    body = " || ".join(f"'{open_}{label}{between}' || {_CELLS.get(cell, cell)} || '{end}'" for label, cell in rows)
    return f"'{before}' || {body} || '{after}{close}'"


_TABLE_ROWS = (("<b>Image</b> Sensor", "sensor"), ("Max. Resolution", "resolution"), ("Lens Type", "lens"),
               ("IR Range", "range"), ("Main Stream", "stream"), ("Interface", "interface"),
               ("Smart Event", "smart"), ("Protection", "'IP67, IK10'"))
_PLAIN_ROWS = (("Max. Resolution", "resolution"), ("Image Sensor", "sensor"), ("Lens Type", "lens"),
               ("Aperture", "'F1.' || cast(p_size AS string)"), ("IVS", "'Yes'"), ("Intelligence", "smart"),
               ("Sub Stream", "'none'"))

VIEWS["product_pages"] = f"""
SELECT p_partkey AS page_id, 'https://x.example/' || cast(p_partkey AS string) AS url,
  '<!DOCTYPE html><html><head><title>Item</title><style>.spec{{{{}}}}</style></head><body><!-- <tr><td>Lens Type</td><td>no</td></tr> -->'
  || CASE p_partkey % 6
     WHEN 0 THEN {_page('<tr class="r"><th>', '</th><td>', '</td></tr>', '</table>', _TABLE_ROWS,
                        '<table class="spec-table">', '')}
     WHEN 1 THEN {_page('<tr><td>', '</td><td>', '</td></tr>', '</table><p>Warm light, circle</p>', _PLAIN_ROWS,
                        '<table><!-- x -->', '')}
     WHEN 2 THEN {_page('<div class="main-item"><div class="item-title">', '</div><div class="item-title-detail">',
                        '</div></div>', '</section>', _TABLE_ROWS, '<section>', '')}
     WHEN 3 THEN {_page('<li>', ': ', '</li>', '</ul></div>', tuple(r for r in _TABLE_ROWS if r[1] != 'interface'),
                        '<div class="product-detail"><ul>', '')}
     WHEN 4 THEN {_page('<dt>', '</dt><dd>', '</dd>', '</dl>', _TABLE_ROWS, '<dl>', '')}
     ELSE '<div class="params"><p>Zoom ' || cast(p_size AS string) || 'm range F/1.' || cast(p_size AS string)
          || ' with 1280x720</p><p>white  light</p></div><script>var a = "999 m";</script>' END
  || '</body></html>' AS html
FROM {{part}}
"""

# Tables, lists and definition lists inside others of their kind; closing tags are left out where HTML allows it.
VIEWS["nested_pages"] = """
SELECT p_partkey AS page_id,
  '<table><tr><th>Size</th><td><table class="in"><tr><td>Width<td>' || cast(p_size AS string) || '</table></td></tr><tr><td>Lens Type</td><td>'
  || p_type || '</td></tr></table><ul><li>Ports<ul><li>RJ45: ' || cast(p_size AS string) || '</li></ul></li><li>Colour: ' || p_name
  || '</ul><dl><dt>Shared<dt>Housing</dt><dd>' || p_name || '<dl><dt>Brand</dt><dd>' || p_brand || '</dd><dt>Open</dl></dd><dt>Weight<dd>'
  || cast(p_size AS string) || '</dl>' AS html
FROM {part}
"""

# Pages that list specifications as items, label and value in elements of their own.
VIEWS["list_pages"] = """
SELECT p_partkey AS page_id,
  '<body><ul><li><span>Max Resolution</span><span>' || cast(640 + p_size AS string) || ' × 480</span></li>'
  || '<li><b>IR Range</b> <i>Up to ' || cast(p_size AS string) || ' m</i></li>'
  || '<li>Aperture<p>F1.' || cast(p_size AS string) || '</p></li>'
  || CASE WHEN p_size % 2 = 0 THEN '<li>Third Stream<p>yes</p></li>' ELSE '<li>Sub-stream<p>yes</p></li>' END
  || '<li>Main Stream<p>50Hz: 20 fps (' || cast(640 + p_size AS string) || ' × 480), 25 fps (320 × 240)</p></li>'
  || '<li>Communication Interface<p>RJ45 ' || cast(p_size AS string) || '</p></li>'
  || '<li>Video Output<p>' || CASE WHEN p_size % 3 = 0 THEN 'No' ELSE 'HDMI' END || '</p></li>'
  || '<li>On-board Storage<p>RJ45 ' || cast(p_partkey % 50 + 1 AS string) || '</p></li>'
  || '<li>Smart Event<p>Line crossing, face, other</p></li><li>Smart Event<p>second</p></li>'
  || '<li>Weatherproof Protection<p>IP' || cast(60 + p_size % 8 AS string) || ' &amp; more</p></li><li>Home</li></ul></body>' AS html
FROM {part}
"""

# Listing pages with product links, one per supplier nation entry.
VIEWS["link_pages"] = """
SELECT s_suppkey AS page_id,
  '<html><body><a href="/products/network-products/network-cameras/wizsense-' || cast(s_nationkey AS string) || '">S</a>'
  || '<a class="x" href="/network-cameras/pro/2-line/IPC-' || cast(s_suppkey AS string) || '-a"><h3 class="h3-seo">T</h3></a>'
  || '<a href=''/network-cameras/pro/2-line/dh-' || cast(s_nationkey AS string) || '''>Z</a>'
  || '<a href="/hk/products/IP-Products/Network-Cameras/Value-Series/">V</a>'
  || '<a href="/en/products/IP-Products/Network-Cameras/Pro-Series-EasyIP-/DS-2CD' || cast(s_suppkey AS string) || '/">'
  || '<h3 class="h3-seo">DS-2CD' || cast(s_suppkey AS string) || ' G2</h3> camera</a>'
  || '<a href="https://y.example/products/IP-Products/Network-Cameras/pt/model-' || cast(s_suppkey AS string) || '">go to it</a>'
  || '<a href="/products/IP-Products/Network-Cameras/pt/about">A</a></body></html>' AS html
FROM {supplier}
"""


def _names(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(sql) if name})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table (Parquet scan) or a view on it, as a DataFrame; nothing is run."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _names(sql)})


def sql_text(name: str) -> str:
    """The same view as one nested SELECT over the base tables."""
    if name in BASE:
        return name
    sql = VIEWS[name]
    return "(" + sql.format(**{n: sql_text(n) for n in _names(sql)}).strip() + ")"


def with_views(body: str, *names: str) -> str:
    """``WITH`` list of the named views followed by ``body``."""
    return "WITH " + ",\n".join(f"{n} AS {sql_text(n)}" for n in names) + "\n" + body
