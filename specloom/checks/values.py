"""Checks of value normalization on the raw texts of the spec table."""

from pyspark.sql import functions as F

from specloom.checks.base import check
from specloom.functions import values as V
from specloom.functions.text import is_blank
from specloom.operators import counterparts, extract, report

KEY = "run_id, product_model, field_code, raw_value"
SIZE = r"(\d{3,5})\s*[xX×]\s*(\d{3,5})"


def hit(text: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({text}, '{pattern}', {group}), '')"


SIZE_TEXT = f"({hit('r', SIZE)} || 'x' || {hit('r', SIZE, 2)})"
FPS_TEXT = hit("r", r"(?i)(\d+)\s*fps")
wide = lambda lines: f"(cast(floor(cast({lines} AS INT) * 16 / 9) AS BIGINT) || 'x' || {lines})"
number = lambda x: (f"CASE WHEN {x} = floor({x}) THEN cast(cast({x} AS BIGINT) AS VARCHAR) "
                    f"ELSE regexp_replace(printf('%.2f', {x}), '\\.?0+$', '') END")
metres = lambda unit, extra="": (
    f"CASE WHEN {unit} IN ('m', 'meter', 'meters', 'mt') THEN 1.0 WHEN {unit} IN ('ft', 'feet', 'foot') THEN 0.3048 "
    f"WHEN {unit} IN ('\"', 'in', 'inch'{extra}) THEN 0.0254 END::DOUBLE")
AMOUNT, UNIT = r"(\d+(?:\.\d+)?)\s*([a-zA-Z\"°]+)?", r"(\d+(?:\.\d+)?)\s*([a-zA-Z\"°]+)?"
value = f"cast({hit('r', AMOUNT)} AS DOUBLE)"
unit = f"lower({hit('r', AMOUNT, 2)})"
items = "list_filter(list_transform(string_split_regex(r, '[,;，、]'), lambda x: trim(x)), lambda x: x <> '')"
distinct = (f"list_filter({items}, lambda x, i: list_position(list_transform({items}, lambda y: lower(y)), lower(x)) = i)")
as_json = lambda xs: f"'[' || array_to_string(list_transform({xs}, lambda x: '\"' || x || '\"'), ', ') || ']'"


def alias(pairs) -> tuple[str, str]:
    low = [(a.lower().replace("'", "''"), b) for a, b in pairs]
    exact = "CASE " + " ".join(f"WHEN lower(trim(r)) = '{a}' THEN '{b}'" for a, b in low) + " END"
    part = "CASE " + " ".join(
        f"WHEN contains(lower(trim(r)), '{a}') OR contains('{a}', lower(trim(r))) THEN '{b}'" for a, b in low) + " END"
    return f"coalesce({exact}, {part}, trim(r))", f"CASE WHEN {exact} IS NOT NULL THEN '' WHEN {part} IS NOT NULL THEN 'Partial alias match' ELSE 'No alias match found' END"


SENSOR = alias((('1/2.8" Progressive Scan CMOS', '1/2.8" CMOS'), ('1/2.8" CMOS', '1/2.8" CMOS'), ('1/3" Progressive Scan CMOS', '1/3" CMOS'),
                ('1/1.8" Progressive Scan CMOS', '1/1.8" CMOS'), ('1/1.8" CMOS', '1/1.8" CMOS'), ("CMOS", "CMOS"), ("CCD", "CCD")))
LIGHT = alias((("smart supplement light", "Smart"), ("ir", "IR"), ("infrared", "IR"), ("white light", "White Light"), ("led", "LED"), ("laser", "Laser")))
GRADE = alias((("ip67", "IP67"), ("ip66", "IP66"), ("ik10", "IK10"), ("ik08", "IK08")))
LINES = hit("r", r"(\d{3,5})[pPiI]")

CASES = (  # field condition, value, unit, issue
    ("field_code = 'max_resolution'", f"coalesce({SIZE_TEXT}, {wide(LINES)})", f"CASE WHEN {SIZE_TEXT} IS NOT NULL OR {LINES} IS NOT NULL THEN 'px' END",
     f"CASE WHEN {SIZE_TEXT} IS NOT NULL THEN '' WHEN {LINES} IS NOT NULL THEN 'Derived from vertical resolution only' ELSE 'Could not parse resolution format' END"),
    ("field_code = 'main_stream_max_fps_resolution'", f"nullif(concat_ws(' ', {FPS_TEXT} || 'fps', '(' || {SIZE_TEXT} || ')'), '')",
     f"CASE WHEN {FPS_TEXT} IS NOT NULL OR {SIZE_TEXT} IS NOT NULL THEN 'fps+px' END",
     f"CASE WHEN {FPS_TEXT} IS NOT NULL AND {SIZE_TEXT} IS NOT NULL THEN '' WHEN {FPS_TEXT} IS NOT NULL THEN 'Resolution not found' "
     f"WHEN {SIZE_TEXT} IS NOT NULL THEN 'FPS not found' ELSE 'Could not parse stream info format' END"),
    ("field_code = 'supplement_light_range'",
     f"CASE WHEN {value} IS NULL THEN NULL WHEN {unit} IS NULL THEN cast({value} AS VARCHAR) WHEN {metres(unit)} IS NULL THEN r ELSE {number(f'({value} * {metres(unit)})')} END",
     f"CASE WHEN {value} IS NULL THEN NULL WHEN {unit} IS NULL OR {metres(unit)} IS NOT NULL THEN 'm' ELSE {unit} END",
     f"CASE WHEN {value} IS NULL THEN 'Could not parse distance format' WHEN {unit} IS NULL THEN 'No unit specified, assumed meters' "
     f"WHEN {metres(unit)} IS NULL THEN 'Unknown unit: ' || {unit} ELSE '' END"),
    ("field_code = 'aperture'", "'f/' || " + hit("r", r"(\d+(?:\.\d+)?)"), f"CASE WHEN {hit('r', '([0-9])')} IS NOT NULL THEN 'f' END",
     f"CASE WHEN {hit('r', '([0-9])')} IS NOT NULL THEN '' ELSE 'Could not parse aperture format' END"),
    ("field_code = 'stream_count'", hit("r", r"(\d+)"), f"CASE WHEN {hit('r', '([0-9])')} IS NOT NULL THEN 'count' END",
     f"CASE WHEN {hit('r', '([0-9])')} IS NOT NULL THEN '' ELSE 'Could not parse integer value' END"),
    ("field_code IN ('interface_items', 'deep_learning_function_categories') AND r LIKE '[%'", as_json("from_json(r, '[\"VARCHAR\"]')"), "NULL", "''"),
    ("field_code IN ('interface_items', 'deep_learning_function_categories')", f"CASE WHEN len({items}) > 0 THEN {as_json(distinct)} END", "NULL",
     f"CASE WHEN len({items}) > 0 THEN '' ELSE 'No list items found' END"),
    ("field_code = 'image_sensor'", SENSOR[0], "NULL", SENSOR[1]),
    ("field_code = 'supplement_light_type'", LIGHT[0], "NULL", LIGHT[1]),
    ("field_code LIKE 'approval%'", GRADE[0], "'grade'", GRADE[1]),
    ("TRUE", "trim(trim(regexp_replace(r, '\\s+', ' ', 'g')), '.,;:')", "NULL", "''"),
)
_pick = lambda i, blank: f"CASE WHEN coalesce(trim(r), '') = '' THEN {blank} " + " ".join(f"WHEN {c[0]} THEN {c[i]}" for c in CASES) + " END"
NORMAL = (f", n AS (SELECT {KEY}, {_pick(1, 'NULL')} AS normalized_value, {_pick(2, 'NULL')} AS unit, {_pick(3, repr('Empty value'))} AS issues "
          "FROM (SELECT *, cast(raw_value AS VARCHAR) AS r FROM specs) AS s)")


@check("N1_normalize", NORMAL + " SELECT * FROM n", "specs")
def _(t):
    return extract.normalize_specs(t.specs).select(*KEY.split(", "), "normalized_value", "unit", F.array_join("issues", "; ").alias("issues"))


def on_field(name: str, field: str, body: str, **columns):
    """A column program over the raw texts of one field."""
    sql = f"SELECT {KEY}, {body} FROM (SELECT *, raw_value AS r FROM specs WHERE field_code = '{field}') AS s"
    check(name, sql, "specs")(lambda t: t.specs.where(F.col("field_code") == field).select(
        *KEY.split(", "), *[make(F.col("raw_value")).alias(n) for n, make in columns.items()]))


MP = f"{hit('r', '(?i)([0-9]+(?:[.][0-9]+)?) *MP')} || 'MP'"
MP_SIZE = (f"CASE {MP} WHEN '12MP' THEN '4096x2160' WHEN '8MP' THEN '3840x2160' WHEN '6MP' THEN '3072x2048' WHEN '5MP' THEN '2592x1944' "
           "WHEN '4MP' THEN '2560x1440' WHEN '3MP' THEN '2048x1536' WHEN '2MP' THEN '1920x1080' WHEN '1MP' THEN '1280x720' END")
PARSED = f"coalesce({SIZE_TEXT}, {wide(hit('r', '([0-9]{3,5})[pP]'))}, {MP_SIZE})"
on_field("N2_resolution", "max_resolution", f"{PARSED} AS size", size=V.parse_resolution)

PROFILE = f""", z AS (SELECT {KEY}, {PARSED} AS size FROM (SELECT *, raw_value AS r FROM specs WHERE field_code = 'max_resolution') AS s),
  d AS (SELECT *, try_cast(split_part(size, 'x', 1) AS INT) AS w, try_cast(split_part(size, 'x', 2) AS INT) AS h FROM z),
  p AS (SELECT *, coalesce(w BETWEEN 320 AND 8192 AND h BETWEEN 240 AND 4320, FALSE) AS valid FROM d)"""
check("N3_resolution_profile", PROFILE + f""" SELECT {KEY}, size, valid, CASE WHEN valid THEN round(w * h / 1000000.0::DOUBLE, 1) END AS megapixels,
  CASE WHEN valid THEN (w // gcd(w, h)) || ':' || (h // gcd(w, h)) END AS aspect,
  CASE WHEN valid THEN cast(sign(round(w * h / 1000000.0::DOUBLE, 1) - 2.1::DOUBLE) AS INT) ELSE 0 END AS against_hd FROM p""", "specs")(
    lambda t: t.specs.where("field_code = 'max_resolution'").select(*KEY.split(", "), V.parse_resolution(F.col("raw_value")).alias("size")).select(
        "*", V.valid_resolution(F.col("size")).alias("valid"), V.megapixels(F.col("size")).alias("megapixels"),
        V.aspect_ratio(F.col("size")).alias("aspect"), V.compare_resolutions(F.col("size"), F.lit("1920x1080")).alias("against_hd")))

FULL = r"(?i)(\d+)\s*fps[\s@\(]*\(?(\d{3,5})\s*[xX×]\s*(\d{3,5})\)?"
fps = f"cast(coalesce({hit('r', FULL)}, {FPS_TEXT}) AS BIGINT)"
width = f"cast(coalesce({hit('r', FULL, 2)}, {hit('r', SIZE)}) AS BIGINT)"
height = f"cast(coalesce({hit('r', FULL, 3)}, {hit('r', SIZE, 2)}) AS BIGINT)"
on_field("N4_stream", "main_stream_max_fps_resolution",
         f"{fps} AS fps, {width} AS width, {height} AS height, nullif(concat_ws(' ', {fps} || 'fps', '(' || {width} || 'x' || {height} || ')'), '') AS stream",
         fps=lambda r: V.parse_stream(r).fps_value, width=lambda r: V.parse_stream(r).resolution_width,
         height=lambda r: V.parse_stream(r).resolution_height, stream=lambda r: V.parse_stream(r).normalized)
on_field("N5_stream_forms", "main_stream_max_fps_resolution",
         f"""CASE WHEN coalesce({fps}, {width}) IS NOT NULL THEN '{{' || concat_ws(', ', '"fps_value": ' || {fps}, '"resolution_width": ' || {width},
         '"resolution_height": ' || {height}) || '}}' END AS as_json,
         CASE WHEN regexp_matches(r, '(\\d+)\\s*fps\\s*\\((\\d+)\\s*[×xX]\\s*(\\d+)\\)') THEN regexp_replace(regexp_extract(r, '(\\d+)\\s*fps\\s*\\((\\d+)\\s*[×xX]\\s*(\\d+)\\)'),
         '(\\d+)\\s*fps\\s*\\((\\d+)\\s*[×xX]\\s*(\\d+)\\)', '\\1fps@\\2x\\3') ELSE r END AS at_form""",
         as_json=lambda r: V.stream_json(V.parse_stream(r)), at_form=V.stream_at)
check("N6_many_streams", f""", e AS (SELECT run_id, product_model, raw_value, trim(unnest(string_split_regex(raw_value, '(?i)[,;\\n]|Stream\\s*\\d*'))) AS r
    FROM specs WHERE field_code IN ('main_stream_max_fps_resolution', 'stream_count'))
  SELECT run_id, product_model, raw_value, concat_ws(' ', {fps} || 'fps', '(' || {width} || 'x' || {height} || ')') AS stream FROM e
  WHERE coalesce({fps}, {width}) IS NOT NULL""", "specs")(
    lambda t: t.specs.where("field_code IN ('main_stream_max_fps_resolution', 'stream_count')").select(
        "run_id", "product_model", "raw_value", F.explode(V.parse_streams(F.col("raw_value"))).alias("s")).select(
        "run_id", "product_model", "raw_value", F.col("s.normalized").alias("stream")))
on_field("N7_stream_order", "main_stream_max_fps_resolution",
         f"coalesce(cast(sign({fps} - 30) AS INT), 0) AS by_fps, coalesce(cast(sign({width} * {height} - 1920 * 1080) AS INT), 0) AS by_size",
         by_fps=lambda r: V.compare_fps(r, F.lit("30fps")), by_size=lambda r: V.compare_stream_sizes(r, F.lit("1920x1080")))

RANGE_SQL = r"""(\d+(?:\.\d+)?)\s*([a-zA-Z"°]+)?\s*[-~]\s*(\d+(?:\.\d+)?)\s*([a-zA-Z"°]+)?"""
LIMIT_SQL = r"""(?i)(?:up\s+to|maximum|max|≤\s*|<=\s*)\s*(\d+(?:\.\d+)?)\s*([a-zA-Z"°]+)?"""
DIST = f""", f AS (SELECT {KEY}, CASE WHEN regexp_matches(r, '{LIMIT_SQL}') THEN 'limit' WHEN regexp_matches(r, '{RANGE_SQL}') THEN 'span'
      WHEN regexp_matches(r, '{AMOUNT}') THEN 'single' END AS kind, r FROM (SELECT *, raw_value AS r FROM specs WHERE field_code = 'supplement_light_range') AS s),
  g AS (SELECT *, cast(CASE kind WHEN 'span' THEN {hit('r', RANGE_SQL)} END AS DOUBLE) AS lo,
      cast(CASE kind WHEN 'limit' THEN {hit('r', LIMIT_SQL)} WHEN 'span' THEN {hit('r', RANGE_SQL, 3)} WHEN 'single' THEN {hit('r', AMOUNT)} END AS DOUBLE) AS hi,
      lower(coalesce(CASE kind WHEN 'limit' THEN {hit('r', LIMIT_SQL, 2)} WHEN 'span' THEN coalesce({hit('r', RANGE_SQL, 2)}, {hit('r', RANGE_SQL, 4)})
      WHEN 'single' THEN {hit('r', AMOUNT, 2)} END, 'm')) AS u FROM f),
  k AS (SELECT *, {metres('u', ", 'inches'")} AS m FROM g),
  x AS (SELECT *, {number('(lo * m)')} AS lo_m, {number('(hi * m)')} AS hi_m FROM k)"""
check("N9_distance_range", DIST + f""" SELECT {KEY}, CASE kind WHEN 'limit' THEN 'up to ' || hi_m || 'm' WHEN 'span' THEN lo_m || '-' || hi_m || 'm'
  WHEN 'single' THEN hi_m || 'm' END AS distance, CASE WHEN kind IS NOT NULL THEN u END AS unit,
  CASE WHEN kind IS NOT NULL AND m IS NULL THEN 'Unknown unit: ' || u END AS error FROM x""", "specs")(
    lambda t: t.specs.where("field_code = 'supplement_light_range'").select(*KEY.split(", "), V.parse_distance(F.col("raw_value")).alias("d")).select(
        *KEY.split(", "), F.col("d.normalized").alias("distance"), "d.unit", "d.error"))
check("N10_distance_profile", DIST + f""" SELECT {KEY}, cast(hi_m AS DOUBLE) AS max_m, cast(lo_m AS DOUBLE) AS min_m, coalesce(kind = 'span' AND m IS NOT NULL, FALSE) AS ranged,
  coalesce(r LIKE '%m' AND kind IS NOT NULL AND m IS NOT NULL, FALSE) AS valid, coalesce(cast(sign(cast(hi_m AS DOUBLE) - 20) AS INT), 0) AS against_20 FROM x""", "specs")(
    lambda t: t.specs.where("field_code = 'supplement_light_range'").select(*KEY.split(", "), V.parse_distance(F.col("raw_value")).alias("d")).select(
        *KEY.split(", "), V.max_metres(F.col("d")).alias("max_m"), V.min_metres(F.col("d")).alias("min_m"), V.is_range(F.col("d")).alias("ranged"),
        V.valid_distance(F.col("raw_value")).alias("valid"), V.compare_distances(F.col("raw_value"), F.lit("20m")).alias("against_20")))
_single = {"N8_distance": ("supplement_light_range", 2, V.distance_value), "N11_aperture": ("aperture", 3, V.aperture_value),
           "N11_integer": ("stream_count", 4, V.integer_value), "N11_sensor_alias": ("image_sensor", 7, lambda r: V.alias_value(r, V.R.SENSOR_ALIASES)),
           "N11_text": ("lens_type", 10, V.text_value)}
for _name, (_field, _i, _make) in _single.items():
    check(_name, f"SELECT {KEY}, {CASES[_i][1]} AS normalized_value, {CASES[_i][3]} AS issue FROM (SELECT *, raw_value AS r FROM specs "
          f"WHERE field_code = '{_field}') AS s", "specs")(
        lambda t, _field=_field, _make=_make: t.specs.where(F.col("field_code") == _field).select(
            *KEY.split(", "), _make(F.col("raw_value")).alias("n")).select(
            *KEY.split(", "), "n.normalized_value", F.array_join("n.issues", "; ").alias("issue")))
check("N11_list_items", f"""SELECT {KEY}, CASE WHEN r LIKE '[%' THEN array_to_string(from_json(r, '["VARCHAR"]'), '|') ELSE array_to_string({distinct}, '|') END AS items
  FROM (SELECT *, raw_value AS r FROM specs WHERE field_code IN ('interface_items', 'deep_learning_function_categories')) AS s""", "specs")(
    lambda t: t.specs.where("field_code IN ('interface_items', 'deep_learning_function_categories')").select(
        *KEY.split(", "), F.array_join(V.list_items(F.col("raw_value")), "|").alias("items")))

EVENTS = f"""list_sort(list_distinct(list_filter(list_transform({items}, lambda x: CASE WHEN contains(lower(x), 'line crossing') THEN 'Line Crossing Detection'
  WHEN contains(lower(x), 'intrusion') THEN 'Intrusion Detection' WHEN contains(lower(x), 'unattended') OR contains(lower(x), 'baggage') THEN 'Unattended Baggage Detection'
  WHEN contains(lower(x), 'object removal') THEN 'Object Removal Detection' WHEN contains(lower(x), 'face') THEN 'Face Detection'
  WHEN contains(lower(x), 'scene change') THEN 'Scene Change Detection' END), lambda x: x IS NOT NULL)))"""
on_field("N13_smart_events", "deep_learning_function_categories", f"CASE WHEN len({EVENTS}) > 0 THEN {as_json(EVENTS)} ELSE r END AS categories",
         categories=V.smart_event_categories)
on_field("N15_light_type", "supplement_light_type", """CASE WHEN r IS NULL THEN NULL WHEN contains(lower(r), 'white light') THEN 'White Light' WHEN contains(lower(r), 'laser') THEN 'Laser'
  WHEN contains(lower(r), 'led') AND NOT contains(lower(r), 'ir led') THEN 'LED'
  WHEN contains(lower(r), 'infrared') OR (contains(lower(r), 'ir') AND NOT contains(lower(r), 'wire')) THEN 'IR' ELSE '' END AS light""",
         light=lambda r: F.when(r.isNotNull(), V.light_type(r)))

def dist_chain(source: str) -> str:
    """Distance parts of column r of a relation, as nested steps."""
    kind = f"""SELECT *, CASE WHEN regexp_matches(r, '{LIMIT_SQL}') THEN 'limit' WHEN regexp_matches(r, '{RANGE_SQL}') THEN 'span'
      WHEN regexp_matches(r, '{AMOUNT}') THEN 'single' END AS kind FROM {source}"""
    parts = f"""SELECT *, cast(CASE kind WHEN 'span' THEN {hit('r', RANGE_SQL)} END AS DOUBLE) AS lo, cast(CASE kind WHEN 'limit' THEN {hit('r', LIMIT_SQL)} WHEN 'span' THEN {hit('r', RANGE_SQL, 3)} WHEN 'single' THEN {hit('r', AMOUNT)} END AS DOUBLE) AS hi,
      lower(coalesce(CASE kind WHEN 'limit' THEN {hit('r', LIMIT_SQL, 2)} WHEN 'span' THEN coalesce({hit('r', RANGE_SQL, 2)}, {hit('r', RANGE_SQL, 4)})
      WHEN 'single' THEN {hit('r', AMOUNT, 2)} END, 'm')) AS u FROM ({kind}) AS k1"""
    factor = f"SELECT *, {metres('u', ", 'inches'")} AS m FROM ({parts}) AS k2"
    return f"SELECT *, cast({number('(hi * m)')} AS DOUBLE) AS max_m, cast({number('(lo * m)')} AS DOUBLE) AS min_m FROM ({factor}) AS k3"


ORDER_KEY = f"""CASE field_code
  WHEN 'max_resolution' THEN CASE WHEN try_cast(split_part(size, 'x', 1) AS INT) BETWEEN 320 AND 8192 AND try_cast(split_part(size, 'x', 2) AS INT) BETWEEN 240 AND 4320
    THEN round(try_cast(split_part(size, 'x', 1) AS INT) * try_cast(split_part(size, 'x', 2) AS INT) / 1000000.0::DOUBLE, 1) END
  WHEN 'supplement_light_range' THEN max_m WHEN 'main_stream_max_fps_resolution' THEN fps
  WHEN 'aperture' THEN num WHEN 'stream_count' THEN num END"""
# the alias tables once more, written out for the oracle (fixed values)
ALIAS = """CASE WHEN field_code = 'image_sensor' THEN CASE lower(r) WHEN '1/2.8" progressive scan cmos' THEN '1/2.8" cmos' WHEN '1/3" progressive scan cmos' THEN '1/3" cmos'
    WHEN '1/1.8" progressive scan cmos' THEN '1/1.8" cmos' ELSE lower(r) END
  WHEN field_code = 'supplement_light_type' THEN CASE lower(r) WHEN 'smart supplement light' THEN 'smart' WHEN 'infrared' THEN 'ir' ELSE lower(r) END ELSE lower(r) END"""
NORM_ITEMS = f"""CASE WHEN r LIKE '[%' THEN from_json(r, '["VARCHAR"]') ELSE {items} END"""
LATEST = f""", one AS (SELECT brand, product_model, field_code, normalized_value AS r FROM (SELECT *, row_number() OVER (PARTITION BY brand, product_model, field_code
    ORDER BY updated_at DESC, normalized_value DESC) AS k FROM specs WHERE normalized_value IS NOT NULL) AS q WHERE k = 1),
  dist AS ({dist_chain('one')}),
  feat AS (SELECT brand, product_model, field_code, r, {ORDER_KEY} AS ord, size, max_m, min_m, num, stream, alias, list_sort(list_distinct(list_transform({NORM_ITEMS}, lambda x: lower(x)))) AS items
    FROM (SELECT *, {PARSED} AS size, {fps} AS fps, {ALIAS} AS alias,
      nullif(concat_ws(' ', {fps} || 'fps', '(' || {width} || 'x' || {height} || ')'), '') AS stream, try_cast({hit('r', '([0-9]+(?:[.][0-9]+)?)')} AS DOUBLE) AS num FROM dist) AS z),
  pairs AS (SELECT a.p_brand AS left_brand, 'M' || a.p_partkey AS left_model, b.p_brand AS right_brand, 'M' || b.p_partkey AS right_model
    FROM part AS a JOIN part AS b ON b.p_partkey = a.p_partkey + 1)"""


SAME = """coalesce(CASE WHEN a.field_code IN ('interface_items', 'deep_learning_function_categories') THEN a.items = b.items
    WHEN a.field_code = 'max_resolution' THEN a.size = b.size WHEN a.field_code = 'supplement_light_range' THEN a.max_m = b.max_m AND a.min_m IS NOT DISTINCT FROM b.min_m
    WHEN a.field_code = 'main_stream_max_fps_resolution' THEN a.stream = b.stream WHEN a.field_code IN ('aperture', 'stream_count') THEN a.num = b.num
    ELSE a.alias = b.alias END, lower(a.r) = lower(b.r))"""
check("N12_counterparts", LATEST + f""", n AS (SELECT a.brand || ' ' || a.product_model AS left_model, b.brand || ' ' || b.product_model AS right_model, count(*)::INT AS same_fields
    FROM feat AS a JOIN feat AS b ON b.field_code = a.field_code AND substr(a.brand, 1, 7) = 'Brand#1' AND substr(b.brand, 1, 7) = 'Brand#2' WHERE {SAME} GROUP BY 1, 2)
  SELECT left_model, right_model, same_fields, cast(row_number() OVER w AS INT) AS rank FROM n WHERE same_fields >= 2
  WINDOW w AS (PARTITION BY left_model ORDER BY same_fields DESC, right_model) QUALIFY row_number() OVER w <= 3""", "specs")(
    # brands of one first digit are taken together
    lambda t: counterparts.counterparts(t.specs.withColumns({"product_model": F.concat_ws(" ", "brand", "product_model"), "brand": F.substring("brand", 1, 7)}),
                                        "Brand#1", "Brand#2", most=3, least=2))


@check("N12_compare_products", LATEST + """ SELECT left_brand, left_model, right_brand, right_model, a.field_code, a.r AS left_value, b.r AS right_value,
  coalesce(CASE WHEN a.field_code IN ('interface_items', 'deep_learning_function_categories') THEN a.items = b.items
    WHEN a.field_code = 'max_resolution' THEN a.size = b.size WHEN a.field_code = 'supplement_light_range' THEN a.max_m = b.max_m AND a.min_m IS NOT DISTINCT FROM b.min_m
    WHEN a.field_code = 'main_stream_max_fps_resolution' THEN a.stream = b.stream WHEN a.field_code IN ('aperture', 'stream_count') THEN a.num = b.num
    ELSE a.alias = b.alias END, lower(a.r) = lower(b.r)) AS same,
  CASE WHEN a.field_code IN ('max_resolution', 'supplement_light_range', 'main_stream_max_fps_resolution', 'aperture', 'stream_count')
    THEN CASE WHEN a.ord < b.ord THEN -1 WHEN a.ord > b.ord THEN 1 ELSE 0 END END AS ordering
  FROM pairs JOIN feat AS a ON a.brand = left_brand AND a.product_model = left_model
  JOIN feat AS b ON b.brand = right_brand AND b.product_model = right_model AND b.field_code = a.field_code""", "specs")
def _(t):
    # every product against the one with the next key
    key = F.col("p_partkey")
    name = lambda side: (F.col("p_brand").alias(f"{side}_brand"), F.concat(F.lit("M"), key.cast("string")).alias(f"{side}_model"))
    left, right = t.part.select(*name("left"), (key + 1).alias("k")), t.part.select(*name("right"), key.alias("k"))
    return report.compare_products(t.specs, left.join(right, "k").drop("k")).drop("comparison_rule")
