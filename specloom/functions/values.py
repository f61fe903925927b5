"""Value normalization as column expressions.

Every ``*_value`` function returns ``struct<normalized_value, unit, issues>``; parsers return a struct of the
parsed parts. A column that is not needed costs nothing: Catalyst prunes it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from specloom import registry as R
from specloom.functions.text import (
    STRINGS, first_match, first_wins, float_text, found, is_blank, json_list, let, plain_number,
    split_items, strings, strip,
)

# --- fixed values: value formats -------------------------------------------------------------------
SIZE = r"(?U)([0-9]{3,5})\s*[xX×]\s*([0-9]{3,5})"
SIZE_SIGN = r"(?U)\s*[xX×]\s*"
LINES = r"([0-9]{3,5})[pPiI]"
LINES_P = r"([0-9]{3,5})[pP]"
MEGAPIXEL = r"(?iU)([0-9]+(?:\.[0-9]+)?)\s*MP"
FPS = r"(?iU)([0-9]+)\s*fps"
FPS_AND_SIZE = r"(?iU)([0-9]+)\s*fps[\s@\(]*\(?([0-9]{3,5})\s*[xX×]\s*([0-9]{3,5})\)?"
NUMBER = r"([0-9]+(?:\.[0-9]+)?)"
UNIT = r"""([a-zA-Z"'°]+)?"""
AMOUNT = rf"(?U){NUMBER}\s*{UNIT}"
SPAN = rf"(?U){NUMBER}\s*{UNIT}\s*[-~]\s*{NUMBER}\s*{UNIT}"
LIMIT = rf"(?iU)(?:up\s+to|maximum|max|≤\s*|<=\s*)\s*{NUMBER}\s*{UNIT}"
STREAM_BREAK = r"(?iU)[,;\n]|Stream\s*[0-9]*"

def _null() -> Column:
    return F.lit(None).cast("string")


def _value(value: Column, unit: str | Column | None, *issues: str | Column) -> Column:
    unit_col = unit if isinstance(unit, Column) else F.lit(unit).cast("string")
    texts = F.array(*issues) if any(isinstance(i, Column) for i in issues) else strings(*issues)
    return F.struct(value.alias("normalized_value"), unit_col.alias("unit"), texts.alias("issues"))


def _size_text(raw: Column) -> Column:
    return F.regexp_replace(found(raw, SIZE, 0), SIZE_SIGN, "x")


def _wide_size(lines: Column) -> Column:
    """16:9 width for a line count, as 'WxH'."""
    return F.concat(F.floor(lines.cast("int") * 16 / 9).cast("string"), F.lit("x"), lines)


# --- one field each --------------------------------------------------------------------------------

def resolution_value(raw: Column) -> Column:
    size, lines = _size_text(raw), found(raw, LINES)
    return (F.when(size.isNotNull(), _value(size, "px"))
            .when(lines.isNotNull(), _value(_wide_size(lines), "px", "Derived from vertical resolution only"))
            .otherwise(_value(_null(), None, "Could not parse resolution format")))


def stream_value(raw: Column) -> Column:
    fps, size = found(raw, FPS), _size_text(raw)
    rate, box = F.concat(fps, F.lit("fps")), F.concat(F.lit("("), size, F.lit(")"))
    return (F.when(fps.isNotNull() & size.isNotNull(), _value(F.concat_ws(" ", rate, box), "fps+px"))
            .when(fps.isNotNull(), _value(rate, "fps+px", "Resolution not found"))
            .when(size.isNotNull(), _value(box, "fps+px", "FPS not found"))
            .otherwise(_value(_null(), None, "Could not parse stream info format")))


def distance_value(raw: Column) -> Column:
    amount = found(raw, AMOUNT, 1).cast("double")
    unit = F.lower(found(raw, AMOUNT, 2))
    factor = R.lookup(unit, R.METRES_PER_UNIT)
    return (F.when(amount.isNull(), _value(_null(), None, "Could not parse distance format"))
            .when(unit.isNull(), _value(float_text(amount), "m", "No unit specified, assumed meters"))
            .when(factor.isNotNull(), _value(plain_number(amount * factor), "m"))
            .otherwise(_value(raw, unit, F.concat(F.lit("Unknown unit: "), unit))))


def aperture_value(raw: Column) -> Column:
    number = found(raw, NUMBER)
    return (F.when(number.isNotNull(), _value(F.concat(F.lit("f/"), number), "f"))
            .otherwise(_value(_null(), None, "Could not parse aperture format")))


def integer_value(raw: Column) -> Column:
    number = found(raw, "([0-9]+)")
    return (F.when(number.isNotNull(), _value(number, "count"))
            .otherwise(_value(_null(), None, "Could not parse integer value")))


def list_items(raw: Column) -> Column:
    """Items of a list text: a JSON array as it is, else separated text without repeats."""
    parsed = F.when(strip(raw).startswith("["), F.from_json(raw, STRINGS))
    return F.when(parsed.isNotNull(), F.transform(parsed, lambda x: F.coalesce(x, F.lit("None")))).otherwise(
        first_wins(split_items(raw)))


def list_value(raw: Column) -> Column:
    items = list_items(raw)
    is_json = F.coalesce(strip(raw).startswith("[") & F.from_json(raw, STRINGS).isNotNull(), F.lit(False))
    kind = F.schema_of_variant(F.try_parse_json(raw))
    mixed = is_json & (F.size(items) > 0) & (kind != "ARRAY<STRING>")
    return (F.when(mixed, _value(json_list(items), None, "Converted non-string items to strings"))
            .when(is_json | (F.size(items) > 0), _value(json_list(items), None))
            .otherwise(_value(_null(), None, "No list items found")))


def alias_value(raw: Column, aliases: tuple[tuple[str, str], ...], unit: str | None = None) -> Column:
    text = strip(raw)
    low = F.lower(text)
    lowered = [(a.lower(), canonical) for a, canonical in aliases]
    exact = first_match(low, lowered, lambda c, a: c == a)
    part = first_match(low, lowered, lambda c, a: F.contains(c, F.lit(a)) | F.contains(F.lit(a), c))
    return (F.when(exact.isNotNull(), _value(exact, unit))
            .when(part.isNotNull(), _value(part, unit, "Partial alias match"))
            .otherwise(_value(text, unit, "No alias match found")))


def clean_text(raw: Column) -> Column:
    return strip(F.regexp_replace(raw, r"(?U)\s+", " "))


def text_value(raw: Column) -> Column:
    return _value(F.btrim(clean_text(raw), F.lit(".,;:，、；：")), None)


def field_value(field: Column, raw: Column, strict_units: bool = False) -> Column:
    """Dispatch on the field code. ``strict_units`` leaves approval grades without a unit."""
    grade = None if strict_units else "grade"
    return (F.when(is_blank(raw), _value(_null(), None, "Empty value"))
            .when(field == "max_resolution", resolution_value(raw))
            .when(field == "main_stream_max_fps_resolution", stream_value(raw))
            .when(field == "supplement_light_range", distance_value(raw))
            .when(field == "aperture", aperture_value(raw))
            .when(field == "stream_count", integer_value(raw))
            .when(field.isin(*R.LIST_FIELDS), list_value(raw))
            .when(field == "image_sensor", alias_value(raw, R.SENSOR_ALIASES))
            .when(field == "supplement_light_type", alias_value(raw, R.LIGHT_ALIASES))
            .when(field.isin("approval_protection", "approval_anti_corrosion_protection"),
                  alias_value(raw, R.PROTECTION_ALIASES, grade))
            .otherwise(text_value(raw)))


# --- resolution ------------------------------------------------------------------------------------

def parse_resolution(raw: Column) -> Column:
    """'WxH' from a size, a line count or a megapixel label; NULL when none is found."""
    lines = found(raw, LINES_P)
    label = F.concat(found(raw, MEGAPIXEL), F.lit("MP"))
    return F.coalesce(_size_text(raw), F.when(lines.isNotNull(), _wide_size(lines)), R.lookup(label, R.MEGAPIXEL_SIZES))


def _dimension(size: Column, index: int) -> Column:
    return F.split_part(size, F.lit("x"), F.lit(index)).try_cast("int")


def valid_resolution(size: Column) -> Column:
    shape = size.rlike("^[0-9]{3,5}x[0-9]{3,5}$")
    return F.coalesce(shape & _dimension(size, 1).between(320, 8192) & _dimension(size, 2).between(240, 4320),
                      F.lit(False))


def megapixels(size: Column) -> Column:
    pixels = _dimension(size, 1).cast("bigint") * _dimension(size, 2)
    return F.when(valid_resolution(size), F.round(pixels / F.lit(1000000.0), 1))


def greatest_common_divisor(a: Column, b: Column) -> Column:
    """Euclid as a fold; 40 steps are enough for any pair of 28-bit numbers."""
    start = F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    step = lambda s, _: F.when(s.b == 0, s).otherwise(F.struct(s.b.alias("a"), F.pmod(s.a, s.b).alias("b")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, step, lambda s: s.a)


def aspect_ratio(size: Column) -> Column:
    w, h = _dimension(size, 1), _dimension(size, 2)
    g = greatest_common_divisor(w, h)
    ratio = F.concat((w / g).cast("int").cast("string"), F.lit(":"), (h / g).cast("int").cast("string"))
    return F.when(valid_resolution(size), ratio)


def compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1; 0 when either side is unknown."""
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def compare_resolutions(a: Column, b: Column) -> Column:
    return compare(megapixels(a), megapixels(b))


# --- streams ---------------------------------------------------------------------------------------

def _present(raw: Column) -> Column:
    """Not NULL, asked by a lambda: that keeps the long expression it guards out of whole-stage code, where it would be one
    method too long to compile, and has it compiled as a projection, which Spark splits into methods."""
    return let(raw, lambda x: x.isNotNull())


def parse_stream(raw: Column) -> Column:
    """struct<fps_value, resolution_width, resolution_height, normalized>, NULL when nothing is found."""
    full = found(raw, FPS_AND_SIZE, 0)
    text = F.coalesce(full, raw)
    fps = F.coalesce(found(full, FPS_AND_SIZE, 1), found(text, FPS)).try_cast("bigint")
    width = F.coalesce(found(full, FPS_AND_SIZE, 2), found(text, SIZE, 1)).try_cast("bigint")
    height = F.coalesce(found(full, FPS_AND_SIZE, 3), found(text, SIZE, 2)).try_cast("bigint")
    # zero counts as not found, except in a complete match
    has_fps = full.isNotNull() | (F.coalesce(fps, F.lit(0)) != 0)
    has_size = full.isNotNull() | (F.coalesce(width, F.lit(0)) != 0)
    rate = F.when(has_fps, F.format_string("%dfps", fps))
    box = F.when(has_size, F.format_string("(%dx%d)", width, height))
    parsed = F.struct(fps.alias("fps_value"), width.alias("resolution_width"), height.alias("resolution_height"),
                      F.concat_ws(" ", rate, box).alias("normalized"))
    return F.when(_present(raw) & (has_fps | has_size), parsed)


def stream_json(stream: Column) -> Column:
    """JSON text of the parsed numbers, leaving out missing ones."""
    parts = [F.concat(F.lit(f'"{n}": '), stream[n].cast("string"))
             for n in ("fps_value", "resolution_width", "resolution_height")]
    return F.when(stream.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))


def stream_at(raw: Column) -> Column:
    """List-page form 'Nfps@WxH' of the first complete entry, else the text itself."""
    pattern = r"(?U)([0-9]+)\s*fps\s*\(([0-9]+)\s*[×xX]\s*([0-9]+)\)"
    parts = [F.regexp_extract(raw, pattern, i) for i in (1, 2, 3)]
    made = F.concat(parts[0], F.lit("fps@"), parts[1], F.lit("x"), parts[2])
    return F.when(raw.rlike(pattern), made).otherwise(raw)


def parse_streams(raw: Column) -> Column:
    """array of parsed streams named in one text."""
    parts = F.filter(F.transform(F.split(raw, STREAM_BREAK), strip), lambda p: p != "")
    return F.filter(F.transform(parts, parse_stream), lambda s: s.isNotNull())


def compare_fps(a: Column, b: Column) -> Column:
    return compare(parse_stream(a).fps_value, parse_stream(b).fps_value)


def _pixels(stream: Column) -> Column:
    return F.when(stream.resolution_width != 0, stream.resolution_width * stream.resolution_height)


def compare_stream_sizes(a: Column, b: Column) -> Column:
    return compare(_pixels(parse_stream(a)), _pixels(parse_stream(b)))


# --- distances -------------------------------------------------------------------------------------

def parse_distance(raw: Column) -> Column:
    """struct of the bounds in the given unit and in metres; ``error`` names an unknown unit.

    An upper limit ('up to 50m') wins over a span ('10-30m'), a span over a single amount.
    """
    def made(low: Column, high: Column, unit: Column, text) -> Column:
        unit = F.coalesce(F.lower(unit), F.lit("m"))
        factor = R.lookup(unit, R.METRES_PER_RANGE_UNIT)
        low_m, high_m = plain_number(low * factor), plain_number(high * factor)
        return F.struct(
            F.when(factor.isNotNull(), low).alias("min_value"),
            F.when(factor.isNotNull(), high).alias("max_value"),
            unit.alias("unit"), low_m.alias("normalized_min"), high_m.alias("normalized_max"),
            text(low_m, high_m).alias("normalized"),
            F.when(factor.isNull(), F.concat(F.lit("Unknown unit: "), unit)).alias("error"))

    def number(pattern: str, group: int) -> Column:
        return found(raw, pattern, group).cast("double")

    none = F.lit(None).cast("double")
    metres = F.lit("m")
    limit = made(none, number(LIMIT, 1), found(raw, LIMIT, 2), lambda lo, hi: F.concat(F.lit("up to "), hi, metres))
    span = made(number(SPAN, 1), number(SPAN, 3), F.coalesce(found(raw, SPAN, 2), found(raw, SPAN, 4)),
                lambda lo, hi: F.concat(lo, F.lit("-"), hi, metres))
    single = made(none, number(AMOUNT, 1), found(raw, AMOUNT, 2), lambda lo, hi: F.concat(hi, metres))
    return F.when(_present(raw), F.when(raw.rlike(LIMIT), limit).when(raw.rlike(SPAN), span).when(raw.rlike(AMOUNT), single))


def max_metres(distance: Column) -> Column:
    return distance.normalized_max.cast("double")


def min_metres(distance: Column) -> Column:
    return distance.normalized_min.cast("double")


def is_range(distance: Column) -> Column:
    return distance.isNotNull() & distance.min_value.isNotNull()


def valid_distance(text: Column) -> Column:
    parsed = parse_distance(text)
    return F.coalesce(text.endswith("m") & parsed.isNotNull() & parsed.error.isNull(), F.lit(False))


def compare_distances(a: Column, b: Column) -> Column:
    return compare(max_metres(parse_distance(a)), max_metres(parse_distance(b)))


def feet_to_metres(x: Column) -> Column:
    return x * F.lit(0.3048)


def inches_to_metres(x: Column) -> Column:
    return x * F.lit(0.0254)


def list_page_distance(raw: Column) -> Column:
    """Metres from a list page; only metre units count."""
    return found(raw, rf"(?iU){NUMBER}\s*(?:m|meter|meters)\b").cast("double")


# --- smart events, interfaces, light type ----------------------------------------------------------

def smart_event_categories(raw: Column) -> Column:
    """Sorted distinct event classes as JSON text, the raw text when no class is known."""
    kinds = F.transform(split_items(raw, "[,;，、]"),
                        lambda x: first_match(F.lower(x), R.SMART_EVENT_CLASSES, lambda c, p: c.rlike(p)))
    classes = F.array_sort(F.array_distinct(F.filter(kinds, lambda k: k.isNotNull())))
    return F.when(F.size(classes) > 0, json_list(classes)).otherwise(raw)


def light_type(text: Column, page_text: Column | None = None) -> Column:
    """Light type from a value, then from the page around it, then weaker hints in the value."""
    low = F.lower(text)
    has = lambda c, word: F.contains(c, F.lit(word))
    out = (F.when(has(low, "white light"), "White Light").when(has(low, "laser"), "Laser")
           .when(has(low, "led") & ~has(low, "ir led"), "LED"))
    if page_text is not None:
        page = F.lower(page_text)
        out = (out.when(page.rlike(IR_RANGE) | page.rlike(IR_WAVELENGTH) | has(page, "infrared"), "IR")
               .when(page.rlike(WHITE_LIGHT), "White Light"))
    return out.when(has(low, "infrared") | (has(low, "ir") & ~has(low, "wire")), "IR").otherwise("")


IR_RANGE = r"(?U)ir\s+range"
IR_WAVELENGTH = r"(?dU)wavelength.*\b(?:850|940|880|870)\b"
WHITE_LIGHT = r"(?U)white\s+light"
WARM_LIGHT = r"(?U)warm\s+light"


def list_page_light_type(page_text: Column) -> Column:
    ranged = page_text.rlike(r"(?iU)\bIR\s+Range\b")
    hinted = page_text.rlike(r"(?iU)\bIR\b") & (F.contains(page_text, F.lit("Range"))
                                                 | F.contains(page_text, F.lit("Illuminator")))
    return F.when(ranged | hinted, "IR")


def valid_model(model: Column) -> Column:
    """F8: 5 to 50 characters and either the known prefix or a letter together with a digit."""
    text = strip(model)
    prefixed = text.rlike("(?i)^DS-?2CD")
    mixed = text.rlike(r"\p{L}") & text.rlike(r"\p{Nd}")
    return F.coalesce(F.length(text).between(5, 50) & (prefixed | mixed), F.lit(False))


def allowed_series(name: Column, keywords: list[str]) -> Column:
    """any keyword is a case-insensitive part of the name; no keywords allow all."""
    if not keywords:
        return F.lit(True)
    low = F.lower(name)
    hits = [F.contains(low, F.lit(k.lower())) for k in keywords]
    return F.coalesce(reduce(or_, hits), F.lit(False))


# --- comparison of two products ----------------------------------------------------------------------

ORDERED_RULES = ("normalized_resolution", "normalized_distance", "normalized_fps_resolution", "normalized_aperture", "numeric_compare")


def comparison_parts(rule: Column, value: Column) -> dict[str, Column]:
    """What the rules read from a value, each part NULL under the rules that don't ask for it.

    As columns of a frame they are parsed once, however often :func:`comparison_key` and :func:`comparison_order` use them.
    """
    return {"_resolution": F.when(rule == "normalized_resolution", parse_resolution(value)),
            "_distance": F.when(rule == "normalized_distance", parse_distance(value)),
            "_stream": F.when(rule == "normalized_fps_resolution", parse_stream(value)),
            "_number": F.when(rule.isin("normalized_aperture", "numeric_compare"), F.regexp_extract(value, NUMBER, 1).try_cast("double"))}


def comparison_order(rule: Column, parts: dict[str, Column]) -> Column:
    """The number by which a value is ordered under a rule; NULL for the other rules and unknown values."""
    return (F.when(rule == "normalized_resolution", megapixels(parts["_resolution"]))
            .when(rule == "normalized_distance", max_metres(parts["_distance"]))
            .when(rule == "normalized_fps_resolution", parts["_stream"].fps_value.cast("double"))
            .otherwise(parts["_number"]))


def comparison_key(rule: Column, field: Column, value: Column, parts: dict[str, Column] | None = None) -> Column:
    """Text that is equal for values that are the same under a rule; NULL where the value can't be parsed."""
    parts = parts or {"_resolution": parse_resolution(value), "_distance": parse_distance(value), "_stream": parse_stream(value),
                      "_number": F.regexp_extract(value, NUMBER, 1).try_cast("double")}
    distance, low = parts["_distance"], F.lower(value)
    reach = F.when(max_metres(distance).isNotNull(), F.concat_ws(
        "-", F.coalesce(min_metres(distance).cast("string"), F.lit("")), max_metres(distance).cast("string")))
    aliases = {"image_sensor": R.SENSOR_ALIASES, "supplement_light_type": R.LIGHT_ALIASES, "approval_protection": R.PROTECTION_ALIASES,
               "approval_anti_corrosion_protection": R.PROTECTION_ALIASES}
    canonical = F.coalesce(*[F.when(field == code, R.lookup(low, {a.lower(): name.lower() for a, name in table})) for code, table in aliases.items()], low)
    return (F.when(rule == "set_compare", F.to_json(F.array_sort(F.array_distinct(F.transform(list_items(value), F.lower)))))
            .when(rule == "exact_or_alias", canonical)
            .when(rule == "normalized_resolution", parts["_resolution"])
            .when(rule == "normalized_distance", reach)
            .when(rule == "normalized_fps_resolution", parts["_stream"].normalized)
            .otherwise(parts["_number"].cast("string")))
