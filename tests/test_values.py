"""Golden cases for value normalization."""

import json

import pytest
from pyspark.sql import functions as F

from specloom.functions import values as V
from specloom.functions.text import decode_entities, strip


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """One-row checks: skip code generation, the query tests cover it."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


def one(spark, expr, *args):
    """Evaluate a column function on string arguments that Spark cannot fold away."""
    names = [f"a{i}" for i in range(len(args))]
    schema = ", ".join(f"{n} string" for n in names)
    row = spark.createDataFrame([tuple(args)], schema).select(expr(*[F.col(n) for n in names]).alias("r")).first()
    return row.r


@pytest.mark.parametrize("field,raw,value,unit,issues", [
    ("max_resolution", "4K (3840x2160)", "3840x2160", "px", []),
    ("max_resolution", "2592×1944", "2592x1944", "px", []),
    ("max_resolution", "1080i", "1920x1080", "px", ["Derived from vertical resolution only"]),
    ("max_resolution", "5MP", None, None, ["Could not parse resolution format"]),
    ("supplement_light_range", "100 ft", "30.48", "m", []),
    ("supplement_light_range", "50m", "50", "m", []),
    ("supplement_light_range", "50", "50.0", "m", ["No unit specified, assumed meters"]),
    ("supplement_light_range", "10-30m", "10.0", "m", ["No unit specified, assumed meters"]),
    ("supplement_light_range", "5 yd", "5 yd", "yd", ["Unknown unit: yd"]),
    ("supplement_light_range", "far", None, None, ["Could not parse distance format"]),
    ("aperture", "F1.8", "f/1.8", "f", []),
    ("aperture", "none", None, None, ["Could not parse aperture format"]),
    ("main_stream_max_fps_resolution", "30 FPS (1920 X 1080)", "30fps (1920x1080)", "fps+px", []),
    ("main_stream_max_fps_resolution", "15fps", "15fps", "fps+px", ["Resolution not found"]),
    ("main_stream_max_fps_resolution", "1920x1080", "(1920x1080)", "fps+px", ["FPS not found"]),
    ("stream_count", "3 streams", "3", "count", []),
    ("interface_items", "RJ45, Audio, Alarm", '["RJ45", "Audio", "Alarm"]', None, []),
    ("interface_items", "a, A, b", '["a", "b"]', None, []),
    ("interface_items", '["x","X"]', '["x", "X"]', None, []),
    ("interface_items", '[1, "a", null]', '["1", "a", "None"]', None, ["Converted non-string items to strings"]),
    ("interface_items", "[a, b", '["[a", "b"]', None, []),
    ("interface_items", ",;", None, None, ["No list items found"]),
    ("image_sensor", '1/2.8" Progressive Scan CMOS', '1/2.8" CMOS', None, []),
    ("image_sensor", '1/2.7" Progressive Scan CMOS', "CMOS", None, ["Partial alias match"]),
    ("image_sensor", '1/2.8"', '1/2.8" CMOS', None, ["Partial alias match"]),
    ("supplement_light_type", "IR + Warm Light", "IR", None, ["Partial alias match"]),
    ("supplement_light_type", "xenon", "xenon", None, ["No alias match found"]),
    ("approval_protection", "ip67", "IP67", "grade", []),
    ("lens_type", " Fixed   focal; ", "Fixed focal", None, []),
    ("lens_type", " ", None, None, ["Empty value"]),
    ("lens_type", None, None, None, ["Empty value"]),
])
def test_field_value(spark, field, raw, value, unit, issues):
    got = one(spark, V.field_value, field, raw)
    assert (got.normalized_value, got.unit, got.issues) == (value, unit, issues)


def test_strict_units(spark):
    assert one(spark, lambda f, r: V.field_value(f, r, strict_units=True), "approval_protection", "IP67").unit is None


@pytest.mark.parametrize("raw,size,mp,ratio", [
    ("1920x1080", "1920x1080", 2.1, "16:9"), ("4608 × 2592", "4608x2592", 11.9, "16:9"),
    ("2592P", "4608x2592", 11.9, "16:9"), ("5MP", "2592x1944", 5.0, "4:3"), ("4 mp", "2560x1440", 3.7, "16:9"),
    ("7MP", None, None, None), ("99999x99999", "99999x99999", None, None),
])
def test_resolution(spark, raw, size, mp, ratio):
    assert one(spark, V.parse_resolution, raw) == size
    assert one(spark, lambda r: V.megapixels(V.parse_resolution(r)), raw) == mp
    assert one(spark, lambda r: V.aspect_ratio(V.parse_resolution(r)), raw) == ratio


def test_comparisons(spark):
    assert one(spark, V.compare_resolutions, "1920x1080", "3840x2160") == -1
    assert one(spark, V.compare_resolutions, "1920x1080", "bad") == 0
    assert one(spark, V.compare_fps, "60fps", "30 fps (1920x1080)") == 1
    assert one(spark, V.compare_stream_sizes, "60fps", "30 fps (1920x1080)") == 0
    assert one(spark, V.compare_distances, "100 ft", "10-30m") == 1


@pytest.mark.parametrize("raw,text,as_json", [
    ("30fps (1920x1080)", "30fps (1920x1080)", {"fps_value": 30, "resolution_width": 1920, "resolution_height": 1080}),
    ("60fps@2560x1440", "60fps (2560x1440)", {"fps_value": 60, "resolution_width": 2560, "resolution_height": 1440}),
    ("25 fps 2048x1536", "25fps (2048x1536)", {"fps_value": 25, "resolution_width": 2048, "resolution_height": 1536}),
    ("15fps", "15fps", {"fps_value": 15}),
    ("at 1280x720", "(1280x720)", {"resolution_width": 1280, "resolution_height": 720}),
    ("0fps", None, None), ("n/a", None, None),
])
def test_stream(spark, raw, text, as_json):
    got = one(spark, V.parse_stream, raw)
    assert (got.normalized if got else None) == text
    out = one(spark, lambda r: V.stream_json(V.parse_stream(r)), raw)
    assert (json.loads(out) if out else None) == as_json
    assert out is None or out == json.dumps(as_json)


def test_many_streams(spark):
    got = one(spark, V.parse_streams, "Main Stream 1 30fps (1920x1080), x; Stream 2: 15fps")
    assert [s.normalized for s in got] == ["30fps (1920x1080)", "15fps"]
    assert one(spark, V.stream_at, "50Hz: 20 fps (3840 × 2160), 25 fps (3072 × 1728)") == "20fps@3840x2160"


@pytest.mark.parametrize("raw,text,low,high,ranged", [
    ("50m", "50m", None, 50.0, False), ("100 ft", "30.48m", None, 30.48, False),
    ("10-30m", "10-30m", 10.0, 30.0, True), ("up to 50m", "up to 50m", None, 50.0, False),
    ("30 inches", "0.76m", None, 0.76, False), ("5 ft ~ 10", "1.52-3.05m", 1.52, 3.05, True),
])
def test_distance(spark, raw, text, low, high, ranged):
    assert one(spark, lambda r: V.parse_distance(r).normalized, raw) == text
    assert one(spark, lambda r: V.min_metres(V.parse_distance(r)), raw) == low
    assert one(spark, lambda r: V.max_metres(V.parse_distance(r)), raw) == high
    assert one(spark, lambda r: V.is_range(V.parse_distance(r)), raw) is ranged


def test_distance_errors(spark):
    got = one(spark, V.parse_distance, "30 yd")
    assert got.normalized is None and got.error == "Unknown unit: yd"
    assert one(spark, V.parse_distance, "far") is None
    assert one(spark, V.valid_distance, "10-30m") is True
    assert one(spark, V.valid_distance, "10-30") is False
    assert one(spark, V.valid_distance, "") is False


def test_smart_events_and_light(spark):
    assert one(spark, V.smart_event_categories, "Line crossing detection, intrusion detection, face detection") == (
        '["Face Detection", "Intrusion Detection", "Line Crossing Detection"]')
    assert one(spark, V.smart_event_categories, "other") == "other"
    assert one(spark, V.light_type, "Wired box") == ""
    assert one(spark, V.light_type, "IR LED") == "IR"
    assert one(spark, V.light_type, "LED", "IR  range 30 m") == "LED"
    assert one(spark, V.light_type, "smart", "IR  range 30 m") == "IR"
    assert one(spark, V.list_page_light_type, "IR Range 30 m") == "IR"
    assert one(spark, V.list_page_distance, "Up to 30 m") == 30.0
    assert one(spark, V.list_page_distance, "30 mm") is None


def test_text_helpers(spark):
    assert one(spark, decode_entities, "a &amp; b&nbsp;&#215; &#x41; &bogus; &#0; R&D &lt;") == "a & b × A &bogus; &#0; R&D <"
    assert one(spark, strip, " 　 x  ") == "x"


@pytest.mark.parametrize("model,ok", [("DS-2CD", True), ("ds2cdx", True), ("AB12", False), ("ABCDE", False),
                                      ("ÄBC-1", True), ("1" * 51, False), (None, False)])
def test_models(spark, model, ok):
    assert one(spark, V.valid_model, model) is ok


def test_series_allowlist(spark):
    assert one(spark, lambda c: V.allowed_series(c, ["pro", "value"]), "VALUE line") is True
    assert one(spark, lambda c: V.allowed_series(c, ["pro", "value"]), "Ultra") is False
    assert one(spark, lambda c: V.allowed_series(c, []), "Ultra") is True
