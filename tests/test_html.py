"""HTML extraction: page layouts, malformed markup and precedence."""

import pytest
from pyspark.sql import functions as F

from specloom.operators import extract

SAMPLE = """<html><body><table class="spec-table">
<tr><th>Image Sensor</th><td>1/2.8&quot; Progressive Scan CMOS</td></tr>
<tr><th>Max. Resolution</th><td>4608 × 2592</td></tr>
<tr><th>Main Stream</th><td>30fps (4608x2592)</td></tr>
<tr><th>Supplement Light Range</th><td>50 m</td></tr>
<tr><th>Interface</th><td><ul><li>1 RJ45</li><li>Audio</li></ul></td></tr></table></body></html>"""


def fields(spark, html):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    return {r.field_code: (r.raw_value, r.confidence) for r in extract.extract_raw(pages, ["page_id"]).collect()}


def test_sample_table(spark):
    got = fields(spark, SAMPLE)
    assert got["image_sensor"] == ('1/2.8" Progressive Scan CMOS', 1.0)
    assert got["max_resolution"] == ("4608 × 2592", 1.0)
    assert got["main_stream_max_fps_resolution"] == ("30fps (4608x2592)", 1.0)
    assert got["supplement_light_range"] == ("50 m", 1.0)
    assert got["stream_count"] == ("1", 1.0)
    assert got["interface_items"] == ('["1 RJ45", "Audio"]', 1.0)
    assert got["lens_type"] == ("30fps (4608x2592)", 0.7)  # third row, by position
    assert "supplement_light_type" not in got


def test_no_container(spark):
    assert fields(spark, "<html><p>1920x1080 IR range</p></html>") == {}


def test_earlier_term_beats_better_layout(spark):
    html = """<table><tr><td>Video Frame Rate</td><td>25fps</td></tr></table>
              <ul><li>Main Stream: 30fps</li></ul>"""
    assert fields(spark, html)["main_stream_max_fps_resolution"] == ("30fps", 0.9)


def test_empty_first_cell_ends_the_table(spark):
    html = """<table><tr><td>Aperture</td><td>-</td></tr><tr><td>Aperture</td><td>F2</td></tr></table>"""
    # the first cell is empty, so the table gives nothing and the page text is searched
    assert fields(spark, html)["aperture"] == ("F2", 0.6)


def test_unclosed_cells_and_case(spark):
    html = "<TABLE><TR><TD>Lens Type<TD>Fixed<TR><TD>Protection<TD>IP67 &amp; IK10</TABLE>"
    got = fields(spark, html)
    assert got["lens_type"] == ("Fixed", 1.0)
    assert got["approval_protection"] == ("IP67 & IK10", 1.0)
    assert got["approval_anti_corrosion_protection"] == ("IP67 & IK10", 1.0)


def test_entities_do_not_make_tags(spark):
    html = "<table><tr><td>Lens Type</td><td>&lt;b&gt; wide &lt;/b&gt;&nbsp;</td></tr></table>"
    assert fields(spark, html)["lens_type"] == ("<b> wide </b>", 1.0)


def test_comments_and_scripts_are_ignored(spark):
    html = """<script>var x = "<tr><td>Lens Type</td><td>no</td></tr>";</script><!-- <tr><td>Lens Type</td><td>no</td></tr> -->
              <table><tr><td>Lens Type</td><td>yes</td></tr></table>"""
    assert fields(spark, html)["lens_type"] == ("yes", 1.0)


def test_nested_vendor_value(spark):
    html = """<section><div class="x main-item"><div class="item-title">Aperture</div>
      <div class="item-title-detail"><div>F1.6</div><div>wide</div></div></div>
      <div class="main-item"><div class="item-title">Smart Event</div><div class="item-title-detail">Line crossing, Face</div></div></section>"""
    got = fields(spark, html)
    assert got["aperture"] == ("F1.6wide", 1.0)
    assert got["deep_learning_function_categories"] == ('["Line crossing", "Face"]', 1.0)


def test_vendor_list(spark):
    html = """<dl></dl><ul><li class="tech-specs-items-description-list"><span class="tech-specs-items-description__title">Lens Type</span>
      <span class="tech-specs-items-description__description"><span>Zoom</span> 4x</span></li></ul>"""
    assert fields(spark, html)["lens_type"] == ("Zoom4x", 1.0)


def cut(spark, structure, *pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    found = extract.pairs(rows, ["page_id"], structure).orderBy("page_id", "row_pos", "cell_pos").collect()
    return [[(r.label, r.value) for r in found if r.page_id == i] for i in range(len(pages))]


def test_nested_tables_keep_their_owner(spark):
    inner = "<TABLE class=x><tr><td>Width<td>12</tr><tr><td>Height</td><td>7</td></tr></TABLE>"
    page = f"<table><tr><th>Size</th><td>{inner}</td><td>mm</td></tr><tr><td>Lens Type</td><td>Zoom</td></tr></table><table><tr><td>a<td>b</table>"
    got, stray = cut(spark, "table", page, f"</table>{page}")
    whole = "Width12Height7"
    assert got == [("size", whole), (whole.lower(), "Width"), ("width", "12"), ("12", "Height"), ("height", "7"), ("7", "mm"),
                   ("width", "12"), ("height", "7"), ("lens type", "Zoom"), ("a", "b")]
    assert stray == got  # a closing tag without an opening one changes nothing
    assert fields(spark, page)["lens_type"] == ("Zoom", 1.0)


def test_table_in_a_table_in_a_table(spark):
    level = "<table><tr><td>{0}</td><td>{1}</td></tr></table>"
    page = level.format("a", level.format("b", level.format("c", "d")))
    assert cut(spark, "table", page) == [[("a", "bcd"), ("bcd", "b"), ("b", "cd"), ("cd", "c"), ("c", "d"), ("b", "cd"), ("cd", "c"), ("c", "d"), ("c", "d")]]


def test_nested_lists_keep_their_owner(spark):
    page = "<ul><li>Audio<ol><li>In: 1<li>Out: 2</ol></li><li>Lens Type: Zoom</ul>"
    assert cut(spark, "list", page, "<ul><li>a: 1<li>b: 2</ul>") == [
        [("audioin: 1out: 2", "1Out: 2"), ("in: 1", "1"), ("out: 2", "2"), ("lens type: zoom", "Zoom")], [("a: 1", "1"), ("b: 2", "2")]]


def test_nested_definition_lists(spark):
    inner = "<dl><dt>Inner</dt><dd>i</dd><dt>Last</dt></dl>"
    page = f"<dl><dt>Shared</dt><dt>Outer</dt><dd>x {inner} y</dd><dt>Lens Type<dd>Zoom<dt>Open</dl><dl><dt>Other</dt><dd></dd></dl>"
    assert cut(spark, "definition", page) == [[("shared", "xInneriLasty"), ("outer", "xInneriLasty"), ("inner", "i"), ("lens type", "Zoom"), ("other", "")]]


def test_definitions_stop_at_the_end_of_their_list(spark):
    assert cut(spark, "definition", "<dl><dt>a<dt>b</dl><dl><dt>c<dd>1</dl>") == [[("c", "1")]]


def test_long_pages_take_time_by_their_length(spark):
    import time
    page = lambda n: "<table><tr><td>x</td><td>" + "<table><tr><td>Lens Type</td><td>Zoom</td></tr></table>" * n + "</td></tr></table>" + (
        "<dl>" + "<dt>t</dt>" * n + "<dd>v</dd></dl>")
    seconds = []
    for n in (1000, 1000, 6000):
        began = time.time()
        # the outer row pairs its own cells and all inner ones, but for the label that is too long
        assert [len(x) for x in cut(spark, "table", page(n))] == [3 * n]
        assert cut(spark, "definition", page(n)) == [[("t", "v")] * n]
        seconds.append(time.time() - began)
    assert seconds[2] < 15 * max(seconds[1], 0.5)


def test_unknown_distance_unit_halves_confidence(spark):
    html = "<table><tr><td>IR Range</td><td>30 yd</td></tr></table>"
    assert fields(spark, html)["supplement_light_range"] == ("30 yd", 0.5)


def test_definition_shared_by_two_terms(spark):
    html = "<dl><dt>Lens Type</dt><dt>Aperture</dt><dd>F2</dd></dl>"
    got = fields(spark, html)
    assert got["lens_type"] == ("F2", 1.0) and got["aperture"] == ("F2", 1.0)


@pytest.mark.parametrize("text,light", [("IR  range 5", "IR"), ("wavelength 850 nm", "IR"), ("wavelength\n850", None), ("warm light", "Warm Light"),
                                        ("warm light bird", "IR + Warm Light"), ("laser", "Laser"), ("infrared white light", "IR")])
def test_light_type(spark, text, light):
    got = fields(spark, f"<dl></dl><p>{text}</p>")
    assert got.get("supplement_light_type", (None,))[0] == light


def test_pipeline_normalizes(spark):
    catalog = spark.createDataFrame([("r", "A", "S", None, "m", "u")], "run_id string, brand string, series_l1 string, series_l2 string, product_model string, product_url string")
    pages = spark.createDataFrame([("u", SAMPLE)], "url string, html string")
    rows = {r.field_code: r for r in extract.extract_specs(catalog, pages).collect()}
    assert (rows["max_resolution"].normalized_value, rows["max_resolution"].unit) == ("4608x2592", "px")
    assert (rows["supplement_light_range"].normalized_value, rows["supplement_light_range"].unit) == ("50", "m")
    assert rows["image_sensor"].normalized_value == '1/2.8" CMOS'
    assert rows["image_sensor"].series_l2 == ""


def test_newest_copy_of_a_page(spark):
    catalog = spark.createDataFrame([("r", "A", "S", "T", "m", "u")], "run_id string, brand string, series_l1 string, series_l2 string, product_model string, product_url string")
    page = lambda label, value: f"<table><tr><td>{label}</td><td>{value}</td></tr></table>"
    pages = spark.createDataFrame([("u", 1, page("Lens Type", "old")), ("u", 2, page("Aperture", "F2")), ("v", 9, page("Aperture", "F9"))], "url string, v int, html string")
    rows = extract.extract_specs(catalog, pages, version="v").collect()
    # the first row also stands for the resolution, by position
    assert sorted((r.field_code, r.raw_value) for r in rows) == [("aperture", "F2"), ("max_resolution", "F2")]


def test_padded_and_long_references(spark):
    from specloom.functions.text import decode_entities
    cases = {"&#00000169;": "©", "&#x00000A9;": "©", "&#X1F600;": "😀", "&CounterClockwiseContourIntegral;": "∳", "&NotEqualTilde;": "≂̸",
             "&#0;": "&#0;", "&#xD800;": "&#xD800;", "&#1114112;": "&#1114112;", "&#99999999999999999999;": "&#99999999999999999999;", "&nosuch;": "&nosuch;",
             "a &lt;b&gt; &amp;amp; &": "a <b> &amp; &", "": ""}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", decode_entities(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in rows} == cases
