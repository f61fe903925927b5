"""Golden cases of the quality rules and issue handling."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from specloom.operators import diff, quality, report, select
from tests.conftest import frame

SPEC = ("run_id string, brand string, series_l1 string, series_l2 string, product_model string, field_code string, "
        "raw_value string, normalized_value string, unit string, extract_confidence double")
NODE = "run_id string, brand string, series_l1 string, series_l2 string, discovered_at timestamp"


def spec(**kw):
    return {"run_id": "r1", "brand": "A", "series_l1": "S", "series_l2": "T", "product_model": "m1", "field_code": "image_sensor",
            "raw_value": "x", "normalized_value": "x", "extract_confidence": 1.0, **kw}


def kinds(df):
    return sorted((r.issue_type, r.severity) for r in df.collect())


MISSING, FAILED, UNIT = ("missing_field", "P2"), ("parse_failed", "P1"), ("unit_abnormal", "P3")


@pytest.mark.parametrize("row,expected", [
    (spec(raw_value="", normalized_value=None), [MISSING]),
    (spec(field_code="max_resolution", raw_value="2688x1520", normalized_value="2688x1520", extract_confidence=0.3), [FAILED]),
    (spec(field_code="supplement_light_range", raw_value="50", normalized_value="50", unit="ft"), [UNIT]),
    (spec(), []),
    (spec(normalized_value=None), [MISSING, FAILED]),
    (spec(raw_value="n/a", normalized_value="n/a"), [FAILED]),
    (spec(field_code="main_stream_max_fps_resolution", unit="fps"), []),
    (spec(field_code="main_stream_max_fps_resolution", unit="FPS"), [UNIT]),
    (spec(field_code="main_stream_max_fps_resolution", unit="FPS+PX"), []),
    (spec(field_code="aperture", unit=None), [UNIT]),
    (spec(extract_confidence=0.5), []),
    (spec(extract_confidence=None), []),
    (spec(field_code="other", raw_value="", normalized_value=None), []),
    (spec(raw_value="  ", normalized_value="v"), [MISSING]),
])
def test_record_rules(spark, row, expected):
    assert kinds(quality.detect_spec_issues(frame(spark, [row], SPEC))) == expected


def test_details(spark):
    rows = [spec(field_code="supplement_light_range", unit="ft"), spec(field_code="aperture", unit=None), spec(extract_confidence=0.3)]
    details = {r.issue_detail for r in quality.detect_spec_issues(frame(spark, rows, SPEC)).collect()}
    assert details == {"Unit 'ft' is abnormal or doesn't match expected for field 'supplement_light_range'",
                       "Unit 'None' is abnormal or doesn't match expected for field 'aperture'",
                       "Field 'image_sensor' parsing failed (confidence: 0.30)"}


def test_registry():
    assert len(quality.get_rules()) == 3
    assert [len(quality.get_rules(severity=s)) for s in ("P1", "P2", "P3")] == [1, 1, 1]
    assert len(quality.get_rules(field="lens_type")) == 2
    assert len(quality.get_rules(field="max_resolution")) == 3


def test_filters_and_severities(spark):
    df = frame(spark, [spec(raw_value=""), spec(brand="B", raw_value="", series_l1="Q")], SPEC)
    assert quality.detect_spec_issues(df, brand="B").count() == 1
    assert quality.detect_spec_issues(df, series_l1="S").count() == 1
    assert kinds(quality.detect_spec_issues(df, severities=["P1"])) == []


def test_duplicates_null_levels_and_blanks(spark):
    rows = [spec(normalized_value="a", series_l2=None), spec(normalized_value="b", series_l2=None),  # conflict
            spec(normalized_value=None, product_model="m2"), spec(normalized_value="", product_model="m2"),  # equal
            spec(normalized_value="a", run_id="r2"), spec(normalized_value="b", run_id="r3"),  # other runs
            spec(normalized_value="a", field_code=""), spec(normalized_value="b", field_code="")]  # no field
    out = quality.duplicate_models(frame(spark, rows, SPEC)).collect()
    assert [(r.product_model, r.series_l2) for r in out] == [("m1", None)] * 2


def test_hot_duplicate_key(spark):
    """A third of all rows on one key: every row is still reported."""
    base = spark.range(3000).select(
        F.lit("r1").alias("run_id"), F.lit("A").alias("brand"), F.lit("S").alias("series_l1"), F.lit(None).cast("string").alias("series_l2"),
        F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("product_model"),
        F.lit("aperture").alias("field_code"), F.lit("x").alias("raw_value"), F.col("id").cast("string").alias("normalized_value"))
    assert quality.duplicate_models(base).count() == 1000


def hierarchy(spark, *nodes):
    return frame(spark, [dict(zip(("run_id", "brand", "series_l1", "series_l2"), n), discovered_at=datetime(2026, 1, 1)) for n in nodes], NODE)


def test_hierarchy_added_and_removed(spark):
    prev = hierarchy(spark, ("1", "A", "Value", "2-Line"), ("1", "A", "Legacy", "Old"))
    cur = hierarchy(spark, ("2", "A", "Value", "2-Line"), ("2", "A", "Pro", "1-Series"), ("2", "A", "Pro", None))
    two = {(r.change, r.series_l1, r.series_l2) for r in diff.compare_hierarchies(cur, prev).collect()}
    assert two == {("added", "Pro", ""), ("added", "Pro", "1-Series"), ("removed", "Legacy", ""), ("removed", "Legacy", "Old")}
    all_runs = {(r.run_id, r.change, r.series_l1, r.series_l2) for r in diff.hierarchy_changes(prev.unionByName(cur)).collect()}
    assert all_runs == {("2", *x) for x in two}
    issues = quality.hierarchy_changed(diff.hierarchy_changes(prev.unionByName(cur)))
    assert {r.issue_detail for r in issues.collect()} >= {"New hierarchy node added: A|Pro|", "Hierarchy node disappeared: A|Legacy|Old"}


def test_hierarchy_gap_and_first_run(spark):
    h = hierarchy(spark, ("1", "A", "X", None), ("2", "A", "Y", None), ("3", "A", "X", None))
    got = sorted((r.run_id, r.change, r.series_l1) for r in diff.hierarchy_changes(h).collect())
    assert got == [("2", "added", "Y"), ("2", "removed", "X"), ("3", "added", "X"), ("3", "removed", "Y")]


def test_empty_subseries(spark):
    h = hierarchy(spark, ("1", "A", "X", "a"), ("1", "A", "X", "b"), ("1", "A", "X", None))
    assert [r.series_l2 for r in diff.empty_subseries(h, h.where("series_l2 = 'a'")).collect()] == ["b"]


def test_summary_totals(spark, sf_dir):
    from specloom.plans import views
    issues = views.table(spark, sf_dir, "issues")
    rows = report.issue_summary(issues).collect()
    total = issues.count()
    for d in ("severity", "issue_type", "status", "total"):
        assert sum(r.n for r in rows if r.dimension == d) == total


def test_open_issue_order(spark):
    df = spark.createDataFrame([("r", s, "open") for s in ("P1", "P2", "P3")] + [("r", "P1", "closed")], "run_id string, severity string, status string")
    count = lambda s: select.open_issues(df, min_severity=s).count()
    assert (count("P1"), count("P2"), count("P3"), count("unknown")) == (1, 2, 3, 3)


def test_issue_update(spark):
    cols = "run_id string, brand string, series_l1 string, series_l2 string, product_model string, issue_type string, field_code string, issue_detail string, status string, owner string"
    df = spark.createDataFrame([("r", "A", None, None, None, "t", None, "d1", "open", None), ("r", "A", None, None, None, "t", None, "d2", "open", "o")], cols)
    key = df.where("issue_detail = 'd1'").select(quality.issue_key().alias("issue_key"), F.lit("done").alias("status"), F.lit(None).cast("string").alias("owner"),
                                                  F.lit("2026-01-01").cast("timestamp").alias("updated_at"))
    got = {r.issue_detail: (r.status, r.owner) for r in quality.update_issues(df, key).collect()}
    assert got == {"d1": ("done", None), "d2": ("open", "o")}


def test_duplicates_are_written_in_blocks(spark, monkeypatch):
    rows = [("r", "b", "s", None, "M", "aperture", v) for v in "aabbabab"] + [("r", "b", "s", None, "N", "aperture", "a")] * 9
    specs = spark.createDataFrame(rows, "run_id string, brand string, series_l1 string, series_l2 string, product_model string, "
                                        "field_code string, normalized_value string")
    for step in (1, 3, 4, 8, 100):
        monkeypatch.setattr(quality, "COPIES", step)
        got = quality.duplicate_models(specs).collect()
        assert len(got) == 8 and {r["product_model"] for r in got} == {"M"}


def test_run_without_any_path_is_a_run(spark):
    rows = [("1", "b", "s", "x"), ("2", "b", "", None), ("3", "b", "s", "x"), ("1", None, "s", "x"), (None, "b", "s", "y")]
    h = spark.createDataFrame(rows, "run_id string, brand string, series_l1 string, series_l2 string")
    got = sorted(tuple(r) for r in diff.hierarchy_changes(h).collect())
    assert got == [("2", "b", "s", "", "removed"), ("2", "b", "s", "x", "removed"), ("3", "b", "s", "", "added"), ("3", "b", "s", "x", "added")]
    assert diff.hierarchy_changes(h.limit(0)).count() == 0


def _plan(df):
    """Final plan without the initial one, after the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_changes_shuffle_the_paths_once(spark, tmp_path):
    rows = [(str(run), "b%d" % (i % 3), "s%d" % i, "x%d" % (i + run)) for run in range(4) for i in range(30)]
    spark.createDataFrame(rows, "run_id string, brand string, series_l1 string, series_l2 string").write.parquet(str(tmp_path / "h"))
    plan = _plan(diff.hierarchy_changes(spark.read.parquet(str(tmp_path / "h"))))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan and "Window" not in plan


def test_report_and_rules_scan_each_table_as_often_as_needed(spark, tmp_path):
    spec = ("run_id string, brand string, series_l1 string, series_l2 string, product_model string, field_code string, raw_value string, "
            "normalized_value string, unit string, extract_confidence double")
    for name, schema in (("specs", spec), ("catalog", spec), ("hierarchy", spec), ("runs", "run_id string, status string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    t = {n: spark.read.parquet(str(tmp_path / n)) for n in ("specs", "catalog", "hierarchy", "runs")}
    scans = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("FileScan")
    assert scans(report.run_report(t["runs"], t["catalog"], t["specs"], quality.detect_spec_issues(t["specs"]))) == 4
    assert scans(quality.all_issues(t["specs"], t["hierarchy"], t["catalog"])) == 6  # two of them are one reused exchange
    assert scans(quality.duplicate_models(t["specs"])) == 1
