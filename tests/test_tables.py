"""Merging, snapshots, sheets, streams and the complete run."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from specloom import registry as R
from specloom.operators import diff, merge, report
from specloom.plans import run, views
from specloom.sources import feed, manual, pages, snapshots
from specloom.streaming import issues as streams
from tests.conftest import frame

SPEC = ("run_id string, brand string, series_l1 string, series_l2 string, product_model string, field_code string, field_name string, raw_value string, "
        "normalized_value string, unit string, value_type string, source_url string, extract_confidence double, is_manual_override boolean, updated_at timestamp")
MANUAL = ("input_id string, brand string, series_l1 string, series_l2 string, product_model string, field_code string, manual_value string, operator string, "
          "reason string, created_at timestamp")
DAY = datetime(2026, 4, 18)


def spec(**kw):
    return {"run_id": "20260418_biweekly_01", "brand": "A", "series_l1": "S", "series_l2": "T", "product_model": "m1", "field_code": "max_resolution",
            "raw_value": "3840x2160", "normalized_value": "3840x2160", "unit": "px", "extract_confidence": 0.8, "is_manual_override": False, "updated_at": DAY, **kw}


def fix(**kw):
    return {"input_id": "1", "brand": "A", "series_l1": "S", "series_l2": "T", "product_model": "m1", "field_code": "max_resolution", "manual_value": "4000x3000",
            "operator": "o", "reason": "r", "created_at": DAY, **kw}


RUN = "20260418_biweekly_01"
NOW = lambda: F.lit("2026-05-01 00:00:00").cast("timestamp")


def test_override_and_insert(spark):
    specs = frame(spark, [spec(), spec(product_model="m2")], SPEC)
    fixes = frame(spark, [fix(), fix(input_id="2", manual_value="old", created_at=datetime(2026, 1, 1)), fix(input_id="3", product_model="new"),
                          fix(input_id="4", product_model=None), fix(input_id="5", product_model=None), fix(input_id="6", brand=None)], MANUAL)
    out = merge.merge_manual(specs, fixes, RUN, NOW())
    got = sorted((r.product_model, r.normalized_value, r.is_manual_override, r.extract_confidence) for r in out.collect())
    assert got == [("MANUAL_INPUT", "4000x3000", True, 1.0), ("MANUAL_INPUT", "4000x3000", True, 1.0), ("m1", "4000x3000", True, 1.0),
                   ("m2", "3840x2160", False, 0.8), ("new", "4000x3000", True, 1.0)]
    counts = merge.merge_counts(specs, fixes, RUN).first()
    assert (counts.manual_inputs_count, counts.overrides_applied, counts.new_products_added, counts.import_errors) == (6, 2, 3, 1)
    again = merge.merge_manual(out.where("product_model <> 'MANUAL_INPUT'"), fixes.where("product_model IS NOT NULL"), RUN, NOW())
    assert again.count() == 3  # merging twice changes nothing


def test_full_key_override_and_revert(spark):
    specs = frame(spark, [spec(series_l2=None), spec(product_model="m2")], SPEC)
    fixes = frame(spark, [fix(series_l2=None), fix(input_id="2", series_l2="other", product_model="m2")], MANUAL)
    status = {r.input_id: r.status for r in merge.override_status(specs, fixes, RUN).collect()}
    assert status == {"1": "applied", "2": "skipped"}
    done = merge.apply_overrides(specs, fixes, RUN, NOW())
    assert {r.product_model: (r.raw_value, r.extract_confidence) for r in done.collect()} == {"m1": ("4000x3000", 0.8), "m2": ("3840x2160", 0.8)}
    trail = merge.audit_trail(done, specs, fixes, RUN).collect()
    assert [(r.previous_value, r.manual_value) for r in trail] == [("3840x2160", "4000x3000")]
    back = merge.revert_override(done, specs, RUN, "A", "m1", "max_resolution")
    assert sorted((r.product_model, r.raw_value, r.is_manual_override) for r in back.collect()) == [("m1", "3840x2160", False), ("m2", "3840x2160", False)]
    assert [r.input_id for r in merge.without_manual(fixes, "A", "m1", "max_resolution").collect()] == ["2"]


def test_upsert_keeps_flag_and_place(spark):
    old = frame(spark, [spec(is_manual_override=True)], SPEC)
    new = frame(spark, [spec(raw_value="a", series_l1="Z"), spec(raw_value="b", updated_at=datetime(2026, 5, 1)), spec(product_model="m9")], SPEC)
    got = sorted((r.product_model, r.raw_value, r.series_l1, r.is_manual_override) for r in merge.upsert_specs(old, new, "updated_at").collect())
    assert got == [("m1", "b", "S", True), ("m9", "3840x2160", "S", False)]


def test_spec_changes(spark):
    rows = [spec(run_id="1", normalized_value="a"), spec(run_id="2", normalized_value="b"), spec(run_id="3", product_model="m2"), spec(run_id="4", normalized_value="b")]
    got = sorted((r.run_id, r.change_type, r.product_model, r.old_value, r.new_value) for r in diff.spec_changes(frame(spark, rows, SPEC)).collect())
    assert got == [("2", "changed", "m1", "a", "b"), ("3", "new", "m2", None, "3840x2160"), ("3", "removed", "m1", "b", None),
                   ("4", "new", "m1", None, "b"), ("4", "removed", "m2", "3840x2160", None)]


def test_snapshot_round_trip(spark, tmp_path):
    base = str(tmp_path)
    rows = frame(spark, [spec(), spec(product_model="m2"), spec(run_id="20260501_monthly_01"), spec(run_id="odd run/1")], SPEC)
    snapshots.write_runs(rows, base, "specs")
    snapshots.write_runs(rows.where(F.col("run_id") == RUN).limit(1), base, "specs")  # replaces one run only
    assert snapshots.read_runs(spark, base, "specs", [RUN]).count() == 1
    assert snapshots.read_runs(spark, base, "specs", [RUN, "20260501_monthly_01"]).count() == 2
    assert snapshots.read_runs(spark, base, "specs", ["odd run/1"]).count() == 1
    assert snapshots.read_runs(spark, base, "specs", ["nope"]).count() == 0
    assert snapshots.read_runs(spark, base, "catalog", [RUN]).count() == 0  # no such table yet
    assert [r.run_id for r in snapshots.list_runs(spark, base, "specs").collect()] == ["odd run/1", "20260501_monthly_01", RUN]
    plan = snapshots.read_runs(spark, base, "specs", [RUN])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert snapshots.delete_run(spark, base, RUN, ["specs", "catalog"]) == {"specs": 1, "catalog": 0}
    assert snapshots.delete_run(spark, base, "odd run/1", ["specs"]) == {"specs": 1}
    assert [r.run_id for r in snapshots.list_runs(spark, base, "specs").collect()] == ["20260501_monthly_01"]


def test_run_date(spark):
    ids = ["20260418_x_01", "20261332_x", "plain", "2026_1"]
    got = [r.d for r in spark.createDataFrame([(i,) for i in ids], "run_id string").select(snapshots.run_date(F.col("run_id")).alias("d")).collect()]
    assert [str(d) for d in got] == ["2026-04-18", "None", "None", "None"]


def test_manual_sheet(spark, tmp_path):
    lines = [",".join(R.MANUAL_SHEET), "A,S,T,m,aperture,f/1,me,because", ",,,,,,,", "A,,T,m,aperture,f/2,me,", 'A,S,T,m,aperture,"f/3, wide",me,again']
    (tmp_path / "sheet.csv").write_text("\n".join(lines))
    rows = manual.read_manual_sheet(spark, str(tmp_path))
    assert [(r.row_no, r.error) for r in manual.rejected(rows).collect()] == [(4, "Row 4: Missing required fields: ['series_l1', 'reason']")]
    good = manual.accepted(rows, NOW())
    assert [r.manual_value for r in good.collect()] == ["f/3, wide"]
    newer = good.withColumn("manual_value", F.lit("f/4")).withColumn("created_at", F.lit("2027-01-01").cast("timestamp"))
    assert [r.manual_value for r in manual.upsert_manual(good, newer).collect()] == ["f/4"]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("brand\nA")
    with pytest.raises(ValueError, match="Missing required columns"):
        manual.read_manual_sheet(spark, str(tmp_path / "bad"))


def test_sheets(spark, sf_dir, tmp_path):
    specs = views.table(spark, sf_dir, "specs")
    manual.write_sheets({"specs": manual.sheet(specs, R.SPEC_SHEET, "BRAND#3")}, str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "specs"))
    assert tuple(back.columns) == R.SPEC_SHEET
    assert back.count() == specs.where("brand = 'Brand#3'").count()


def test_only_wanted_files_are_opened(spark, tmp_path):
    """Files outside the run can't even be read; a listed name with odd characters, a key without a file and rows without a page go well."""
    from specloom.sources import pages
    rows = [("http://a/1", "<b>é</b>"), ("http://a/2 %20?x=ü", "two"), ("http://a/3", "other run"), (None, "x"), ("http://a/4", None), ("http://a/5", "")]
    base = str(tmp_path / "html")
    pages.write_page_files(spark.createDataFrame(rows, "url string, html string"), base)
    assert sorted(os.listdir(base)) == ["http___a_1.html", "http___a_2 %20?x=ü.html", "http___a_3.html"]
    os.remove(f"{base}/http___a_3.html")
    os.mkfifo(f"{base}/http___a_3.html")  # opening it would never end
    catalog = spark.createDataFrame([("http://a/1",), ("http://a/1",), ("http://a/2 %20?x=ü",), ("http://a/5",), ("http://a/9",), (None,)], "product_url string")
    got = pages.pages_of_run(spark, base, catalog).collect()
    assert sorted((r.url, r.html) for r in got) == rows[:2] and all(r.fetched_at for r in got)
    assert pages.pages_of_run(spark, base, catalog.where("false")).count() == 0


def test_feed_and_page_files(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.json").write_text('{"products": [{"productModel": "X-1", "series": "Pro Series", "detailPath": "/a"},\n'
                                              '{"productModel": "X-1", "series": "Pro"}, {"productModel": "Y/2 b", "series": "pro"}], "filters": {}}')
    got = feed.feed_products(feed.read_feed(spark, str(tmp_path / "feed")), "Pro", "Pro", "A", "https://z.example").collect()
    assert sorted((r.product_model, r.product_url) for r in got) == [
        ("X-1", "https://z.example/a"), ("Y/2 b", "https://z.example/en/products/IP-Products/Network-Cameras/Pro-Series/y-2-b/")]
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "https___x.example_1.html").write_text("<html><body>\nhi</body>")
    files = pages.read_page_files(spark, str(tmp_path / "html"))
    catalog = spark.createDataFrame([("https://x.example/1",), ("https://x.example/2",), (None,)], "product_url string")
    got = pages.pages_for(catalog, files).collect()
    assert [(r.url, "hi" in r.html) for r in got] == [("https://x.example/1", True)]
    flags = pages.triage(files, F.current_timestamp() + F.expr("INTERVAL 2 DAYS")).first()
    assert (flags.stale, flags.needs_render, flags.too_short) == (True, True, True)


def test_compare_products(spark):
    rows = [spec(), spec(product_model="m2", normalized_value="1920x1080"), spec(field_code="interface_items", normalized_value='["a", "B"]'),
            spec(product_model="m2", field_code="interface_items", normalized_value='["b", "a"]'),
            spec(field_code="supplement_light_range", normalized_value="30 m"), spec(product_model="m2", field_code="supplement_light_range", normalized_value="100 ft")]
    pairs = spark.createDataFrame([("A", "m1", "A", "m2")], "left_brand string, left_model string, right_brand string, right_model string")
    got = {r.field_code: (r.same, r.ordering) for r in report.compare_products(frame(spark, rows, SPEC), pairs).collect()}
    assert got == {"max_resolution": (False, 1), "interface_items": (True, None), "supplement_light_range": (False, -1)}


def test_compare_products_parses_values_once(spark):
    rows = [spec(), spec(product_model="m2", normalized_value="1920x1080"), spec(field_code="aperture", normalized_value="F1.6"),
            spec(product_model="m2", field_code="aperture", normalized_value="f/2.0"), spec(product_model="m2", field_code="lens_type"),
            spec(field_code=None), spec(product_model="m2", field_code=None), spec(brand=None), spec(brand="B", product_model=None),
            spec(field_code="stream_count", normalized_value="none"), spec(product_model="m2", field_code="stream_count", normalized_value="None")]
    pairs = spark.createDataFrame([("A", "m1", "A", "m2")] * 2 + [("A", "m2", "A", "m1"), (None, "m1", "A", "m2"), ("A", "m1", "B", None), ("A", "m1", "A", "m9")],
                                  "left_brand string, left_model string, right_brand string, right_model string")
    got = report.compare_products(frame(spark, rows, SPEC), pairs)
    assert sorted((r.left_model, r.right_model, r.field_code, r.same, r.ordering or 0) for r in got.collect()) == sorted(
        [("m1", "m2", "aperture", False, -1), ("m1", "m2", "max_resolution", False, 1), ("m1", "m2", "stream_count", True, 0)] * 2
        + [("m2", "m1", "aperture", False, 1), ("m2", "m1", "max_resolution", False, -1), ("m2", "m1", "stream_count", True, 0)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert any("ReusedExchange" in line and "buf" in line for line in plan.splitlines())  # parsed values of the products, read by both sides


def test_streams_handle_late_and_repeated_rows(spark, tmp_path):
    schema = "event_id long, ts timestamp, event_type string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def deliver(*rows):
        spark.createDataFrame([(i, datetime.fromisoformat(ts), k) for i, ts, k in rows], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streams.run_to_table(streams.event_rate(stream, "ts", "event_id", "event_type"), out, state).awaitTermination()
        return {(str(r.window_start), r.event_type): r.n for r in streams.last_state(spark, out, "window_start", "event_type").collect()}

    assert deliver((1, "2026-01-01 00:10:00", "a"), (2, "2026-01-01 00:20:00", "a")) == {("2026-01-01 00:00:00", "a"): 2}
    # a repeated row is dropped, a new one counts
    assert deliver((2, "2026-01-01 00:20:00", "a"), (3, "2026-01-01 05:00:00", "a"))[("2026-01-01 00:00:00", "a")] == 2
    # later than the watermark (04:00): dropped
    assert deliver((4, "2026-01-01 00:30:00", "a"), (5, "2026-01-01 05:30:00", "a")) == {("2026-01-01 00:00:00", "a"): 2, ("2026-01-01 05:00:00", "a"): 2}


def test_complete_run(spark, sf_dir, tmp_path):
    t = lambda n: views.table(spark, sf_dir, n)
    one = "19960101_monthly_01"
    inputs = run.Inputs(t("product_pages"), t("catalog"), t("hierarchy"), t("manual"), t("runs"))
    base = str(tmp_path)
    out = run.run_once(spark, one, inputs, base, NOW())
    first = out["summary"].collect()
    assert [r.run_id for r in first] == [one] and first[0].spec_field_count > 0
    specs = snapshots.read_runs(spark, base, "specs", [one])
    assert first[0].spec_field_count == specs.count()
    assert first[0].issue_count == out["issues"].count()
    run.run_once(spark, one, inputs, base, NOW())  # a repeated run replaces itself
    assert snapshots.read_runs(spark, base, "specs", [one]).count() == first[0].spec_field_count


def test_shared_folder_has_to_be_set(spark):
    key, was = "spark.checkpoint.dir", spark.conf.get("spark.checkpoint.dir")
    session = spark.newSession()

    class Conf:
        def get(self, name, default=None):
            return default if name == key else session.conf.get(name, default)

    class Session:
        conf = Conf()
    with pytest.raises(ValueError, match=key):
        snapshots.shared_dir(Session())
    assert snapshots.shared_dir(spark).startswith(was)


def test_run_changes_reads_two_runs(spark):
    from specloom.plans.run import run_changes
    rows = [(r, b, "L", s) for r, b, s in (("1", "A", "x"), ("2", "A", "y"), ("3", "A", "y"), ("3", "A", "z"), ("1", "B", "q"), ("3", "B", "q"), ("3", "C", "n"))]
    hierarchy = spark.createDataFrame(rows, "run_id string, brand string, series_l1 string, series_l2 string")
    from specloom.operators import diff
    want = sorted(map(tuple, diff.hierarchy_changes(hierarchy).where("run_id = '3'").select("run_id", "brand", "series_l1", "series_l2", "change").collect()))
    got = sorted(map(tuple, run_changes(hierarchy, "3").select("run_id", "brand", "series_l1", "series_l2", "change").collect()))
    assert got == want == [("3", "A", "L", "z", "added")]


def test_run_delivered_again_counts_once(spark, tmp_path):
    cols = "run_id string, brand string, series_l1 string, series_l2 string, product_model string, field_code string, raw_value string, normalized_value string, unit string, extract_confidence double"
    bad = lambda run, n: [(run, "A", "s", "t", f"M{i}", "image_sensor", "", None, None, 1.0) for i in range(n)]
    good = [("r2", "A", "s", "t", "M1", "image_sensor", "x", "x", None, 1.0)]
    source, target, state = (str(tmp_path / n) for n in ("in", "counts", "state"))
    for rows in (bad("r1", 3) + bad("r2", 2), bad("r1", 3), good):
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(cols).parquet(source)
        streams.issue_counts_stream(stream, target, state).awaitTermination()
    assert {(r.run_id, r.issue_type): r.n for r in streams.issue_counts(spark, target).collect()} == {("r1", "missing_field"): 3}


def test_page_values_are_never_broadcast(spark, sf_dir):
    """What pages give is far larger than their files, so an estimate from these must not send it through the driver."""
    from specloom.checks.base import Tables
    from specloom.operators import extract
    t = Tables(spark, sf_dir)
    counts = extract.extraction_counts(t.catalog, t.product_pages, extract.extract_specs(t.catalog, t.product_pages))
    for df in (counts, extract.missing_pages(t.catalog, t.product_pages)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line and ("url" in line)]
        assert joins and all("strategy=merge" in line for line in joins), joins


def test_parts_are_never_broadcast_for_extraction_counts(spark, tmp_path):
    """Keys of parts are far larger than their file says, so an estimate from it must not send them through the driver."""
    from specloom import checks
    from specloom.checks import extraction
    from specloom.checks.base import Tables
    day = datetime(1996, 3, 1)
    parts = [(1, "a", "B1", "T", 3), (2, "b", "B1", "T", 4), (2, "c", "B2", "T", 5), (8, "d", "B2", None, 6), (None, "e", "B2", "T", 7)]
    lines = [(1, "A", day), (1, "A", day), (1, "N", day), (2, "R", day), (2, "R", datetime(1996, 9, 1)), (8, None, day), (None, "A", day), (1, "A", None), (77, "A", day)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame(lines, "l_partkey long, l_returnflag string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    t = Tables(spark, str(tmp_path))
    got, want = (sorted(map(repr, df.collect())) for df in (extraction.merged_catalog(t), t.catalog))
    assert got == want and len(got) == 8
    counts = checks.load().QUERIES["A15_extraction_counts"](spark, str(tmp_path))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "p_partkey" in line]
    assert len(joins) == 2 and all("strategy=merge" in line for line in joins), joins
