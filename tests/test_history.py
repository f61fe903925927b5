"""Histories of runs against the full recomputation: in order, late, repeated, emptied; what a step reads."""

import random

import pytest
from pyspark.sql import functions as F

from specloom.operators import diff
from specloom.sources import history as H

SPECS = "run_id string, brand string, product_model string, field_code string, normalized_value string, updated_at timestamp"
NODES = "run_id string, brand string, series_l1 string, series_l2 string, discovered_at timestamp"
RUNS = [f"2024{m:02d}01_monthly_01" for m in range(1, 11)]


def specs(spark, seed, runs=RUNS):
    r = random.Random(seed)
    rows = [(run, b, m, f, r.choice(["1", "2", None]), None) for run in runs for b in ("A", None) for m in ("m1", "m2", None) for f in ("x", "y") if r.random() < 0.7]
    return spark.createDataFrame(rows + rows[:3], SPECS)


def nodes(spark, seed, runs=RUNS):
    r = random.Random(seed)
    rows = [(run, b, l1, l2, None) for run in runs for b in "ABC" if r.random() < 0.7 for l1 in ("p", "q") for l2 in (None, "s", "t") if r.random() < 0.6]
    return spark.createDataFrame(rows, NODES)


def same(got, want):
    return sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))


CASES = {
    "values": (H.SPEC_VALUES, specs, H.spec_values, H.spec_changes, diff.spec_changes),
    "paths": (H.HIERARCHY_PATHS, nodes, H.hierarchy_paths, H.hierarchy_changes, diff.hierarchy_changes)}


@pytest.mark.parametrize("case", CASES)
def test_ten_runs_in_any_order(spark, tmp_path, case):
    """Ten runs, the later ones shuffled, two of them again with other rows, two emptied: as if all had been compared at once."""
    tracked, make, values, changes, full = CASES[case]
    r = random.Random(3)
    first, second = (make(spark, seed).cache() for seed in (1, 2))
    history = H.History(spark, str(tmp_path / "h"), tracked)
    now = {run: first.where(F.col("run_id") == run) for run in RUNS[:5]}
    history.load(values(first.where(F.col("run_id") < RUNS[5])))
    steps = [(run, first) for run in r.sample(RUNS[5:], 5)] + [(RUNS[4], second), (RUNS[9], second), (RUNS[5], first.where("false")), (RUNS[9], first.where("false"))]
    for i, (run, source) in enumerate(steps):
        now[run] = source.where(F.col("run_id") == run)
        history.add(values(now[run]).drop("run_id"), run)
        if i in (4, 8):
            table = first.where("false")
            for part in now.values():
                table = table.unionByName(part)
            assert same(changes(history), full(table))
    # the intervals are those of a history that is loaded at once
    loaded = H.History(spark, str(tmp_path / "loaded"), tracked)
    loaded.load(values(table))
    assert same(history.intervals(), loaded.intervals()) and same(changes(loaded), full(table))


def test_a_new_run_reads_the_open_part_only(spark, tmp_path):
    table = specs(spark, 5).cache()
    history = H.History(spark, str(tmp_path / "h"), H.SPEC_VALUES)
    history.load(H.spec_values(table.where(F.col("run_id") < RUNS[8])))
    parts = history._parts()[1]
    assert sum(p["kind"] == "interval" for p in parts) > 3
    assert [p["part"] for p in history.reached(parts, RUNS[8], RUNS[7])] == [H.OPEN]
    late = {p["part"] for p in history.reached(parts, RUNS[6], RUNS[5])}
    assert late and all(p == H.OPEN or p >= RUNS[5] for p in late)
    before = {(p["kind"], p["part"], p["gen"]) for p in parts}
    history.add(H.spec_values(table.where(F.col("run_id") == RUNS[8])).drop("run_id"), RUNS[8])
    after = {(p["kind"], p["part"], p["gen"]) for p in history._parts()[1]}
    assert before - after == {("interval", H.OPEN, 1)}  # nothing older is written anew


def test_a_step_that_failed_changes_nothing(spark, tmp_path):
    table = specs(spark, 6).cache()
    history = H.History(spark, str(tmp_path / "h"), H.SPEC_VALUES)
    history.load(H.spec_values(table.where(F.col("run_id") < RUNS[5])))
    before = sorted(map(str, history.changes().collect()))
    broken = H.spec_values(table.where(F.col("run_id") == RUNS[5])).drop("run_id").withColumn("value", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        history.add(broken, RUNS[5])
    assert sorted(map(str, history.changes().collect())) == before
    history.add(H.spec_values(table.where(F.col("run_id") == RUNS[5])).drop("run_id"), RUNS[5])
    assert same(H.spec_changes(history), diff.spec_changes(table.where(F.col("run_id") <= RUNS[5])))


def test_empty_histories(spark, tmp_path):
    history = H.History(spark, str(tmp_path / "h"), H.HIERARCHY_PATHS)
    assert history.changes().count() == 0
    history.add(H.hierarchy_paths(nodes(spark, 1).where("false")).drop("run_id"), RUNS[0])
    history.add(H.hierarchy_paths(nodes(spark, 1, RUNS[:1])).drop("run_id"), RUNS[0])
    assert history.changes().count() == 0 and history.intervals().where(F.col("to_run") != H.OPEN).count() == 0


def test_steps_of_the_checks_read_stored_values(spark, sf_dir, monkeypatch):
    """The tables are read once for the values of all runs, not again by each step."""
    from specloom.checks import history as checks
    from specloom.checks.base import Tables
    from specloom.sources import history as H
    seen = []
    monkeypatch.setattr(H.History, "load", lambda self, rows: seen.append(rows))
    monkeypatch.setattr(H.History, "add", lambda self, rows, run_id: seen.append(rows))
    t = Tables(spark, sf_dir)
    checks.kept_up(t, t.hierarchy, H.HIERARCHY_PATHS, H.hierarchy_paths)
    assert len(seen) == 4 and not any("lineitem" in f for rows in seen for f in rows.inputFiles())
    assert all(rows.count() for rows in seen)
