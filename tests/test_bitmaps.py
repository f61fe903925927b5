"""Distinct counts from bitmaps against count_distinct over any set of runs."""

import itertools

from pyspark.sql import functions as F

from specloom.sources.bitmaps import DistinctCounts

SCHEMA = "run_id string, brand string, product_model string"
RUNS = {"20240101_m_01": [("A", "m1"), ("A", "m2"), ("A", "m1"), ("B", "m2"), (None, "m9"), ("C", None)],
        "20240201_m_01": [("A", "m2"), ("A", "m3"), ("B", "é"), ("C", "m1")],
        "odd run": [("A", f"x{i}") for i in range(50)]}


def frame(spark, run, rows):
    return spark.createDataFrame([(run, *r) for r in rows], SCHEMA)


def by_brand(store, runs=None):
    rows = store.counts("n", run_ids=runs).collect()
    return {r["brand"] if r["level"] else "all": r["n"] for r in rows}


def expected(runs):
    rows = [r for run in runs for r in RUNS[run]]
    out = {b: len({m for c, m in rows if c == b and m is not None}) for b in {b for b, _ in rows}}
    return {**out, "all": len({m for _, m in rows if m is not None})}


def test_any_set_of_runs(spark, tmp_path):
    store = DistinctCounts(spark, str(tmp_path), "product_model", ["brand"])
    first, second, odd = RUNS
    store.add(frame(spark, first, RUNS[first]))
    store.add(frame(spark, odd, RUNS[odd][:7] + [("D", "gone")]))  # comes again below
    store.add(frame(spark, second, RUNS[second]).unionByName(frame(spark, odd, RUNS[odd])))
    for size in (1, 2, 3):
        for runs in itertools.combinations(RUNS, size):
            assert by_brand(store, list(runs)) == expected(runs)
    assert by_brand(store) == expected(RUNS)
    assert by_brand(store, ["no such run"]) == {"all": 0}
    store.add(frame(spark, first, []), replaces=[first])
    assert by_brand(store) == expected([second, odd])


def test_numbers_are_dense_and_kept(spark, tmp_path):
    store = DistinctCounts(spark, str(tmp_path), "k", ["g"])
    rows = lambda low, high: spark.range(low, high).select(F.lit("20240101_m").alias("run_id"), F.lit("g").alias("g"), F.col("id").cast("string").alias("k"))
    store.add(rows(0, 50_000))
    numbers = {r["key"]: (r["shard"], r["rank"]) for r in spark.read.parquet(f"{tmp_path}/keys").collect()}
    store.add(rows(40_000, 100_000).withColumn("run_id", F.lit("20240201_m")))
    after = spark.read.parquet(f"{tmp_path}/keys").collect()
    assert len(after) == 100_000 == len({(r["shard"], r["rank"]) for r in after})
    assert all(numbers.get(r["key"], (r["shard"], r["rank"])) == (r["shard"], r["rank"]) for r in after)
    assert max(r["rank"] for r in after) < 1.2 * 100_000 / 64
    assert [r["n"] for r in store.counts("n", [["g"]]).collect()] == [100_000]
    assert [r["n"] for r in store.counts("n", [[]], ["20240201_m"]).collect()] == [60_000]


def test_counts_read_no_runs(spark, tmp_path):
    """The plan of a count reads the bitmaps of the wanted runs only."""
    store = DistinctCounts(spark, str(tmp_path), "product_model", ["brand"])
    for run, rows in RUNS.items():
        store.add(frame(spark, run, rows))
    plan = store.counts("n", [["brand"]], [list(RUNS)[0]])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in text and "/keys" not in text


def test_small_groups_have_small_bitmaps(spark, tmp_path):
    """A group of few keys among many costs no more than its rows, and no aggregate sorts buffers (A2, A5)."""
    store = DistinctCounts(spark, str(tmp_path), "k", ["g"])
    store.add(spark.range(40_000).select(F.lit("20240101_m").alias("run_id"), (F.col("id") % 20_000).cast("string").alias("g"), F.col("id").cast("string").alias("k")))
    merged = store.merged()
    assert merged.count() == 40_000 - merged.where("bit_count(bits) > 1").count() and str(merged.schema["bits"].dataType) == "LongType()"
    got = store.counts("n", [["g"], []])
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r["level"], r["n"]) for r in got.collect()} == {(1, 2), (0, 40_000)}
