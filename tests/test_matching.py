"""Alias index and counterparts of two brands against the comparisons of all pairs."""

import itertools
import random
import time

from pyspark.sql import functions as F

from specloom.operators import aliases, counterparts
from tests.conftest import frame

ALIASES = "field_code string, alias string, alias_rank int"


def word(r, n=None):
    return "".join(r.choices("abcdeäß日 ", k=n or r.randint(1, 9)))


def test_alias_index_equals_the_comparison_of_all(spark):
    r = random.Random(1)
    table = [(f"f{i % 7}", word(r).upper() if i % 3 else word(r), i) for i in range(300)] + [("f1", "", 0), ("f2", None, 1), ("f3", "a", 5), ("f3", "A", 2)]
    labels = [(i, "".join(word(r) for _ in range(r.randint(0, 4)))) for i in range(200)] + [(900, None), (901, ""), (902, "ab"), (903, "ab"), (902, "ab")]
    got = aliases.label_fields(spark.createDataFrame(labels, "id int, text string"), "text", spark.createDataFrame(table, ALIASES))
    want = []
    for i, text in labels:
        best = {}
        for field, alias, rank in table:
            if alias and text and alias.lower() in text.lower():
                best[field] = min(rank, best.get(field, rank))
        want += [(i, text, f, k) for f, k in best.items()]
    assert len(want) > 300 and sorted(tuple(x) for x in got.collect()) == sorted(want)
    assert got.columns == ["id", "text", "field_code", "alias_rank"]


def test_ten_thousand_aliases_take_the_same_plan(spark):
    r = random.Random(2)
    labels = spark.createDataFrame([(i, word(r, 40)) for i in range(2000)], "id int, text string").cache()
    sizes, seconds = [], []
    for n in (100, 10_000):
        table = spark.createDataFrame([(f"f{i % 50}", word(r, 8), i) for i in range(n)], ALIASES).cache()
        table.count()
        got = aliases.label_fields(labels, "text", table)
        sizes.append(len(got._jdf.queryExecution().analyzed().toString().splitlines()))
        begin = time.perf_counter()
        got.count()
        seconds.append(time.perf_counter() - begin)
    assert sizes[0] == sizes[1] and seconds[1] < 4 * seconds[0] + 5


SPEC = "brand string, product_model string, field_code string, normalized_value string, updated_at int"
FIELDS = ("image_sensor", "aperture", "stream_count", "interface_items", "approval_protection", "lens_type")


def test_counterparts_are_the_best_of_all_pairs(spark):
    r = random.Random(4)
    rows = []
    for brand, n in (("A", 60), ("B", 80), ("C", 20)):
        for m in range(n):
            for f in FIELDS:
                if r.random() < 0.85:  # the first value of a field is that of most products
                    value = r.choices(["F1.6", "f/2", "ip67", '["a", "b"]', "x, y", "IP66"], [20, 3, 2, 1, 1, 1])[0]
                    rows.append({"brand": brand, "product_model": f"m{m:02d}", "field_code": f, "normalized_value": value, "updated_at": r.randint(0, 3)})
    specs = frame(spark, rows + rows[:20], SPEC).cache()
    products = counterparts.signatures(specs).cache()
    tokens = {(x["brand"], x["product_model"]): set(x["tokens"]) for x in products.collect()}
    for least, most in ((1, 2), (4, 3)):
        want = []
        for (brand, left) in tokens:
            if brand == "A":
                near = sorted((-len(tokens["A", left] & t), m) for (b, m), t in tokens.items() if b == "B" and len(tokens["A", left] & t) >= least)
                want += [(left, m, -s, k + 1) for k, (s, m) in enumerate(near[:most])]
        got = counterparts.matches(products, "A", "B", most, least)
        assert want and sorted(tuple(x) for x in got.collect()) == sorted(want)
    assert counterparts.matches(products, "A", "none", 3, 1).count() == 0


def test_no_plan_pairs_everything(spark):
    specs = frame(spark, [{"brand": b, "product_model": "m", "field_code": "aperture", "normalized_value": "F1.6", "updated_at": 1} for b in "AB"], SPEC)
    plan = counterparts.counterparts(specs, "A", "B")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert list(itertools.chain(*counterparts.counterparts(specs, "A", "B", 1, 1).collect())) == ["m", "m", 1, 1]


def test_blocks_of_any_size_bring_the_same_counterparts(spark):
    """Common values make nearly all products pairs; blocks of a few classes give what one block gives, and no pair is a row."""
    r = random.Random(9)
    rows = [{"brand": b, "product_model": f"{m}é" if m % 9 == 0 else f"m{m}", "field_code": f, "normalized_value": r.choice(["F1.6", "f/2", "x"]), "updated_at": 1}
            for b in "AB" for m in range(90) for f in (*FIELDS, "no such field")]
    products = counterparts.signatures(frame(spark, rows, SPEC)).cache()
    whole = sorted(tuple(x) for x in counterparts.matches(products, "A", "B", 3, 2).collect())
    assert len(whole) == 270
    assert sorted(tuple(x) for x in counterparts.matches(products, "A", "B", 3, 2, 7, 11).collect()) == whole
    plan = counterparts.matches(products, "A", "B", 3, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "FlatMapCoGroupsInPandas" in plan


def test_a_run_split_over_micro_batches(spark, tmp_path):
    """Three files of one delivery, one per batch, then a restart, a repeated batch folder and a second delivery without issues."""
    from specloom import schemas
    from specloom.operators.quality import detect_spec_issues
    from specloom.streaming import issues
    schema = schemas.StructType(list(schemas.SPECS.fields)).add("delivery", "long")
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def deliver(delivery, run, values):
        rows = frame(spark, [{"run_id": run, "brand": "A", "product_model": f"m{i}", "field_code": "aperture", "raw_value": v, "normalized_value": v,
                              "extract_confidence": 1.0} for i, v in enumerate(values)],
                     "run_id string, brand string, product_model string, field_code string, raw_value string, normalized_value string, extract_confidence double")
        full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SPECS],
                           F.lit(delivery).cast("long").alias("delivery"))
        full.coalesce(1).write.mode("append").parquet(source)

    def counts():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        issues.issue_counts_stream(stream, target, state, "delivery").awaitTermination()
        return {(x["run_id"], x["issue_type"]): x["n"] for x in issues.issue_counts(spark, target).collect()}

    for part in (["f", None], [None], [None, "g", None]):
        deliver(9, "r1", part)
    deliver(9, "r2", ["ok", None])
    batch = detect_spec_issues(spark.read.schema(schema).parquet(source)).groupBy("run_id", "issue_type").count()
    want = {(x["run_id"], x["issue_type"]): x["count"] for x in batch.collect()}
    assert counts() == want and want["r1", "missing_field"] == 4
    deliver(10, "r1", [None])  # ten is after nine, not before it
    assert counts()["r1", "missing_field"] == 1
    deliver(9, "r1", [None, None])  # a late part of the old delivery
    got = counts()
    assert got["r1", "missing_field"] == 1 and got["r2", "missing_field"] == want["r2", "missing_field"]
