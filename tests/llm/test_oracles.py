"""Registered queries of the operators on the given tables: against SQL where there is one, and the pipeline stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from specloom.llm import queries, toxicity  # noqa: E402
from specloom.llm.common import table  # noqa: E402
from tools import compare  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    ok, text = compare.compare(spark, compare.connect(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, text


def test_pipeline_against_brute_force(spark, sf_dir):
    """Every stage on the given documents: what goes, what stays and what is packed."""
    from tests.llm.test_operators import plain_near
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf_dir)
    toxic = {r["doc_id"] for r in toxicity.predictions(docs, table(spark, sf_dir, "labels")).where("predicted = 1").collect()}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == set(texts) - toxic
    exact = stages["exact_dedup"](spark, clean, sf_dir)
    newest = {}
    for d in sorted(set(texts) - toxic):
        newest[texts[d]] = d
    assert exact.columns == docs.columns and {r["doc_id"] for r in exact.collect()} == set(newest.values())
    near = stages["near_dedup"](spark, exact, sf_dir)
    named = plain_near([(d, texts[d]) for d in newest.values()])
    assert {r["doc_id"] for r in near.collect()} == {d for d in newest.values() if named.get(d, d) == d}
    sanitised = stages["pii"](spark, near, sf_dir)
    after = {r["doc_id"]: r["text"] for r in sanitised.collect()}
    assert sanitised.columns == docs.columns and set(after) == {r["doc_id"] for r in near.collect()}
    assert all("@" not in t or "@" not in texts[d] for d, t in after.items())
    packed = stages["packing"](spark, sanitised, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(after)
