"""Every registered query against its SQL oracle, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from specloom import checks  # noqa: E402
from tools import compare  # noqa: E402

# the training-data operators have tests of their own
QUERIES, ORACLES = checks.load().QUERIES, checks.load().ORACLES
COMPILED = ("X", "N", "J1_", "W4_", "A15_")


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    # for extraction and normalization, code that does not compile fails the test instead of taking a slower path
    spark.conf.set("spark.sql.codegen.fallback", str(not name.startswith(COMPILED)).lower())
    try:
        ok, text = compare.compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    assert ok, text


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
