import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from specloom.session import configure
    configure(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def frame(spark, rows, schema):
    """Small DataFrame from dicts; missing keys become NULL."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
