"""Checks of histories: most runs are loaded at once, the others come one by one, late, newest and again; the oracles compare all runs."""

import os

from pyspark.sql import functions as F

from specloom.checks import reports  # noqa: F401  (its oracles are used below)
from specloom.checks.base import ORACLES, QUERIES, check
from specloom.checks.storage import folder
from specloom.sources import history as H


def kept_up(t, rows, tracked, values):
    """A history of all runs of ``rows``: one run is left out and arrives late, one is loaded with a part of its rows and comes again, the newest comes last."""
    base = folder(t)
    # the tables make the values of all runs once; a step then reads those of its runs
    values(rows).select("*", F.col("run_id").alias("part")).hint("rebalance", F.col("part")).write.partitionBy("part").parquet(os.path.join(base, "values"))
    stored = t.spark.read.parquet(os.path.join(base, "values"))
    runs = sorted(r["run_id"] for r in rows.select("run_id").distinct().collect())
    again, late, newest = runs[len(runs) // 3], runs[len(runs) // 2], runs[-1]
    history = H.History(t.spark, os.path.join(base, "history"), tracked)
    run = F.col("run_id")
    history.load(stored.where(~run.isin(late, newest) & ((run != again) | (F.crc32(F.col("brand").cast("binary")) % 2 == 0))).drop("part"))
    for name in (late, again, newest):
        history.add(stored.where((run == name) & (F.col("part") == name)).drop("part", "run_id"), name)
    return history


check("W7_history")(lambda t: H.spec_changes(kept_up(t, t.specs, H.SPEC_VALUES, H.spec_values)))
check("U1_history")(lambda t: H.hierarchy_changes(kept_up(t, t.hierarchy, H.HIERARCHY_PATHS, H.hierarchy_paths)))
check("W6_history")(lambda t: H.lifecycle(kept_up(t, t.catalog, H.SIGHTINGS, H.sightings), F.lit("2001-11-05").cast("date")))
for _name, _whole in (("W7_history", "W7_spec_changes"), ("U1_history", "U1_hierarchy_changes"), ("W6_history", "W6_lifecycle")):
    assert _name in QUERIES
    ORACLES[_name] = ORACLES[_whole]
