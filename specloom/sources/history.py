"""Run-over-run comparison without reading older runs (W6, W7 and U1 kept up to date).

A history is a table of intervals: a key held a value in all known runs from ``from_run`` to ``to_run``. A run is compared with its
neighbours by joining its rows with the intervals that touch them: the open ones for the newest run, those from the run
before on for one that arrives late or again. Intervals are stored by the run they end with, the ones that reach the newest run
together, so a new run reads and writes the open part only. Its changes are stored under its run id.

Every step writes a generation of its own and then a list of the parts that count, so a step that fails, or is repeated, changes
nothing that was there.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from specloom.operators.diff import paths

OPEN = "open"  # end of an interval that reaches the newest run
BETWEEN = [StructField("from_run", StringType()), StructField("to_run", StringType())]


@dataclass(frozen=True)
class Tracked:
    """What a history follows: a value, a struct of the columns ``value``, per ``keys``; runs are compared within ``group``."""
    keys: tuple[str, ...]
    value: StructType
    group: tuple[str, ...] = ()


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


#: The value of a product's field
SPEC_VALUES = Tracked(("brand", "product_model", "field_code"), _struct(value=StringType()))
#: Presence of a path in the runs of its brand
HIERARCHY_PATHS = Tracked(("brand", "series_l1", "series_l2"), _struct(here=StringType()), ("brand",))
#: Sightings of a product
SIGHTINGS = Tracked(("brand", "series_l1", "series_l2", "product_model"), _struct(first_seen_at=TimestampType(), last_seen_at=TimestampType()))


class History:
    """A history in the folder ``base``, which driver and executors share. Keys are strings."""

    def __init__(self, spark: SparkSession, base: str, tracked: Tracked):
        self.spark, self.base, self.tracked = spark, base, tracked
        keys = [StructField(k, StringType()) for k in tracked.keys]
        self.schemas = {
            "interval": StructType([*keys, StructField("value", tracked.value), *BETWEEN]),
            "change": StructType([*keys, StructField("run_id", StringType()), StructField("change_type", StringType()),
                                  StructField("old", tracked.value), StructField("new", tracked.value)]),
            "run": StructType([*(StructField(k, StringType()) for k in tracked.group), StructField("run_id", StringType())])}

    # reading

    def changes(self) -> DataFrame:
        """All changes: keys, ``run_id`` of the later run, ``change_type`` (new, changed, removed), ``old`` and ``new`` value."""
        return self._read("change", self._parts()[1])

    def intervals(self) -> DataFrame:
        """All intervals; ``to_run`` of those that reach the newest run is ``open``."""
        return self._read("interval", self._parts()[1])

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.base, *names))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _parts(self) -> tuple[int, list]:
        """Number of the last generation and its list: a row per stored part, small like the list of runs itself."""
        folder, system = self._path("parts")
        names = [f.getPath().getName() for f in (system.listStatus(folder) if system.exists(folder) else ())]
        # a list counts once Spark has marked its write as complete
        done = [int(n[4:]) for n in names if n.startswith("gen=") and system.exists(self._path("parts", n, "_SUCCESS")[0])]
        if not done:
            return 0, []
        return max(done), self.spark.read.parquet(os.path.join(self.base, "parts", f"gen={max(done)}")).collect()

    def _read(self, kind: str, parts: Iterable) -> DataFrame:
        hidden = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        places = [os.path.join(self.base, "data", f"gen={p['gen']}", f"kind={kind}", f"part={hidden(p['part'])}") for p in parts if p["kind"] == kind]
        if not places:
            return self.spark.createDataFrame([], self.schemas[kind])
        return self.spark.read.schema(self.schemas[kind]).parquet(*places)

    def reached(self, parts: Sequence, run_id: str, since: str) -> list:
        """Interval parts that a step for ``run_id`` reads: the open one and, unless it is the newest run, those that end at ``since`` or later."""
        newest = not any(p["kind"] == "run" and p["part"] >= run_id for p in parts)
        return [p for p in parts if p["kind"] == "interval" and (p["part"] == OPEN or (not newest and p["part"] >= since))]

    # writing

    def _store(self, gen: int, rows: DataFrame, kept: Iterable = ()) -> None:
        """Write ``rows`` (see :meth:`_rows`) in one pass and then the list of them and of the parts ``kept``."""
        base = os.path.join(self.base, "data", f"gen={gen}")
        rows.hint("rebalance", F.col("kind"), F.col("part")).write.mode("overwrite").partitionBy("kind", "part").parquet(base)
        plain = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        places, system = self._path("data", f"gen={gen}", "kind=*", "part=*")
        found = [f.getPath() for f in system.globStatus(places) or ()]
        parts = [(p.getParent().getName()[5:], plain(p.getName()[5:]), gen) for p in found]
        parts += [(p["kind"], p["part"], p["gen"]) for p in kept]
        self.spark.createDataFrame(parts, "kind string, part string, gen int").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(self.base, "parts", f"gen={gen}"))

    def _rows(self, kind: str, part: str, df: DataFrame) -> DataFrame:
        """Rows of one kind in the columns that all kinds share."""
        every = {f.name: f.dataType for schema in self.schemas.values() for f in schema}
        return df.select(F.lit(kind).alias("kind"), F.col(part).alias("part"), *(
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind_).alias(c) for c, kind_ in every.items()))

    def load(self, rows: DataFrame) -> None:
        """Start from many runs at once: ``rows`` has the keys, ``run_id`` and the value's columns, one row per run and key."""
        t, keys = self.tracked, list(self.tracked.keys)
        runs = rows.select(*t.group, "run_id").distinct()
        w = Window.partitionBy(*t.group).orderBy("run_id") if t.group else Window.orderBy("run_id")  # one row per run
        order = runs.select("*", F.row_number().over(w).alias("_no"), F.lead("run_id").over(w).alias("_next"))
        held = _on(rows.select(*keys, "run_id", self._value()), order, [*t.group, "run_id"], "inner")
        by_key = Window.partitionBy(*keys).orderBy("_no")
        near = held.select("*", F.lag("_no").over(by_key).alias("_p"), F.lag("value").over(by_key).alias("_old"), F.lead("_no").over(by_key).alias("_n"))
        no = F.col("_no")
        follows, goes_on = (F.coalesce(c, F.lit(False)) for c in (F.col("_p") == no - 1, F.col("_n") == no + 1))
        same = follows & F.col("value").eqNullSafe(F.col("_old"))
        events = [(no > 1) & ~follows, "run_id", None, "value"], [follows & ~same, "run_id", "_old", "value"], [
            F.col("_next").isNotNull() & ~goes_on, "_next", "value", None]
        changed = near.select(*keys, F.inline(self._events(*events)))
        islands = near.withColumn("_island", F.sum(F.when(same, 0).otherwise(1)).over(by_key)).groupBy(*keys, "_island").agg(
            F.min_by("value", "_no").alias("value"), F.min("run_id").alias("from_run"), F.max_by(F.struct("run_id", "_next"), "_no").alias("_end"))
        islands = islands.withColumn("to_run", F.when(F.col("_end._next").isNull(), OPEN).otherwise(F.col("_end.run_id")))
        self._store(self._parts()[0] + 1, self._rows("interval", "to_run", islands).unionByName(self._rows("change", "run_id", changed)).unionByName(
            self._rows("run", "run_id", runs)))

    def add(self, rows: DataFrame, run_id: str) -> None:
        """Compare one run with its neighbours and take it in: the newest one, one that arrives late, or a known one that replaces itself.

        ``rows`` has the keys and the value's columns, one row per key; rows of other runs are not looked at. A run
        (or its part of a group) without rows is no run: its neighbours are compared with each other.
        """
        t, keys, group = self.tracked, list(self.tracked.keys), list(self.tracked.group)
        last, parts = self._parts()
        known = self._read("run", parts)
        before = F.max(F.when(F.col("run_id") < run_id, F.col("run_id"))).alias("_before")
        after = F.min(F.when(F.col("run_id") > run_id, F.col("run_id"))).alias("_after")
        mine = rows.select(*group, F.lit(run_id).alias("run_id")).distinct()
        # per group (or for all rows) the known runs before and after, and whether the run has rows
        if group:
            here = mine.select(*group, F.lit(False).alias("_gone")).unionByName(known.where(F.col("run_id") == run_id).select(*group, F.lit(True).alias("_gone")))
            near = _on(here.groupBy(*group).agg(F.min("_gone").alias("_gone")), known.groupBy(*group).agg(before, after), group, "left")
            found = near.agg(F.min(F.coalesce("_before", F.lit(run_id))).alias("since"), F.collect_set("_after").alias("after")).first()
            since, renewed = found["since"] or run_id, [run_id, *found["after"]]

            def with_near(df):
                return _on(df, near.withColumn("_met", F.lit(True)), group, "left")
        else:
            found = known.agg(before, after).first()
            since, renewed = found["_before"] or run_id, [run_id, *([found["_after"]] if found["_after"] else [])]
            gone = not mine.take(1)

            def with_near(df):
                return df.withColumns({"_before": F.lit(found["_before"]).cast("string"), "_after": F.lit(found["_after"]).cast("string"),
                                       "_gone": F.lit(gone), "_met": F.lit(True)})
        read = self.reached(parts, run_id, since)
        start, end, is_open = F.col("from_run"), F.col("to_run"), F.col("to_run") == OPEN
        lower, upper = F.col("_before"), F.col("_after")
        reaches = lambda run: F.coalesce(F.col("_met") & (start <= run) & (is_open | (end >= run)), F.lit(False))
        alone = F.coalesce(F.col("_met") & (start == run_id) & F.when(is_open, upper.isNull()).otherwise(end == run_id), F.lit(False))
        held = with_near(self._read("interval", read)).withColumns({"_l": reaches(lower), "_r": reaches(upper), "_alone": alone})
        moving = F.col("_l") | F.col("_r") | F.col("_alone")
        old = held.where(moving).groupBy(*keys).agg(F.max(F.when(F.col("_l"), F.struct("value", "from_run"))).alias("_left"),
                                                    F.max(F.when(F.col("_r"), F.struct("value", "to_run"))).alias("_right"))
        both = with_near(_full(old, rows.select(*keys, self._value("_value")), keys))
        # the intervals that are left and right of the run, and its own between them
        has_left, has_right, here, gone = F.col("_left").isNotNull(), F.col("_right").isNotNull(), F.col("_here"), F.col("_gone")
        left, right, value = F.col("_left.value"), F.col("_right.value"), F.col("_value")
        on_left, on_right = has_left & here & value.eqNullSafe(left), has_right & here & value.eqNullSafe(right)
        across = gone & has_left & has_right & left.eqNullSafe(right)
        span = lambda v, a, b: F.struct(v.alias("value"), a.alias("from_run"), b.alias("to_run"))
        ends = F.when(upper.isNull(), F.lit(OPEN))
        spans = F.array(
            F.when(across, span(left, F.col("_left.from_run"), F.col("_right.to_run"))),
            F.when(has_left & ~on_left & ~across, span(left, F.col("_left.from_run"), F.when(gone, F.coalesce(ends, lower)).otherwise(lower))),
            F.when(here, span(value, F.when(on_left, F.col("_left.from_run")).otherwise(F.lit(run_id)),
                              F.when(on_right, F.col("_right.to_run")).otherwise(F.coalesce(ends, F.lit(run_id))))),
            F.when(has_right & ~on_right & ~across, span(right, upper, F.col("_right.to_run"))))
        first, inner = lower.isNull(), gone & lower.isNotNull() & upper.isNotNull()
        both = both.withColumn("_run", F.lit(run_id))
        events = self._events(
            [~gone & ~first & here & ~has_left, "_run", None, "_value"], [~gone & ~first & here & has_left & ~on_left, "_run", "_left.value", "_value"],
            [~gone & ~first & has_left & ~here, "_run", "_left.value", None], [~gone & has_right & ~here, "_after", None, "_right.value"],
            [~gone & has_right & here & ~on_right, "_after", "_value", "_right.value"], [~gone & upper.isNotNull() & here & ~has_right, "_after", "_value", None],
            [inner & has_right & ~has_left, "_after", None, "_right.value"], [inner & has_left & has_right & ~across, "_after", "_left.value", "_right.value"],
            [inner & has_left & ~has_right, "_after", "_left.value", None])
        # intervals and changes come from one pass over the join
        tagged = F.concat(
            F.transform(F.filter(spans, lambda s: s.isNotNull()), lambda s: self._tagged(interval=s)),
            F.transform(events, lambda e: self._tagged(change=e)))
        out = both.select(*keys, F.inline(tagged))
        out = out.select("kind", F.when(F.col("kind") == "interval", F.col("to_run")).otherwise(F.col("run_id")).alias("part"), *[
            c for c in self._rows("run", "run_id", mine).columns if c not in ("kind", "part")])
        out = out.unionByName(self._rows("interval", "to_run", held.where(~moving))).unionByName(self._rows("run", "run_id", mine))
        if group and len(renewed) > 1:  # changes of other groups at the runs that follow stay
            others = with_near(self._read("change", [p for p in parts if p["part"] in renewed[1:]]))
            out = out.unionByName(self._rows("change", "run_id", others.where("_met IS NULL OR NOT run_id <=> _after")))
        dropped = {("interval", p["part"]) for p in read} | {("change", r) for r in renewed} | {("run", run_id)}
        self._store(last + 1, out, [p for p in parts if (p["kind"], p["part"]) not in dropped])

    # expressions

    def _value(self, name: str = "value") -> Column:
        return F.struct(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.tracked.value)).alias(name)

    def _events(self, *cases) -> Column:
        """An array with one struct per case ``[condition, run, old, new]`` that holds."""
        kinds = {(False, True): "new", (True, True): "changed", (True, False): "removed"}
        side = lambda c: (F.col(c) if c else F.lit(None)).cast(self.tracked.value)
        found = F.array(*(F.when(condition, F.struct(F.col(run).cast("string").alias("run_id"), F.lit(kinds[bool(old), bool(new)]).alias("change_type"),
                                                     side(old).alias("old"), side(new).alias("new"))) for condition, run, old, new in cases))
        return F.filter(found, lambda e: e.isNotNull())

    def _tagged(self, interval: Column | None = None, change: Column | None = None) -> Column:
        """A struct with the columns of both kinds."""
        names = {f.name: f.dataType for kind in ("interval", "change") for f in self.schemas[kind] if f.name not in self.tracked.keys}
        mine = {f.name for f in self.schemas["change" if interval is None else "interval"]}
        source = change if interval is None else interval
        return F.struct(F.lit("change" if interval is None else "interval").alias("kind"), *(
            (source[n] if n in mine else F.lit(None)).cast(kind).alias(n) for n, kind in names.items()))


def _on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which NULL keys are equal; the left keys stay."""
    other = right.select(*(F.col(c).alias(f"_k_{c}" if c in keys else c) for c in right.columns))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(other, condition, how).drop(*(f"_k_{k}" for k in keys))


def _full(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on keys that may be NULL; ``_here``: the key is in ``new``."""
    marked = old.withColumn("_old", F.lit(True))
    other = new.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_value", F.lit(True).alias("_new"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return marked.join(other, condition, "full").select(
        *(F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys), "_left", "_right", "_value",
        F.coalesce("_new", F.lit(False)).alias("_here"))


# what the reports need ------------------------------------------------------------------------------------------------

def spec_values(specs: DataFrame) -> DataFrame:
    """One value per run, product and field, for :data:`SPEC_VALUES`."""
    keys = ["brand", "product_model", "field_code"]
    return specs.groupBy("run_id", *keys).agg(F.max(F.struct("updated_at", "normalized_value")).alias("m")).select(
        "run_id", *keys, F.col("m.normalized_value").alias("value"))


def hierarchy_paths(hierarchy: DataFrame) -> DataFrame:
    """The paths of every run, for :data:`HIERARCHY_PATHS`."""
    return paths(hierarchy).withColumn("here", F.lit(None).cast("string"))


def sightings(catalog: DataFrame) -> DataFrame:
    """First and last sighting of a product in every run, for :data:`SIGHTINGS`."""
    return catalog.groupBy("run_id", *SIGHTINGS.keys).agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))


def spec_changes(history: History) -> DataFrame:
    """W7 from the stored changes."""
    return history.changes().select(*SPEC_VALUES.keys, "run_id", "change_type", F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value"))


def hierarchy_changes(history: History) -> DataFrame:
    """U1 from the stored changes."""
    kind = F.when(F.col("change_type") == "new", "added").otherwise("removed")
    return history.changes().select("run_id", *HIERARCHY_PATHS.keys, kind.alias("change"))


def lifecycle(history: History, as_of: Column, days: int = 60) -> DataFrame:
    """W6 from the stored sightings."""
    seen = history.intervals().groupBy(*SIGHTINGS.keys).agg(F.min("value.first_seen_at").alias("first_seen_at"), F.max("value.last_seen_at").alias("last_seen_at"))
    gone = F.datediff(as_of, F.col("last_seen_at")) > days
    return seen.withColumn("catalog_status", F.when(gone, "discontinued").otherwise("current"))
