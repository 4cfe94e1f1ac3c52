"""Staging, facts and mart of one kind kept up to date batch by batch, by the hourly run and by the stream alike.

Three keyed logs under ``root``, partitioned by event date: staged rows, fact rows, mart states; and the bridge
(station -> areas) each run used. ``advance`` takes a staged batch and the bridge of now and writes only what they touch:

* facts of the batch's keys, and of all staged rows of stations whose ids or areas differ from the run before;
  a key that had fact rows and has none any more (its area or station left) gets a delete mark;
* mart states of the touched (plz, hour) groups. A group to which the batch only adds rows gets its state merged
  with the batch's (no old row is read). A group in which a row is replaced, or whose stations moved, is
  computed anew from the staged rows of its days; one without rows left gets a delete mark.

Reads are limited to the event dates touched (partition filters; the list of dates is bounded by the calendar),
but for moved stations, whose staged rows are read by a semi join over the log.

A retried run appends another attempt and states are merged onto the state before the run, so no row counts
twice. Rows without a station, or without an hour, reach no fact and no mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import mart_state as S
from stratus.operators import quality as Q
from stratus.operators.incremental import KeyedLog, tasks_for
from stratus.operators.joins import by_rows
from stratus.functions import spec
from stratus.plans import models
from stratus.session import materialize, side_by_side

HOUR_KEYS = ["wmo_station_id", "timestamp_utc"]
KEYS = {"observed": HOUR_KEYS, "forecast": [*HOUR_KEYS, "batch_id"]}
BRIDGE = ["wmo_station_id", "station_id", "postal_area_id", "plz"]
ZONE = ["wmo_station_id", "plz"]


def _dates(df: DataFrame) -> list:
    found = df.filter(F.col("timestamp_utc").isNotNull()).select(F.to_date("timestamp_utc").alias("d")).distinct()
    return [r.d for r in found.collect()]


def _differing(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """Stations whose rows of ``cols`` are not the same in both bridges."""
    both = before.select(*cols, F.lit(1).alias("_in")).union(after.select(*cols, F.lit(2)))
    one = both.groupBy(*cols).agg(F.min("_in").alias("_first"), F.max("_in").alias("_last")).filter("_first = _last")
    return one.select("wmo_station_id").distinct()


class Bridges:
    """The bridge of each run; a run that has the same as the one before writes nothing."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = KeyedLog(spark, root, ["wmo_station_id"], (), merge_schema=False, newest="run")

    def before(self, run: int) -> DataFrame | None:
        log = self.log.rows(before=run)
        last = None if log is None else log.agg(F.max(F.struct("_run", "_attempt")).alias("v")).first()["v"]
        if last is None:
            return None
        own = (F.col("_run") == last["_run"]) & (F.col("_attempt") == last["_attempt"])
        return log.filter(own & F.col("wmo_station_id").isNotNull()).select(*BRIDGE)

    def keep(self, bridge: DataFrame, run: int) -> None:
        # a row without a station, which joins nothing, so that an empty bridge is a version too
        mark = self.log.spark.range(1).select(*(F.lit(None).cast(bridge.schema[c].dataType).alias(c) for c in BRIDGE))
        self.log.append(bridge.select(*BRIDGE).union(mark), run)


class Gold:
    """``newest``: which staged version of a key wins (``KeyedLog``); ``tie``: the column that breaks ties."""

    def __init__(self, spark: SparkSession, root: str, kind: str, newest: str = "run", tie: str | None = None):
        keys, day = KEYS[kind], ("event_date",)
        self.spark, self.root, self.kind, self.keys = spark, root, kind, keys
        self.staging = KeyedLog(spark, f"{root}/stg_weather_{kind}", keys, day, newest=newest, tie=tie)
        self.facts = KeyedLog(spark, f"{root}/fact_weather_{kind}", keys, day, newest="run")
        self.mart_states = KeyedLog(spark, f"{root}/mart_state_{kind}", S.GROUP, day, merge_schema=False, newest="run")
        self.bridges = Bridges(spark, f"{root}/bridge_{kind}")
        self._loads = KeyedLog(spark, f"{root}/loads_{kind}", ["load_dts"], (), merge_schema=False, newest="run")

    def advance(self, batch: DataFrame, run: int, bridge: DataFrame) -> dict[str, DataFrame]:
        """Take a staged batch (a written table) as run ``run``; the fact rows and states it wrote."""
        bridge = bridge.select(*BRIDGE)
        before, earlier = self.bridges.before(run), self.staging.rows(before=run)
        self.staging.append(batch, run)
        self._loads.append(batch.agg(F.max("load_dts").alias("load_dts")).filter(F.col("load_dts").isNotNull()), run)
        first, moved = before is None, None
        before = bridge.limit(0) if first else before
        if earlier is not None and not earlier.isEmpty():
            moved = materialize(_differing(before, bridge, BRIDGE), "moved")
            moved = None if moved.isEmpty() else moved
        hit = batch.select(*self.keys).distinct()
        days = _dates(batch)
        # facts and states read staging, not each other
        facts, wrote = side_by_side(self.spark, lambda: self._facts(batch, run, bridge, hit, days, moved),
                                    lambda: self._states(batch, run, bridge, before, hit, days, moved))
        if first or moved is not None:
            self.bridges.keep(bridge, run)
        return {"facts": facts, "states": wrote}

    def _facts(self, batch, run, bridge, hit, days, moved) -> DataFrame:
        now = self.staging.current(days=days)
        now = batch.limit(0) if now is None else now
        due, gone = now.join(hit, self.keys, "left_semi"), None
        if moved is not None:
            shifted = materialize(self.staging.current(only=moved), "shifted")
            due = due.join(by_rows(moved), "wmo_station_id", "left_anti").unionByName(shifted, allowMissingColumns=True)
        facts = due.join(by_rows(bridge.drop("plz")), "wmo_station_id").select(
            *spec.FACT_COLUMNS, *(k for k in self.keys if k not in spec.FACT_COLUMNS))
        facts = materialize(facts, "facts")
        if moved is not None:
            gone = shifted.select(*self.keys).join(facts.select(*self.keys).distinct(), self.keys, "left_anti")
        self.facts.append(facts, run, gone=gone)
        return facts

    def _states(self, batch, run, bridge, before, hit, days, moved) -> DataFrame:
        zones = bridge.select(*ZONE)
        touched = hit.join(zones.distinct(), "wmo_station_id").select(*S.GROUP).distinct()
        known = self.staging.rows(days, before=run)
        anew = touched.limit(0)
        if known is not None:  # rows replaced by this batch
            again = hit.join(known.select(*self.keys).distinct(), self.keys, "left_semi")
            anew = again.join(zones.distinct(), "wmo_station_id").select(*S.GROUP).distinct()
        if moved is not None:
            rezoned = materialize(_differing(before, bridge, ZONE), "rezoned")
            if not rezoned.isEmpty():
                hours = self.staging.current(only=rezoned).select(*HOUR_KEYS).distinct()
                either = before.select(*ZONE).union(zones).distinct()
                anew = anew.union(hours.join(either, "wmo_station_id").select(*S.GROUP)).distinct()
        anew = materialize(anew, "groups_anew")
        sole, shared = S.split_zones(zones)
        changed = _dates(anew)
        rows = self.staging.current(days=changed) if changed else None
        fresh = None if rows is None else S.area_states(rows, sole, shared, anew)
        grown = materialize(touched.join(by_rows(anew), S.GROUP, "left_anti"), "groups_grown")
        added = S.area_states(batch, sole, shared, grown)
        tasks = tasks_for(grown)
        old = self.mart_states.current(only=grown, days=days, before=run, tasks=tasks)
        if old is not None:
            added = S.merge(old, added.repartition(tasks, *S.GROUP))
        new = materialize(added if fresh is None else fresh.unionByName(added), "states")
        self.mart_states.append(new, run, gone=anew.join(by_rows(new.select(*S.GROUP)), S.GROUP, "left_anti"))
        return new

    def kept_failures(self) -> dict[str, Q.KeptFailures]:
        """What fails now in staging, facts and mart: ``follow`` each after a run's ``advance``."""
        logs = {f"stg_{self.kind}": (self.staging, None), f"fact_{self.kind}": (self.facts, None),
                f"mart_{self.kind}": (self.mart_states, S.finish)}
        return {table: Q.KeptFailures(log, f"{self.root}/failures_{table}", Q.row_checks(table), view)
                for table, (log, view) in logs.items()}

    def loads(self, run: int) -> DataFrame | None:
        """``load_dts``, the newest of each run before ``run``: what its high-water filter reads."""
        return self._loads.rows(before=run)

    def staged(self) -> DataFrame | None:
        return self.staging.current()

    def fact(self) -> DataFrame | None:
        found = self.facts.current(bounded=True)
        return None if found is None else found.select(*spec.FACT_COLUMNS)

    def mart(self, outlier_rule: str = "faithful") -> DataFrame | None:
        found = self.mart_states.current(bounded=True)
        return None if found is None else S.finish(found, outlier_rule)
