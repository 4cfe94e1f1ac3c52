"""Keys pack to a few bytes a row, so what the driver builds to broadcast is bounded by rows, not by packed bytes."""

import re

from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.operators import joins, link
from stratus.operators import mart_state as S
from stratus.operators.incremental import KeyedLog
from stratus.plans import gold as G
from stratus.plans import models
from stratus.session import materialize

STATIONS, HOURS, MOST = 20, 20, 50
HOUR_KEYS = ["wmo_station_id", "timestamp_utc"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _joins(df, kind):
    return set(re.findall(rf"(\w+Join)\b[^\n]*\b{kind}\b", _plan(df)))


def _staged(spark, temperature):
    n = STATIONS * HOURS
    rows = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id") % STATIONS).alias("wmo_station_id"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / STATIONS).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("timestamp_utc"),
        *(F.lit(temperature + i).alias(m.name) for i, m in enumerate(spec.MEASURES)), F.lit(None).cast("string").alias("outlier_flag"),
        F.lit(1.0).alias("confidence_score"), *(F.lit("t").alias(c) for c in ("record_source", "bright_sky_source_mapping")), F.lit("2024-01-02").cast("timestamp_ntz").alias("load_dts"),
        *(F.lit("dry").alias(c) for c in S.TEXTS))
    return materialize(rows, "staged")


def test_a_view_of_many_keys_does_not_broadcast_them(spark, tmp_dir, monkeypatch):
    log = KeyedLog(spark, f"{tmp_dir}/log", HOUR_KEYS, ("event_date",), newest="run")
    staged = _staged(spark, 1.0)
    log.append(staged, 0)
    some = materialize(staged.select(*HOUR_KEYS).filter(F.hour("timestamp_utc") < 10), "some")
    want = log.current(only=some)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", MOST, raising=False)
    for tasks in (None, 3):
        got = log.current(only=some, tasks=tasks)
        assert _joins(got, "LeftSemi") == {"SortMergeJoin"}
        assert got.count() == some.count() > MOST and got.exceptAll(want).isEmpty()


def test_states_of_many_groups_do_not_broadcast_them(spark, monkeypatch):
    staged = _staged(spark, 1.0)
    zones = staged.select("wmo_station_id", F.concat(F.lit("1"), "wmo_station_id").alias("plz")).distinct()
    groups = materialize(staged.select(F.concat(F.lit("1"), "wmo_station_id").alias("plz"), "timestamp_utc"), "groups")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", MOST, raising=False)
    got = S.area_states(staged, *S.split_zones(zones), groups)
    assert "BroadcastHashJoin" not in _plan(got)
    assert got.count() == STATIONS * HOURS


def test_replaced_groups_and_new_states_are_not_broadcast(spark, tmp_dir, monkeypatch):
    bridge = materialize(spark.range(STATIONS).select(
        F.concat(F.lit("s"), "id").alias("wmo_station_id"), F.col("id").alias("station_id"), F.col("id").alias("postal_area_id"),
        F.concat(F.lit("1"), "id").alias("plz")), "bridge")
    seen, write, append = {}, G.materialize, KeyedLog.append

    def written(df, name="t"):
        seen[name] = _joins(df, "LeftAnti")
        return write(df, name)

    def appended(log, batch, run, gone=None):
        if gone is not None and "mart_state" in log.root:
            seen["gone"] = _joins(gone, "LeftAnti")
        append(log, batch, run, gone)

    monkeypatch.setattr(joins, "BROADCAST_ROWS", MOST, raising=False)
    monkeypatch.setattr(G, "materialize", written)
    monkeypatch.setattr(KeyedLog, "append", appended)
    table = G.Gold(spark, f"{tmp_dir}/gold", "observed")
    for run in range(2):  # the second replaces every row
        table.advance(_staged(spark, float(run)), run, bridge)
    assert seen["groups_grown"] == seen["gone"] == {"SortMergeJoin"}
    staged = _staged(spark, 1.0)
    fact = materialize(staged.join(bridge.drop("plz"), "wmo_station_id").select(*spec.FACT_COLUMNS), "fact")
    want = models.mart_weather(fact, bridge.select(F.col("postal_area_id").alias("id"), "plz"), sort=False)
    got = table.mart()
    assert got.count() == STATIONS * HOURS and got.exceptAll(want.select(*got.columns)).isEmpty()


def test_edges_of_many_areas_are_not_broadcast(spark, monkeypatch):
    edges = materialize(spark.range(400).select(F.col("id").alias("aid"), F.explode(F.array([F.lit(i) for i in range(4)])).alias("no")).select(
        "aid", "no", *(F.lit(v).alias(c) for c, v in (("x1", 0.0), ("x2", 1.0))), F.col("no").cast("double").alias("y1"),
        (F.col("no") + 1).cast("double").alias("y2")), "edges")
    pairs = materialize(spark.range(400).select(F.col("id").alias("aid"), F.lit(7).alias("sid"), F.lit(0.5).alias("x"), F.lit(1.5).alias("y")), "pairs")
    want = link._meet_bands(pairs, edges).count()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", MOST, raising=False)
    got = link._meet_bands(pairs, edges)
    scans_broadcast = re.findall(r"BroadcastExchange[^\n]*\n[^\n]*Generate", _plan(got))
    assert not scans_broadcast and "SortMergeJoin" in _plan(got) and got.count() == want > 0


def test_bridges_that_differ_are_found_without_a_join(spark):
    schema = "wmo_station_id string, plz string"
    one = [("a", "1"), ("b", "1"), (None, "2"), ("c", None), ("d", "1"), ("d", "1")]
    two = [("a", "1"), ("b", "2"), (None, "2"), ("c", None), ("d", "1"), (None, "3"), ("e", "1")]
    found = G._differing(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), ["wmo_station_id", "plz"])
    assert "Join" not in _plan(found)
    assert sorted((r[0] for r in found.collect()), key=str) == [None, "b", "e"]
