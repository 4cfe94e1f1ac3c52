"""Facts and mart states kept up to date batch by batch equal a full build: replaced rows, retractions, retries, ties."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.operators import mart_state as S
from stratus.plans import models
from stratus.plans.gold import Gold
from stratus.session import materialize

T0 = dt.datetime(2024, 1, 1)
RAW = "wmo_station_id string, timestamp_utc timestamp_ntz, raw string, bright_sky_source_mapping string, record_source string, load_dts timestamp_ntz"
BRIDGE = "wmo_station_id string, station_id long, postal_area_id long, plz string"


def raw_rows(rng, n, load, hours=30, stations=6):
    """Documents with gaps, outliers, repeated hours; some without a load stamp."""
    def doc():
        d = {m: rng.choice([None, rng.uniform(-80, 90), 1013.0]) for m in spec.MEASURE_NAMES if rng.random() < 0.8}
        if rng.random() < 0.9:
            d["temperature"] = rng.choice([20.0, rng.uniform(-60, 60)])
        return json.dumps({**d, "condition": rng.choice(["rain", "sun", None]), "icon": rng.choice(["a", "b", "c"])})
    return [(f"{rng.randrange(stations):05d}", T0 + dt.timedelta(hours=rng.randrange(hours)), doc(), "{}", "t",
             rng.choice([load, load + dt.timedelta(minutes=1), None])) for _ in range(n)]


def bridge_of(spark, served):
    return materialize(spark.createDataFrame([(s, i, a, p) for s, i, a, p in served], BRIDGE), "bridge")


def rows(df, cols):
    out = [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()]
    return sorted(out, key=str)


def full_mart(spark, staged, bridge):
    area = bridge.select(F.col("postal_area_id").alias("id"), "plz").distinct()
    fact = staged.join(bridge.drop("plz"), "wmo_station_id").select(*spec.FACT_COLUMNS)
    return fact, models.mart_weather(fact, area, sort=False)


BRIDGES = [
    [("00000", 1, 1, "10001"), ("00001", 2, 2, "10002"), ("00002", 3, 3, "10003"), ("00000", 1, 4, "10004")],
    [("00000", 1, 1, "10001"), ("00001", 2, 2, "10002"), ("00002", 3, 3, "10003"), ("00000", 1, 4, "10004")],
    [("00000", 1, 1, "10001"), ("00002", 2, 2, "10003"), ("00003", 3, 3, "10004")],  # an area and a station left, one moved
    [],  # nothing is served
    [("00005", 7, 9, "10001"), ("00000", 1, 1, "10001x")],
]


@pytest.mark.parametrize("kind", ["observed", "forecast"])
def test_runs_equal_a_full_build(spark, tmp_dir, kind):
    rng = random.Random(len(kind))
    gold, staged = Gold(spark, tmp_dir, kind), None
    for run, served in enumerate(BRIDGES):
        bridge = bridge_of(spark, served)
        n = 0 if run in (3, 4) else 120
        batch = models.stg_weather(spark.createDataFrame(raw_rows(rng, n, T0 + dt.timedelta(days=run)), RAW), kind)
        batch = materialize(batch.withColumn("batch_id", F.lit(run).cast("long")) if kind == "forecast" else batch, "batch")
        wrote = gold.advance(batch, run, bridge)
        # the later run replaces a key of the observed table, whatever the stamps; forecasts keep every run
        keys = gold.keys
        staged = batch if staged is None else materialize(staged.join(batch, keys, "left_anti").unionByName(batch), "staged")
        if run in (2, 4):
            fact, mart = full_mart(spark, staged, bridge)
            assert rows(gold.staged(), spec.STAGED_COLUMNS) == rows(staged, spec.STAGED_COLUMNS)
            assert rows(gold.fact(), spec.FACT_COLUMNS) == rows(fact, spec.FACT_COLUMNS)
            assert rows(gold.mart(), spec.mart_columns()) == rows(mart, spec.mart_columns())
        if run == 3:
            assert gold.fact().count() == gold.mart().count() == 0
        if run == 1:  # only what the batch touches was written
            touched = batch.join(bridge, "wmo_station_id").select(*S.GROUP).distinct().count()
            assert wrote["states"].count() <= touched < gold.mart().count() * 2
    assert gold.mart("any").count() == gold.mart().count()


def test_a_run_that_failed_midway_can_be_retried(spark, tmp_dir, monkeypatch):
    rng = random.Random(3)
    bridge = bridge_of(spark, BRIDGES[0])
    batches = [materialize(models.stg_weather(spark.createDataFrame(raw_rows(rng, 80, T0 + dt.timedelta(days=i)), RAW), "forecast")
                           .withColumn("batch_id", F.lit(i).cast("long")), "batch") for i in range(2)]
    gold = Gold(spark, tmp_dir, "forecast")
    gold.advance(batches[0], 0, bridge)
    with monkeypatch.context() as m:
        m.setattr(gold.mart_states, "append", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            gold.advance(batches[1], 1, bridge)
    assert gold.loads(1).count() == 1  # the retry's high-water mark is that of the run before
    for _ in range(2):  # the retry, and another one
        gold.advance(batches[1], 1, bridge)
    fact, mart = full_mart(spark, batches[0].unionByName(batches[1]), bridge)
    assert rows(gold.fact(), spec.FACT_COLUMNS) == rows(fact, spec.FACT_COLUMNS)
    assert rows(gold.mart(), spec.mart_columns()) == rows(mart, spec.mart_columns())


def test_batch_boundaries_and_order_do_not_change_the_newest_load(spark, tmp_dir):
    """As the stream does it: the newest load wins, ties by document, whatever micro-batch brings a row."""
    rng = random.Random(5)
    raw = raw_rows(rng, 200, T0, hours=8, stations=3)
    bridge = bridge_of(spark, BRIDGES[0])
    staged = models.stg_weather(spark.createDataFrame(raw, RAW))
    fact, mart = full_mart(spark, staged, bridge)
    gold = Gold(spark, tmp_dir, "observed", newest="load", tie=models.TIE)
    rng.shuffle(raw)
    for part in (raw[:50], raw[50:170], raw[170:], raw[:120]):  # the last is a replay
        batch = materialize(models.stg_weather(spark.createDataFrame(part, RAW), keep_tie=True), "batch")
        gold.advance(batch, gold.staging.next_run(), bridge)
    assert rows(gold.staged(), spec.STAGED_COLUMNS) == rows(staged, spec.STAGED_COLUMNS)
    assert rows(gold.fact(), spec.FACT_COLUMNS) == rows(fact, spec.FACT_COLUMNS)
    assert rows(gold.mart(), spec.mart_columns()) == rows(mart, spec.mart_columns())


def test_touched_days_are_partition_filters(spark, tmp_dir):
    rng = random.Random(7)
    gold = Gold(spark, tmp_dir, "observed")
    gold.advance(materialize(models.stg_weather(spark.createDataFrame(raw_rows(rng, 60, T0, hours=100), RAW)), "b"), 0, bridge_of(spark, BRIDGES[0]))
    plan = gold.staging.current(days=[T0.date()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "WindowGroupLimit" in plan


def test_identical_values_merge_to_no_deviation(spark):
    some = [("1", T0, 1013.1, "x", 0.5)] * 3
    schema = "plz string, timestamp_utc timestamp_ntz, v double, weather_condition string, confidence_score double"
    df = spark.createDataFrame(some, schema)
    full = df.select("plz", "timestamp_utc", *[F.col("v").alias(m) for m in spec.MEASURE_NAMES], "weather_condition",
                     F.lit(None).cast("string").alias("weather_icon"), F.lit(None).cast("string").alias("outlier_flag"),
                     "confidence_score", F.lit(T0).cast("timestamp_ntz").alias("load_dts"))
    got = S.finish(S.merge(S.merge(S.states(full), S.states(full)), S.states(full.limit(0)))).collect()
    assert len(got) == 1 and got[0].pressure_msl_std == 0.0 and got[0].station_count == 6
    assert got[0].weather_condition_mode == "x" and got[0].weather_icon_mode is None


def test_states_are_made_per_station_not_per_area(spark, monkeypatch):
    """Rows of a station that serves many areas are aggregated once; areas of several stations still meet all their rows."""
    rng, made, states = random.Random(5), [], S.states

    def counted(found, by=S.GROUP):
        made.append(found.count())
        return states(found, by)

    staged = materialize(models.stg_weather(spark.createDataFrame(raw_rows(rng, 120, T0), RAW), "observed"), "staged")
    served = [("00000", f"2{n:04d}") for n in range(40)] + [("00001", "30000"), ("00002", "30000"), ("00003", "30001"), (None, "30002")]
    zones = materialize(spark.createDataFrame(served, "wmo_station_id string, plz string"), "zones")
    groups = materialize(staged.join(zones, "wmo_station_id").select(*S.GROUP).distinct(), "groups")
    wanted = S.finish(states(staged.join(zones, "wmo_station_id")))
    monkeypatch.setattr(S, "states", counted)
    got = S.finish(S.area_states(staged, *S.split_zones(zones), groups))
    cols = spec.mart_columns()
    assert rows(got, cols) == rows(wanted, cols) and wanted.count() > 0
    assert sum(made) <= staged.count()


def test_facts_and_states_of_both_kinds_are_written_at_once(spark, tmp_dir, monkeypatch):
    import threading
    from stratus.session import side_by_side
    met = threading.Barrier(2, timeout=60)

    def waiting(made):
        def step(*args):
            met.wait()
            return made(*args)
        return step

    monkeypatch.setattr(Gold, "_facts", waiting(Gold._facts))
    monkeypatch.setattr(Gold, "_states", waiting(Gold._states))
    bridge = bridge_of(spark, BRIDGES[0])
    batch = materialize(models.stg_weather(spark.createDataFrame(raw_rows(random.Random(3), 60, T0), RAW), "observed"), "batch")
    gold = Gold(spark, tmp_dir + "/gold", "observed")
    gold.advance(batch, 0, bridge)
    fact, mart = full_mart(spark, batch, bridge)
    assert rows(gold.mart(), spec.mart_columns()) == rows(mart, spec.mart_columns())
    assert rows(gold.fact(), spec.FACT_COLUMNS) == rows(fact, spec.FACT_COLUMNS)
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1, lambda: 1 / 0)
