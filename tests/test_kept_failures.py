"""Failures kept run by run equal a scan of the whole tables after each run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_gold import BRIDGES, RAW, T0, bridge_of, raw_rows

from stratus.operators import quality as Q
from stratus.operators.incremental import KeyedLog
from stratus.plans import models
from stratus.plans.gold import Gold
from stratus.session import materialize


def scanned(df, table):
    k1, k2 = Q.KEY_COLUMNS[table]
    found = [(s, n, str(r[k1]), str(r[k2])) for s, n, pred in Q.row_checks(table) for r in df.filter(pred).collect()]
    return sorted(found)


def held(kept, table):
    k1, k2 = Q.KEY_COLUMNS[table]
    now = kept.failures()
    return [] if now is None else sorted((r.suite, r.check_name, str(r[k1]), str(r[k2])) for r in now.collect())


@pytest.mark.parametrize("kind", ["observed", "forecast"])
def test_kept_failures_equal_a_full_scan(spark, tmp_dir, kind):
    rng = random.Random(11)
    gold, seen = Gold(spark, tmp_dir, kind), 0
    for run, served in enumerate(BRIDGES):
        rows = [] if run == 3 else raw_rows(rng, 100, T0 + dt.timedelta(days=run))
        for _ in range(2 if run == 2 else 1):  # a retried run
            batch = models.stg_weather(spark.createDataFrame(rows, RAW), kind).withColumn(
                "confidence_score", F.when(F.hash("wmo_station_id", "timestamp_utc", F.lit(run)) % 5 == 0, 2.0).otherwise(F.col("confidence_score")))
            batch = materialize(batch.withColumn("batch_id", F.lit(run).cast("long")) if kind == "forecast" else batch, "batch")
            gold.advance(batch, run, bridge_of(spark, served))
            for kept in gold.kept_failures().values():
                kept.follow(run)
        if run not in (2, 4):  # a retried one, and after rows and areas left
            continue
        now = {f"stg_{kind}": gold.staged(), f"fact_{kind}": gold.fact(), f"mart_{kind}": gold.mart()}
        for table, kept in gold.kept_failures().items():
            assert held(kept, table) == scanned(now[table], table), (run, table)
            seen += len(held(kept, table))
    assert seen > 20


def test_null_keys_and_logs_by_load(spark, tmp_dir):
    log = KeyedLog(spark, f"{tmp_dir}/t", ["wmo_station_id", "timestamp_utc"], ("event_date",), newest="run")
    kept = Q.KeptFailures(log, f"{tmp_dir}/f", [("s", "bad", F.col("x") > 1)])
    kept.follow(0)
    assert kept.failures() is None  # no table yet
    schema = "wmo_station_id string, timestamp_utc timestamp_ntz, x int"
    log.append(spark.createDataFrame([(None, None, 2), ("a", T0, 2), ("a", None, 5), ("b", T0, 1)], schema), 0)
    kept.follow(0)
    assert kept.failures().count() == 3
    log.append(spark.createDataFrame([(None, None, 1), ("a", T0, 0)], schema), 1)
    kept.follow(1)
    assert [(r.wmo_station_id, r.timestamp_utc) for r in kept.failures().collect()] == [("a", None)]
    recorded = kept.log.log().count()
    log.append(spark.createDataFrame([("b", T0, 1), ("c", T0, 1)], schema), 2)
    kept.follow(2)
    assert kept.log.log().count() == recorded  # rows that pass and never failed leave no record
    with pytest.raises(ValueError, match="load"):
        Q.KeptFailures(KeyedLog(spark, tmp_dir, ["wmo_station_id"]), tmp_dir, [])


def test_failures_of_an_hourly_run(spark, tmp_dir):
    from stratus.plans.pipeline import failures_now, hourly_run
    from stratus.plans.warehouse import Warehouse
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    raw = {kind: wh.raw_weather(kind).filter("day(timestamp_utc) < 4").withColumn("load_dts", F.expr(
        "CASE WHEN hour(timestamp_utc) = 5 THEN NULL ELSE load_dts END")) for kind in ("observed", "forecast")}
    root = tmp_dir + "/wh"
    res = hourly_run(spark, root, 0, raw["observed"], raw["forecast"], wh.station_raw(), wh.postal_raw(), wh.as_of,
                     checks=False, keep_failures=True)
    whole = Q.all_failures(res.tables, wh.as_of).filter("suite <> 'integrity' AND suite NOT LIKE 'declared%raw'")
    whole = whole.filter("suite NOT LIKE 'declared_raw%'")
    got = sorted(map(str, failures_now(spark, root, res.tables).collect()))
    assert got and got == sorted(map(str, whole.collect()))
