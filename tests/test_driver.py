"""Driver contract and DuckDB parity on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from stratus.plans import registry
from stratus.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
FAST = ["stg_weather_observed", "stg_weather_forecast_batches", "dim_station", "dim_postal_area", "nearest_link",
        "fact_forecast", "mart_forecast", "mart_observed", "check_suite_integrity", "timestamp_continuity",
        "latest_per_key", "agg_mode", "circular_mean", "explode_weather_response", "read_station_list",
        "stitch_topology_arcs", "hourly_feed", "replace_by_key", "append_versions"]


def test_every_warehouse_query_has_an_oracle():
    # the optional subpackage has queries that SQL cannot express; its own tests hold them
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "temperature_avg" in df.columns


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_parity(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    srows = sorted(tuple(str(_norm(r[c])) for c in sorted(cols)) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = {c: i for i, c in enumerate(ocols)}
    orows = sorted(tuple(str(_norm(r[idx[c]])) for c in sorted(cols)) for r in res.fetchall())
    assert srows == orows


def test_hourly_run_with_station_scope(spark, tmp_dir):
    from stratus.plans.pipeline import hourly_run
    from stratus.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF)
    # the stations that report: of all, none in scope is nearest to an area here
    stations = wh.station_raw().join(wh.raw_weather("observed"), "wmo_station_id", "left_semi")
    res = hourly_run(spark, tmp_dir + "/wh", 0, wh.raw_weather("observed"), wh.raw_weather("forecast"),
                     stations, wh.postal_raw(), wh.as_of, station_pattern="customer#00000001%")
    ids = {r.wmo_station_id for r in res.tables["stg_observed"].select("wmo_station_id").distinct().collect()}
    assert ids and all(i.startswith("0001") for i in ids)
    assert res.tables["mart_forecast"].count() > 0


def test_facts_of_a_run_follow_its_batch(spark, tmp_dir):
    from stratus.operators.incremental import KeyedLog
    from stratus.plans.pipeline import HOUR_KEYS, hourly_run
    from stratus.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF)
    obs, fc, root = wh.raw_weather("observed"), wh.raw_weather("forecast"), tmp_dir + "/wh"
    early = "load_dts < timestamp_ntz'2024-01-25 00:00:00'"
    res = hourly_run(spark, root, 0, obs.where(early), fc.where(early), wh.station_raw(), wh.postal_raw(), wh.as_of)
    assert res.tables["quality_failures"].where("suite = 'integrity'").count() > 0
    res = hourly_run(spark, root, 1, obs.limit(0), fc.limit(0), wh.station_raw(), wh.postal_raw(), wh.as_of, previous=res)
    last = hourly_run(spark, root, 2, obs.where(f"NOT {early}"), fc.where(f"NOT {early}"), wh.station_raw(),
                      wh.postal_raw(), wh.as_of, previous=res)
    staged, facts = (KeyedLog(spark, f"{root}/{t}_weather_observed", HOUR_KEYS).log() for t in ("stg", "fact"))
    runs = {r._run for r in facts.select("_run").distinct().collect()}
    assert runs == {0, 2}  # an empty run appends nothing
    assert staged.where("_run = 2").join(facts.where("_run = 2"), HOUR_KEYS, "left_semi").count() == \
        facts.where("_run = 2").select(*HOUR_KEYS).distinct().count()
    assert last.tables["fact_observed"].count() == wh.fact("observed").count()


def test_hourly_ingest_accounts_for_every_row(spark, tmp_dir):
    from stratus.plans.pipeline import hourly_ingest
    from stratus.plans.warehouse import Warehouse
    from stratus.sources import landing_fixtures as LF
    wh = Warehouse(spark, SF)
    docs = spark.read.text(LF.write_weather_responses(wh.table("events"), tmp_dir + "/responses", faults=True))
    res = hourly_ingest(spark, tmp_dir + "/wh", 0, docs, docs.limit(0), wh.station_raw(), wh.postal_raw(), wh.as_of,
                        "2024-02-01 06:01:00", checks=False)
    counts, aside = res.counts["observed"], res.tables["set_aside_observed"]
    assert counts["ok"] and {r.reason: r["count"] for r in aside.groupBy("reason").count().collect()} == {
        k: n for k, n in counts.items() if k not in ("ok", "rows_in") and n}
    assert all(counts[k] for k in ("bad_number", "bad_timestamp", "unknown_source", "no_data", "bad_document"))
    assert counts["rows_in"] == counts["ok"] + aside.count() and res.counts["forecast"]["rows_in"] == 0
    staged = res.tables["stg_observed"]
    assert 0 < staged.count() <= counts["ok"] and staged.where("temperature IS NOT NULL").count()
    assert res.tables["mart_observed"].count() and res.tables["mart_forecast"].count() == 0
