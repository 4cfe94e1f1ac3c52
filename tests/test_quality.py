import datetime as dt
import random

from pyspark.sql import functions as F

from stratus.operators import quality as Q


def test_check_suite_tags_and_null_passes(spark):
    df = spark.createDataFrame([(1, -1.0), (2, None), (3, 400.0), (4, 5.0)], "id int, d double")
    out = Q.check_suite(df, [("neg", Q.negative("d")), ("dir", Q.outside("d", 0, 360))]).collect()
    assert sorted((r.check_name, r.id) for r in out) == [("dir", 1), ("dir", 3), ("neg", 1)]


def test_completeness_threshold_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (None,)], "v double")
    assert Q.check_completeness(df, "v", 0.8).count() == 1
    assert Q.check_completeness(df, "v", 0.3).count() == 0
    assert Q.check_completeness(df.filter(F.lit(False)), "v").count() == 0


def test_timestamp_continuity_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    ts = sorted(base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)) for _ in range(300))
    ts += ts[:20]  # duplicates change nothing
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    d = sorted(set(ts))
    want = {(b, a) for a, b in zip(d, d[1:]) if (b - a).total_seconds() > 1800}
    assert any(a.date() != b.date() for b, a in want)  # includes gaps across midnight
    for bucket in ("day", "hour"):
        got = {(r.ts, r.prev_timestamp) for r in Q.check_timestamp_continuity(df, "ts", 1800, bucket=bucket).collect()}
        assert got == want


def test_unique_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert [(r.k, r.n_records) for r in Q.check_unique(df, "k").collect()] == [(1, 2)]
    assert Q.check_no_duplicates(df, ["k", "v"]).count() == 0


def test_integrity_reads_each_table_once_and_equals_anti_joins(spark):
    from stratus.operators.joins import anti_check
    hour = dt.datetime(2024, 1, 20)
    old, far = hour - dt.timedelta(days=60), hour + dt.timedelta(days=60)
    stg = "wmo_station_id string, timestamp_utc timestamp_ntz"
    obs = spark.createDataFrame([("1", hour), ("2", old), (None, hour), ("9", old), ("9", None)], stg)
    fc = spark.createDataFrame([("1", far), ("8", far), ("2", hour)], stg)
    st = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "wmo_station_id string")
    mart = spark.createDataFrame([("10001", hour, 1), ("10009", hour, 0), (None, hour, 500), ("10002", hour, None)],
                                 "plz string, timestamp_utc timestamp_ntz, station_count long")
    link = spark.createDataFrame([(1, 1), (2, 7), (5, 2), (None, None)], "postal_area_id long, station_id long")
    dim_st = spark.createDataFrame([(1,), (2,)], "id long")
    dim_ar = spark.createDataFrame([(1, "10001"), (2, "10002"), (2, "10002")], "id long, plz string")
    got = sorted(map(tuple, Q.integrity_suite(obs, fc, st, mart, link, dim_st, dim_ar, "2024-01-21 00:00:00").collect()), key=str)
    want = []
    for name, child, parent, key, pk, other in (
            ("weather_observed_invalid_station_ids", obs, st, "wmo_station_id", "wmo_station_id", "timestamp_utc"),
            ("weather_forecast_invalid_station_ids", fc, st, "wmo_station_id", "wmo_station_id", "timestamp_utc"),
            ("aggregated_invalid_postal_codes", mart, dim_ar, "plz", "plz", "timestamp_utc"),
            ("link_table_invalid_postal_area_ids", link, dim_ar, "postal_area_id", "id", "station_id"),
            ("link_table_invalid_station_ids", link, dim_st, "station_id", "id", "postal_area_id")):
        want += [(name, *r) for r in anti_check(child, parent, key, pk).select(F.col(key).cast("string"), F.col(other).cast("string")).collect()]
    for name, df, k1, k2 in (("observed_timestamps_too_old", obs.filter("timestamp_utc < timestamp_ntz'2023-12-22 00:00:00'"), "wmo_station_id", "timestamp_utc"),
                             ("forecast_timestamps_too_far_future", fc.filter("timestamp_utc > timestamp_ntz'2024-01-28 00:00:00'"), "wmo_station_id", "timestamp_utc"),
                             ("aggregated_unreasonable_station_counts", mart.filter("station_count < 1 OR station_count > 100"), "plz", "timestamp_utc")):
        want += [(name, *r) for r in df.select(F.col(k1).cast("string"), F.col(k2).cast("string")).collect()]
    assert got == sorted(want, key=str) and len({r[0] for r in got}) == 8


def test_integrity_plan_has_one_scan_a_table(spark, tmp_dir):
    frames = {"obs": "wmo_station_id string, timestamp_utc timestamp_ntz", "fc": "wmo_station_id string, timestamp_utc timestamp_ntz",
              "mart": "plz string, timestamp_utc timestamp_ntz, station_count long", "link": "postal_area_id long, station_id long",
              "st": "wmo_station_id string", "dim_st": "id long", "dim_ar": "id long, plz string"}
    t = {}
    for name, schema in frames.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_dir}/{name}")
        t[name] = spark.read.schema(schema).parquet(f"{tmp_dir}/{name}")
    plan = Q.integrity_suite(t["obs"], t["fc"], t["st"], t["mart"], t["link"], t["dim_st"], t["dim_ar"],
                             "2024-01-21 00:00:00")._jdf.queryExecution().executedPlan().toString()
    for name in ("obs", "fc", "mart", "link"):
        assert plan.count(f"{tmp_dir}/{name}]") == 1


def test_continuity_of_one_dense_day_is_spread_over_ranges(spark):
    rng = random.Random(9)
    day, at = dt.datetime(2024, 3, 1), 0
    stamps = []
    for _ in range(20_000):
        at += rng.choice([1, 2, 3, 3, 900])
        stamps.append(day + dt.timedelta(milliseconds=at))
    assert stamps[-1] < day + dt.timedelta(days=1)
    df = spark.createDataFrame([(t,) for t in stamps + stamps[:500]] + [(None,)], "ts timestamp_ntz").repartition(3)
    got = {(r.ts, r.prev_timestamp) for r in Q.check_timestamp_continuity(df, "ts", 0.5).collect()}
    assert got == {(b, a) for a, b in zip(stamps, stamps[1:]) if b - a > dt.timedelta(seconds=0.5)} and len(got) > 3000
    sizes = [r["count"] for r in df.distinct().repartitionByRange(16, "ts").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4 * 20_000 / 16  # what the check does: ranges of one size
    assert Q.check_timestamp_continuity(df.limit(0), "ts", 0.5).count() == 0


def test_kept_counts_equal_a_full_scan_after_each_run(spark, tmp_dir):
    rng = random.Random(4)
    day = dt.datetime(2024, 3, 1)
    schema = "station string, timestamp_utc timestamp_ntz, v double"
    kept, totals, seen = Q.KeptCounts(spark, tmp_dir + "/c", ["station", "timestamp_utc"]), Q.KeptCounts(spark, tmp_dir + "/t", (), ["v"]), []
    assert kept.duplicates() is None
    for run in range(3):
        rows = [(rng.choice(["a", "b", None]), rng.choice([None, *(day + dt.timedelta(hours=h) for h in range(20, 30))]), rng.choice([None, 1.0])) for _ in range(25)]
        for _ in range(2):  # retried
            kept.add(spark.createDataFrame(rows, schema), run)
            totals.add(spark.createDataFrame(rows, schema), run)
        seen += rows
        full = spark.createDataFrame(seen, schema)
        want = sorted(map(tuple, Q.check_no_duplicates(full, ["station", "timestamp_utc"]).collect()), key=str)
        assert sorted(map(tuple, kept.duplicates().collect()), key=str) == want and want
        assert totals.incomplete("v", 0.99).collect() == Q.check_completeness(full, "v", 0.99).collect()
