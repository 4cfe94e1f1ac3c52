import datetime as dt

from pyspark.sql import functions as F

from stratus.operators.incremental import (KeyedLog, append_versions, evolve_schema, incremental_filter, replace_by_key,
                                           write_fresh)


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, h int, v double, load_dts timestamp_ntz")


T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_replace_by_key_group_and_idempotent(spark):
    target = _df(spark, [("a", 1, 1.0, T0), ("a", 1, 2.0, T0), ("b", 1, 3.0, T0)])
    batch = _df(spark, [("a", 1, 9.0, T1)])
    once = replace_by_key(target, batch, ["k", "h"])
    twice = replace_by_key(once, batch, ["k", "h"])
    want = [("a", 1, 9.0), ("b", 1, 3.0)]
    for r in (once, twice):
        assert sorted((x.k, x.h, x.v) for x in r.collect()) == want


def test_append_versions_keeps_other_batches(spark):
    t = _df(spark, [("a", 1, 1.0, T0)]).withColumn("batch_id", F.lit(1))
    b = _df(spark, [("a", 1, 2.0, T1)]).withColumn("batch_id", F.lit(2))
    assert append_versions(t, b, ["k", "h"]).count() == 2


def test_incremental_filter_empty_target_takes_all(spark):
    raw = _df(spark, [("a", 1, 1.0, T0), ("a", 1, 2.0, T1)])
    assert incremental_filter(raw, raw.filter(F.lit(False))).count() == 2
    assert incremental_filter(raw, raw.filter(F.col("v") == 1.0)).count() == 1


def test_fresh_folders_and_schema_evolution(spark, tmp_dir):
    first = write_fresh(_df(spark, [("a", 1, 1.0, T0)]), tmp_dir + "/tbl")
    batch = _df(spark, [("a", 1, 2.0, T1)]).withColumn("extra", F.lit("x"))
    second = write_fresh(replace_by_key(spark.read.parquet(first), batch, ["k", "h"]), tmp_dir + "/tbl")
    assert first != second and spark.read.parquet(first).count() == 1
    now = spark.read.parquet(second)
    assert [(r.v, r.extra) for r in now.collect()] == [(2.0, "x")]
    old = _df(spark, [("b", 1, 1.0, T0)])
    assert evolve_schema(old, now.schema).columns[-1] == "extra"


def test_keyed_log_retry_and_group_replace(spark, tmp_dir):
    from stratus.operators.incremental import KeyedLog
    log = KeyedLog(spark, tmp_dir + "/log", ["k", "h"])
    assert log.current() is None
    first = _df(spark, [("a", 1, 1.0, T0), ("a", 1, 2.0, T0), ("b", 1, 3.0, T0)])  # group of two rows for (a, 1)
    log.append(first, 0)
    log.append(first, 0)  # a retried run: replaces its earlier attempt, no duplicates
    assert sorted((r.k, r.v) for r in log.current().collect()) == [("a", 1.0), ("a", 2.0), ("b", 3.0)]
    log.append(_df(spark, [("a", 1, 9.0, T1)]), 1)  # a newer load replaces the whole group
    assert sorted((r.k, r.v) for r in log.current().collect()) == [("a", 9.0), ("b", 3.0)]
    log.append(_df(spark, [("b", 1, 0.5, T0 - dt.timedelta(days=1))]), 2)  # an older load never wins
    assert sorted((r.k, r.v) for r in log.current().collect()) == [("a", 9.0), ("b", 3.0)]


def test_log_empty_first_run_and_latest_attempt(spark, tmp_dir):
    log = KeyedLog(spark, tmp_dir + "/log2", ["k", "h"])
    log.append(_df(spark, [("a", 1, 1.0, T0)]).limit(0), 0)
    assert log.log() is None and log.current() is None
    for value in (1.0, 5.0, 3.0):  # attempts of one run: the last one wins
        log.append(_df(spark, [("a", 1, value, T0)]), 1)
    assert [r[2] for r in log.current().select("k", "h", "v").collect()] == [3.0]


def test_surrogate_key_many_partitions(spark):
    from stratus.operators.keys import surrogate_key
    n = 1_000_000
    keys = spark.range(n).selectExpr("format_string('%012d', (id * 7919) % 1000000) AS k")
    got = surrogate_key(keys, "k", num_partitions=200)
    assert got.selectExpr("sum(CASE WHEN id = cast(k AS long) + 1 THEN 0 ELSE 1 END)", "count(*)").first() == (0, n)
