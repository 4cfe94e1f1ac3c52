"""Rows that repeat a station's measures for many areas pack well, so their tasks are sized by rows, not by packed bytes."""

from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.operators import incremental
from stratus.operators import mart_state as S
from stratus.operators.incremental import KeyedLog

STATIONS, HOURS, ROWS = 20, 20, 20


def _most(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def _staged(spark):
    n = STATIONS * HOURS
    rows = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id") % STATIONS).alias("wmo_station_id"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / STATIONS).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("timestamp_utc"),
        *(F.lit(float(i)).alias(m.name) for i, m in enumerate(spec.MEASURES)), F.lit(None).cast("string").alias("outlier_flag"),
        F.lit(1.0).alias("confidence_score"), F.lit("2024-01-02").cast("timestamp_ntz").alias("load_dts"),
        *(F.lit("dry").alias(c) for c in S.TEXTS))
    return rows.localCheckpoint()


def test_states_are_made_by_tasks_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(incremental, "ROWS_A_TASK", ROWS, raising=False)
    staged = _staged(spark)
    zones = staged.select("wmo_station_id", F.col("wmo_station_id").alias("plz")).distinct()
    groups = staged.select(F.col("wmo_station_id").alias("plz"), "timestamp_utc")
    joins = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in joins:
        spark.conf.set(name, "-1")  # as with states too large for it
    try:
        found = S.area_states(staged, zones, None, groups)
        assert found.count() == STATIONS * HOURS
        assert _most(found) <= 3 * ROWS
    finally:
        for name in joins:
            spark.conf.unset(name)


def test_a_bounded_view_deals_its_rows(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(incremental, "ROWS_A_TASK", ROWS)
    log = KeyedLog(spark, f"{tmp_dir}/log", ["wmo_station_id", "timestamp_utc"], ("event_date",), newest="run")
    staged = _staged(spark)
    log.append(staged, 0)
    log.append(staged.limit(100).withColumn("temperature", F.lit(-1.0)), 1)
    bounded = log.current(bounded=True)
    assert _most(bounded) <= 3 * ROWS
    assert bounded.count() == STATIONS * HOURS and bounded.filter("temperature = -1").count() == 100
    assert bounded.exceptAll(log.current().select(*bounded.columns)).isEmpty()
