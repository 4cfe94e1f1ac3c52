import math

import pytest
from pyspark.sql import functions as F

from stratus.functions.circular import circular_mean
from stratus.plans import models


def test_circular_mean(spark):
    df = spark.createDataFrame([(1, 350.0), (1, 10.0), (2, 90.0), (3, 360.0), (4, None), (5, 270.0), (5, 180.0)],
                               "g int, d double")
    got = {r.g: r.m for r in df.groupBy("g").agg(circular_mean("d").alias("m")).collect()}
    assert got[1] == pytest.approx(0.0, abs=1e-9) or got[1] == pytest.approx(360.0, abs=1e-9)
    assert got[2] == pytest.approx(90.0)
    assert 359.0 < got[3] <= 360.0  # 360 maps to 360 - epsilon (sin is -2.4e-16)
    assert got[4] is None
    assert got[5] == pytest.approx(225.0)


def test_mode_ties_smallest_and_std_single_row_null(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 4.0), ("c", None)], "c string, v double")
    r = df.agg(F.mode("c", deterministic=True).alias("m"), F.stddev_samp("v").alias("s")).first()
    assert r.m == "a" and r.s == pytest.approx(math.sqrt(5 / 3))
    one = spark.createDataFrame([("x", 1.0)], "c string, v double").agg(F.stddev_samp("v").alias("s")).first()
    assert one.s is None


def test_mart_outlier_rules_and_completeness(spark):
    cols = ["temperature", "outlier_flag", "weather_condition", "weather_icon", "confidence_score", "load_dts"]
    fact = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", 5.0, "extreme_solar", "rain", "r", 1.0, "2024-01-01 11:00:00"),
         (1, "2024-01-01 10:00:00", 7.0, None, "sun", "s", 0.5, "2024-01-01 12:00:00"),
         (1, "2024-01-01 10:00:00", None, None, "sun", "s", 0.3, "2024-01-01 13:00:00")],
        "postal_area_id long, timestamp_utc string, " + ", ".join(
            f"{c} {'double' if c in ('temperature', 'confidence_score') else 'string'}" for c in cols))
    fact = fact.withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz")).withColumn(
        "load_dts", F.col("load_dts").cast("timestamp_ntz"))
    from stratus.functions.spec import MEASURE_NAMES
    for m in MEASURE_NAMES:
        if m not in fact.columns:
            fact = fact.withColumn(m, F.lit(None).cast("double"))
    area = spark.createDataFrame([(1, "10115")], "id long, plz string")
    faithful = models.mart_weather(fact, area).first()
    anyrule = models.mart_weather(fact, area, outlier_rule="any").first()
    assert faithful.station_count == 2 and faithful.outlier_count == 0 and anyrule.outlier_count == 1
    assert faithful.data_completeness == 1.0 and faithful.temperature_avg == 6.0
    assert faithful.weather_condition_mode == "rain"  # tie rain/sun -> smallest
    assert str(faithful.load_dts) == "2024-01-01 12:00:00"
    assert faithful.record_source == "aggregated_matview"
