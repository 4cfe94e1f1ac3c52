import json

from pyspark.sql import functions as F

from stratus.operators import clean as C
from stratus.plans import models


def _raw(spark, docs, load="2024-01-01 00:00:00"):
    rows = [("00001", "2024-01-01 10:00:00", d if isinstance(d, str) else json.dumps(d), "{}", "t", load) for d in docs]
    df = spark.createDataFrame(rows, "wmo_station_id string, timestamp_utc string, raw string, "
                                     "bright_sky_source_mapping string, record_source string, load_dts string")
    return df.withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz")).withColumn(
        "load_dts", F.col("load_dts").cast("timestamp_ntz"))


def test_presence_filter_drops_missing_and_json_null(spark):
    raw = _raw(spark, [{"temperature": 1.0}, {"temperature": None}, {"precipitation": 2.0}, {"temperature": 0}])
    assert C.json_field_present(raw).count() == 2


def test_bounds_inclusive_and_null_not_flagged(spark):
    docs = [{"temperature": -50, "precipitation": 200, "wind_speed": 0},      # all on the bounds: valid
            {"temperature": 50.0000001, "precipitation": 1, "wind_speed": 1},  # just above
            {"temperature": 10, "precipitation": None, "wind_speed": 1}]       # NULL: not an outlier
    out = C.standardize(_raw(spark, docs)).orderBy(F.col("temperature").asc_nulls_last()).collect()
    by_flag = {r.outlier_flag: r for r in out}
    assert set(by_flag) == {None, "extreme_temp"}
    assert by_flag["extreme_temp"].temperature is None and by_flag["extreme_temp"].confidence_score == 0.3
    vals = sorted((r.temperature, r.confidence_score) for r in out if r.temperature is not None)
    assert vals == [(-50.0, 1.0), (10.0, 0.5)]


def test_flag_is_first_measure_in_spec_order(spark):
    docs = [{"temperature": 10, "precipitation": 1, "wind_speed": 1, "pressure_msl": 700, "solar": 5}]
    r = C.standardize(_raw(spark, docs)).first()
    assert r.outlier_flag == "extreme_pressure" and r.pressure_msl is None and r.solar is None
    assert r.confidence_score == 1.0  # only temperature/precipitation/wind speed decide the score


def test_numeric_text_and_bad_text(spark):
    docs = ['{"temperature": "15.5", "precipitation": "abc", "wind_speed": 1, "condition": "rain", "icon": "x"}']
    raw = _raw(spark, docs)
    r = C.standardize(raw).first()
    assert r.temperature == 15.5 and r.precipitation is None and r.weather_condition == "rain"
    q = C.quarantine_unparseable(raw).first()
    assert q.bad_keys == ["precipitation"]


def test_stg_weather_dedups_after_presence_filter(spark):
    # the newer load has no temperature: the older one survives (filter runs before dedup)
    a = _raw(spark, [{"temperature": 1.0}], "2024-01-01 00:00:00")
    b = _raw(spark, [{"precipitation": 1.0}], "2024-01-02 00:00:00")
    c = _raw(spark, [{"temperature": 3.0}], "2024-01-01 12:00:00")
    out = models.stg_weather(a.unionByName(b).unionByName(c)).collect()
    assert len(out) == 1 and out[0].temperature == 3.0
