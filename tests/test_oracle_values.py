"""The measure table written out: what the engine and its oracles share is held against literals."""

from stratus.functions import spec

# measure: valid range, outlier code, mart statistics
WRITTEN_OUT = {
    "temperature": (-50, 50, "extreme_temp", "avg min max std"),
    "precipitation": (0, 200, "extreme_precip", "sum avg max std"),
    "wind_speed": (0, 100, "extreme_wind", "avg max std"),
    "wind_direction": (0, 360, "extreme_wind_dir", "circavg std"),
    "pressure_msl": (800, 1100, "extreme_pressure", "avg min max std"),
    "relative_humidity": (0, 100, "extreme_humidity", "avg min max std"),
    "cloud_cover": (0, 100, "extreme_cloud_cover", "avg std"),
    "visibility": (0, 100000, "extreme_visibility", "avg min max std"),
    "dew_point": (-50, 50, "extreme_dew_point", "avg std"),
    "solar": (0, 1, "extreme_solar", "avg max std"),
    "sunshine": (0, 60, "extreme_sunshine", "avg max std"),
    "wind_gust_speed": (0, 150, "extreme_wind_gust", "avg max std"),
    "wind_gust_direction": (0, 360, "extreme_wind_gust_dir", "circavg std"),
    "precipitation_probability": (0, 100, "extreme_precip_prob", "avg std"),
    "precipitation_probability_6h": (0, 100, "extreme_precip_prob_6h", "avg std"),
}


def test_measure_table():
    assert {m.name: (m.lo, m.hi, m.flag, " ".join(m.aggs)) for m in spec.MEASURES} == WRITTEN_OUT
    assert spec.CONFIDENCE_MEASURES == ("temperature", "precipitation", "wind_speed")
    assert (spec.CONFIDENCE_OUTLIER, spec.CONFIDENCE_MISSING, spec.CONFIDENCE_OK) == (0.3, 0.5, 1.0)
    assert len(spec.mart_columns()) == 2 + 52 and [m.name for m in spec.MEASURES if m.circular] == ["wind_direction", "wind_gust_direction"]


def test_each_bound_fires_alone(spark):
    import json

    from stratus.operators.clean import standardize
    rows = []
    for name, (lo, hi, flag, _) in WRITTEN_OUT.items():
        for value, wanted in ((lo, None), (hi, None), (lo - 0.01, flag), (hi + 0.01, flag)):
            doc = {"temperature": 1.0, "precipitation": 1.0, "wind_speed": 1.0, name: value}
            score = 0.3 if wanted and name in ("temperature", "precipitation", "wind_speed") else 1.0
            rows.append((f"{name} {value}", json.dumps(doc), "", "", None, wanted, score))
    df = spark.createDataFrame(rows, "wmo_station_id string, raw string, bright_sky_source_mapping string, record_source string, "
                                     "load_dts timestamp_ntz, wanted string, score double").selectExpr("*", "CAST(NULL AS timestamp_ntz) AS timestamp_utc")
    got = standardize(df, extra_cols=["wanted", "score"]).collect()
    assert len(got) == 60 and all((r.outlier_flag, r.confidence_score) == (r.wanted, r.score) for r in got)
