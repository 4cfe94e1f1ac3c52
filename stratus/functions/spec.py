"""The measure specification that drives cleaning, flagging, checks and marts.

One table instead of fifteen hand-written CASE blocks: every operator that needs a bound, a flag code
or an aggregate list reads it from here.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Measure:
    name: str          # JSON key in the raw document == staged column name
    lo: float          # inclusive lower valid bound
    hi: float          # inclusive upper valid bound
    flag: str          # outlier_flag code when out of range
    aggs: tuple        # mart aggregates, in output order
    circular: bool = False


# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results): measure name, valid range,
# outlier flag code, and the mart statistics computed per measure, in the reference's order.
# ---------------------------------------------------------------------------------------------
MEASURES: tuple[Measure, ...] = (
    Measure("temperature", -50, 50, "extreme_temp", ("avg", "min", "max", "std")),
    Measure("precipitation", 0, 200, "extreme_precip", ("sum", "avg", "max", "std")),
    Measure("wind_speed", 0, 100, "extreme_wind", ("avg", "max", "std")),
    Measure("wind_direction", 0, 360, "extreme_wind_dir", ("circavg", "std"), circular=True),
    Measure("pressure_msl", 800, 1100, "extreme_pressure", ("avg", "min", "max", "std")),
    Measure("relative_humidity", 0, 100, "extreme_humidity", ("avg", "min", "max", "std")),
    Measure("cloud_cover", 0, 100, "extreme_cloud_cover", ("avg", "std")),
    Measure("visibility", 0, 100000, "extreme_visibility", ("avg", "min", "max", "std")),
    Measure("dew_point", -50, 50, "extreme_dew_point", ("avg", "std")),
    Measure("solar", 0, 1, "extreme_solar", ("avg", "max", "std")),
    Measure("sunshine", 0, 60, "extreme_sunshine", ("avg", "max", "std")),
    Measure("wind_gust_speed", 0, 150, "extreme_wind_gust", ("avg", "max", "std")),
    Measure("wind_gust_direction", 0, 360, "extreme_wind_gust_dir", ("circavg", "std"), circular=True),
    Measure("precipitation_probability", 0, 100, "extreme_precip_prob", ("avg", "std")),
    Measure("precipitation_probability_6h", 0, 100, "extreme_precip_prob_6h", ("avg", "std")),
)

# Text keys of the raw document and the staged column they land in (fixed values).
TEXT_FIELDS: tuple[tuple[str, str], ...] = (
    ("condition", "weather_condition"),
    ("icon", "weather_icon"),
)

# Measures that decide the confidence score (fixed values): out of range -> 0.3,
# else any of them missing -> 0.5, else 1.0.
CONFIDENCE_MEASURES = ("temperature", "precipitation", "wind_speed")
CONFIDENCE_OUTLIER, CONFIDENCE_MISSING, CONFIDENCE_OK = 0.3, 0.5, 1.0

# The field whose presence admits a raw row into staging, and the mart's row filter (fixed values).
REQUIRED_FIELD = "temperature"
MART_REQUIRED_MEASURE = "temperature"
MART_RECORD_SOURCE = "aggregated_matview"
FAITHFUL_OUTLIER_CODE = "outlier"

MEASURE_NAMES = tuple(m.name for m in MEASURES)
BY_NAME = {m.name: m for m in MEASURES}

# Staged table column order (fixed value).
STAGED_COLUMNS = (
    ("wmo_station_id", "timestamp_utc") + MEASURE_NAMES
    + ("weather_condition", "weather_icon", "bright_sky_source_mapping", "record_source", "load_dts",
       "outlier_flag", "confidence_score")
)

# Fact column order: staging plus the two surrogate keys after the station id (fixed value).
FACT_COLUMNS = (
    ("wmo_station_id", "station_id", "postal_area_id", "timestamp_utc") + MEASURE_NAMES
    + ("weather_condition", "weather_icon", "bright_sky_source_mapping", "record_source", "load_dts",
       "outlier_flag", "confidence_score")
)


def mart_columns() -> list[str]:
    """Mart output columns in order: keys, the per-measure statistics, quality metrics, metadata."""
    cols = ["plz", "timestamp_utc"]
    for m in MEASURES:
        for a in m.aggs:
            cols.append(f"{m.name}_{'avg' if a == 'circavg' else a}")
    cols += ["station_count", "data_completeness", "outlier_count", "confidence_score_avg",
             "weather_condition_mode", "weather_icon_mode", "record_source", "load_dts"]
    return cols
