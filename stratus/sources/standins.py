"""Stand-in raw tables derived from the driver's tables (mapping documented in FIXTURES.md part B).

* weather raw (observed / forecast) <- ``events``: one document per event, ``k`` from ``props``;
* station raw <- every ``customer`` (two loads: a full one
  and a later re-load of one market segment with a changed name, so latest-per-key has work to do);
* postal-area raw <- ``supplier``: a square per supplier.

Coordinates are planar, in integer hundredths of a degree, so every distance comparison is exact.
All columns are deterministic functions of the input rows, so the derived tables grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.timeutil import hour_floor, ntz

# ---------------------------------------------------------------------------------------------------
# Fixed values of the stand-in mapping (FIXTURES.md part B).
# ---------------------------------------------------------------------------------------------------
RECORD_SOURCE_WEATHER = "events"
RECORD_SOURCE_STATION = "customer"
RECORD_SOURCE_POSTAL = "supplier"
FORECAST_BASE = "2024-02-01 00:00:00"
STATION_LOAD_1 = "2023-12-31 00:00:00"
STATION_LOAD_2 = "2024-01-01 00:00:00"
STATION_RELOAD_SEGMENT = "BUILDING"
POSTAL_LOAD = "2024-01-01 00:00:00"
AREA_HALF_SIDE = 40  # hundredths of a degree


def k_of(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def measure_exprs(k: Column, value: Column) -> dict[str, Column]:
    """The 15 measures and 2 text fields of a stand-in document."""
    kd = k.cast("double")
    null = F.lit(None).cast("double")
    return {
        "temperature": F.when(k % 25 == 0, null).otherwise(value - F.lit(60.0)),
        "precipitation": F.when(k % 10 == 3, null).otherwise(kd * F.lit(2.5)),
        "wind_speed": kd * F.lit(1.25),
        "wind_direction": kd * F.lit(3.7) + F.lit(1.3),
        "pressure_msl": F.lit(790.0) + kd * F.lit(3.5),
        "relative_humidity": kd * F.lit(1.1),
        "cloud_cover": kd * F.lit(1.02),
        "visibility": kd * F.lit(1025.0),
        "dew_point": value - F.lit(55.0),
        "solar": kd / F.lit(90.0),
        "sunshine": kd * F.lit(0.625),
        "wind_gust_speed": kd * F.lit(1.6),
        "wind_gust_direction": kd * F.lit(3.8) + F.lit(0.9),
        "precipitation_probability": kd * F.lit(1.05),
        "precipitation_probability_6h": kd * F.lit(1.03),
    }


def wmo_id(key: Column) -> Column:
    return F.lpad(key.cast("string"), 5, "0")


def weather_raw_from_events(events: DataFrame, kind: str = "observed") -> DataFrame:
    """Raw weather rows: wmo_station_id, timestamp_utc, raw (JSON text), bright_sky_source_mapping,
    record_source, load_dts (+ batch_id = load date for forecasts)."""
    k = k_of()
    ev = events.select("user_id", "ts", "event_type", "value", k.alias("k"))
    m = measure_exprs(F.col("k"), F.col("value"))
    doc = F.struct(*[c.alias(n) for n, c in m.items()],
                   F.col("event_type").alias("condition"),
                   F.concat(F.col("event_type"), F.lit("-"), (F.col("k") % 3).cast("string")).alias("icon"))
    sid = wmo_id(F.col("user_id"))
    if kind == "observed":
        ts = hour_floor("ts")
    elif kind == "forecast":
        ts = F.timestamp_add("HOUR", F.col("k") % 24, ntz(FORECAST_BASE))
    else:
        raise ValueError(kind)
    cols = [
        sid.alias("wmo_station_id"),
        ts.alias("timestamp_utc"),
        F.to_json(doc, {"ignoreNullFields": "false"}).alias("raw"),
        F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.lit(',"wmo_station_id":"'), sid,
                 F.lit('"}')).alias("bright_sky_source_mapping"),
        F.lit(RECORD_SOURCE_WEATHER).alias("record_source"),
        F.col("ts").alias("load_dts"),
    ]
    if kind == "forecast":
        cols.append(F.to_date("ts").alias("batch_id"))
    return ev.select(*cols)


def station_coords(key: Column) -> tuple[Column, Column]:
    lon = (F.lit(600) + (key * 53) % 900).cast("double")
    lat = (F.lit(4700) + (key * 37) % 800).cast("double")
    return lat, lon


def station_raw_from_customers(customer: DataFrame, moved: Column | None = None, moved_by: int = 0) -> DataFrame:
    """station_raw: wmo_station_id, station_name, lat, lon, properties, record_source, load_dts. Where ``moved`` holds the
    longitude is that of a place ``moved_by`` further on (around the range)."""
    lat, lon = station_coords(F.col("c_custkey"))
    if moved is not None:
        lon = F.when(moved, (F.lit(600) + (F.col("c_custkey") * 53 + moved_by) % 900).cast("double")).otherwise(lon)
    props = F.concat(F.lit('{"c_custkey":'), F.col("c_custkey").cast("string"), F.lit(',"segment":"'),
                     F.col("c_mktsegment"), F.lit('"}'))

    def load(df: DataFrame, name: Column, at: str) -> DataFrame:
        return df.select(wmo_id(F.col("c_custkey")).alias("wmo_station_id"), name.alias("station_name"),
                         lat.alias("lat"), lon.alias("lon"), props.alias("properties"),
                         F.lit(RECORD_SOURCE_STATION).alias("record_source"), ntz(at).alias("load_dts"))

    first = load(customer, F.col("c_name"), STATION_LOAD_1)
    reload = load(customer.filter(F.col("c_mktsegment") == STATION_RELOAD_SEGMENT),
                  F.concat(F.col("c_name"), F.lit(" (reloaded)")), STATION_LOAD_2)
    return first.unionByName(reload)


def square_wkt(cx: Column, cy: Column, h: int) -> Column:
    x0, x1 = (cx - h).cast("string"), (cx + h).cast("string")
    y0, y1 = (cy - h).cast("string"), (cy + h).cast("string")
    ring = F.concat_ws(", ", F.concat_ws(" ", x0, y0), F.concat_ws(" ", x1, y0), F.concat_ws(" ", x1, y1),
                       F.concat_ws(" ", x0, y1), F.concat_ws(" ", x0, y0))
    return F.concat(F.lit("MULTIPOLYGON((("), ring, F.lit(")))"))


def postal_raw_from_suppliers(supplier: DataFrame) -> DataFrame:
    """postal_area_raw: plz, wkt, record_source, load_dts (geometry is derived from wkt by the reader)."""
    s = F.col("s_suppkey")
    cx = F.lit(600) + (s * 71) % 900
    cy = F.lit(4700) + (s * 29) % 800
    return supplier.select((F.lit(10000) + s).cast("string").alias("plz"),
                           square_wkt(cx, cy, AREA_HALF_SIDE).alias("wkt"),
                           F.lit(RECORD_SOURCE_POSTAL).alias("record_source"),
                           ntz(POSTAL_LOAD).alias("load_dts"))
