"""The four raw (bronze) tables: explicit schemas, scans, and the materialisations of the model layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratus.functions.geometry import MULTIPOLYGON

_NTZ = T.TimestampNTZType()

# Column names and types of the raw layer.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "weather_hourly_observed_raw": T.StructType([
        T.StructField("wmo_station_id", T.StringType()), T.StructField("timestamp_utc", _NTZ),
        T.StructField("raw", T.StringType()), T.StructField("bright_sky_source_mapping", T.StringType()),
        T.StructField("record_source", T.StringType()), T.StructField("load_dts", _NTZ)]),
    "weather_hourly_forecast_raw": T.StructType([
        T.StructField("wmo_station_id", T.StringType()), T.StructField("timestamp_utc", _NTZ),
        T.StructField("raw", T.StringType()), T.StructField("bright_sky_source_mapping", T.StringType()),
        T.StructField("record_source", T.StringType()), T.StructField("load_dts", _NTZ)]),
    "station_raw": T.StructType([
        T.StructField("wmo_station_id", T.StringType()), T.StructField("station_name", T.StringType()),
        T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
        T.StructField("properties", T.StringType()), T.StructField("record_source", T.StringType()),
        T.StructField("load_dts", _NTZ)]),
    "postal_area_raw": T.StructType([
        T.StructField("plz", T.StringType()), T.StructField("wkt", T.StringType()),
        T.StructField("geometry", MULTIPOLYGON), T.StructField("record_source", T.StringType()),
        T.StructField("load_dts", _NTZ)]),
}


def scan_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read a raw table with its declared schema (no inference; extra partition columns such as
    ``load_date`` are discovered from the folder layout)."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{root}/{name}")


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A view model: recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
