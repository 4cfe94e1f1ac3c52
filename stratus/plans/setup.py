"""One-time load of the reference data: station list and postal areas -> raw tables -> dimensions.

Raw tables are appended to (a repeated load adds a version of every row, the newest counts); dimensions are rebuilt in
fresh folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratus.functions.geometry import geom_from_wkt
from stratus.operators.incremental import write_fresh
from stratus.plans import models
from stratus.sources import landing
from stratus.sources.raw_tables import scan_raw


def set_up(spark: SparkSession, root: str, station_list: str, postal_topology: str, load_dts: str,
           prefix: str | None = None) -> dict[str, DataFrame]:
    """Load the files at ``station_list`` (text) and ``postal_topology`` (TopoJSON documents) into the raw tables under
    ``root`` with the load stamp ``load_dts``; the two dimensions of all that was loaded so far."""
    stations = landing.station_raw(landing.read_station_list(spark, station_list), load_dts)
    landing.append_raw(stations, f"{root}/station_raw", load_dts)
    areas = landing.read_postal_topojson(spark, postal_topology, prefix).drop("geometry")
    landing.append_raw(areas, f"{root}/postal_area_raw", load_dts)
    dims = {"dim_station": models.dim_station(models.stg_station(scan_raw(spark, root, "station_raw"))),
            "dim_postal_area": models.dim_postal_area(models.stg_postal_area(
                scan_raw(spark, root, "postal_area_raw").withColumn("geometry", geom_from_wkt("wkt"))))}
    return {name: spark.read.schema(df.schema).parquet(write_fresh(df, f"{root}/{name}")) for name, df in dims.items()}
