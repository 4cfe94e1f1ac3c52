"""The warehouse models as composed DataFrame functions (bronze -> silver -> gold).

Every function is pure (DataFrame in, DataFrame out); load stamps and "now" are parameters.
Shuffle boundaries: the (station, hour) dedup, the link search, and the (plz, hour) aggregation.
Dimension-sized inputs carry no hint: adaptive execution broadcasts them by their measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.functions.circular import circular_mean
from stratus.functions.geometry import make_point
from stratus.functions.timeutil import ntz
from stratus.operators.clean import standardize
from stratus.operators.dedup import by_group_size, desc_nulls_first, latest_per_key
from stratus.operators.joins import by_rows
from stratus.operators.keys import surrogate_key
from stratus.operators.link import nearest_link

DEFAULT_AS_OF = "2024-02-01 00:00:00"
TIE = "_h"  # hash of the raw document


# ------------------------------------------------------------------------------------------- staging
def stg_weather(raw: DataFrame, kind: str = "observed", *, batch_key: bool = False,
                since: DataFrame | None = None, keep_tie: bool = False) -> DataFrame:
    """Staged weather rows: newest load per (station, hour[, batch]) among rows whose document has a
    temperature, with cleaned measures, flag and confidence.

    The document is parsed once per row, before the shuffle, so the dedup exchange carries typed columns
    instead of JSON text. The presence filter is folded into the dedup order (rows with a temperature
    first, newest first; a winner without one is dropped), which equals filtering before the dedup and
    keeps Catalyst from re-parsing the document in a pushed-down filter. Equal load stamps are broken by
    a 64-bit hash of the document (the reference leaves that order undefined).

    ``batch_key``: keep one version per batch (``batch_id`` column) — forecast history semantics.
    ``since``: a target table; only raw rows loaded after its high-water mark are taken (incremental run).
    ``keep_tie``: keep the hash that broke ties (``TIE``), so a later merge of several batches breaks them alike.
    """
    df = raw
    if since is not None:
        from stratus.operators.incremental import incremental_filter
        df = incremental_filter(df, since)
    keys = ["wmo_station_id", "timestamp_utc"] + (["batch_id"] if batch_key else [])
    extra = ["batch_id"] if batch_key else []
    staged = standardize(df.withColumn(TIE, F.xxhash64("raw")), extra_cols=["_present", TIE] + extra)
    order = [F.col("_present").desc(), desc_nulls_first("load_dts"), F.col(TIE).asc()]
    out = latest_per_key(staged, keys, order).filter(F.col("_present")).drop("_present")
    return out if keep_tie else out.drop(TIE)


def stg_station(raw: DataFrame) -> DataFrame:
    df = raw.filter(F.col("wmo_station_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
                    & F.col("station_name").isNotNull())
    df = df.withColumn("geometry", make_point("lon", "lat"))
    df = latest_per_key(df, ["wmo_station_id"], [desc_nulls_first("load_dts"), F.col("station_name"),
                                                 F.col("properties")])
    return df.select("wmo_station_id", "station_name", "lat", "lon", "geometry", "properties", "record_source",
                     "load_dts")


def stg_postal_area(raw: DataFrame) -> DataFrame:
    df = raw.filter(F.col("plz").isNotNull() & F.col("geometry").isNotNull())
    df = latest_per_key(df, ["plz"], [desc_nulls_first("load_dts"), F.col("wkt")])
    return df.select("plz", "wkt", "geometry", "record_source", "load_dts")


# ------------------------------------------------------------------------------------------- dims
def dim_station(stg: DataFrame) -> DataFrame:
    return surrogate_key(stg, "wmo_station_id").select(
        "id", "wmo_station_id", "station_name", "lat", "lon", "geometry", "properties", "record_source", "load_dts")


def dim_postal_area(stg: DataFrame) -> DataFrame:
    return surrogate_key(stg, "plz").select("id", "plz", "wkt", "geometry", "record_source", "load_dts")


# ------------------------------------------------------------------------------------------- link
def link_postcode_station(dim_area: DataFrame, dim_st: DataFrame, *, as_of: str = DEFAULT_AS_OF, k: int = 1,
                          prune: bool = True, cell_size: float | None = None,
                          materialize_inputs: bool = True) -> DataFrame:
    """Nearest station per postal area; ``created_at`` is the run's ``as_of`` stamp."""
    areas = dim_area.filter(F.col("plz").isNotNull())
    st = dim_st.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    res = nearest_link(areas, st, k=k, prune=prune, cell_size=cell_size, materialize_inputs=materialize_inputs)
    cols = [F.col("postal_area_id").cast("long"), F.col("station_id").cast("long"), ntz(as_of).alias("created_at")]
    if k > 1:
        cols += [F.col("rank"), F.col("distance")]
    return res.select(*cols)


# ------------------------------------------------------------------------------------------- facts
def area_bridge(dim_st: DataFrame, link: DataFrame, dim_area: DataFrame) -> DataFrame:
    """(wmo_station_id, station_id, postal_area_id, plz): the three dimension joins done once, on
    dimension-sized data, so the fact side needs a single join."""
    st = dim_st.select(F.col("id").alias("station_id"), "wmo_station_id")
    ar = dim_area.select(F.col("id").alias("postal_area_id"), "plz")
    return (by_rows(st).join(by_rows(link.select("station_id", "postal_area_id")), "station_id")
            .join(by_rows(ar), "postal_area_id")
            .select("wmo_station_id", "station_id", "postal_area_id", "plz"))


def fact_weather(stg: DataFrame, dim_st: DataFrame, link: DataFrame, dim_area: DataFrame,
                 bridge: DataFrame | None = None) -> DataFrame:
    """Staged rows fanned out to every postal area their station serves (inner joins: unlinked rows drop)."""
    b = bridge if bridge is not None else area_bridge(dim_st, link, dim_area)
    return stg.join(b.drop("plz"), "wmo_station_id").select(*spec.FACT_COLUMNS)


# ------------------------------------------------------------------------------------------- marts
def mart_aggregates(outlier_rule: str = "faithful") -> list:
    aggs = []
    for m in spec.MEASURES:
        c = F.col(m.name)
        for a in m.aggs:
            if a == "avg":
                e = F.avg(c)
            elif a == "min":
                e = F.min(c)
            elif a == "max":
                e = F.max(c)
            elif a == "sum":
                e = F.sum(c)
            elif a == "std":
                e = F.stddev_samp(c)
            elif a == "circavg":
                e = circular_mean(c)
            else:
                raise ValueError(a)
            aggs.append(e.alias(f"{m.name}_{'avg' if a == 'circavg' else a}"))
    req = F.col(spec.MART_REQUIRED_MEASURE)
    if outlier_rule == "faithful":
        outlier = F.count_if(F.col("outlier_flag") == F.lit(spec.FAITHFUL_OUTLIER_CODE))
    elif outlier_rule == "any":
        outlier = F.count_if(F.col("outlier_flag").isNotNull())
    else:
        raise ValueError(outlier_rule)
    aggs += [
        F.count(F.lit(1)).alias("station_count"),
        (F.count(req).cast("double") / F.count(F.lit(1))).alias("data_completeness"),
        outlier.alias("outlier_count"),
        F.avg("confidence_score").alias("confidence_score_avg"),
        F.mode("weather_condition", deterministic=True).alias("weather_condition_mode"),
        F.mode("weather_icon", deterministic=True).alias("weather_icon_mode"),
        F.lit(spec.MART_RECORD_SOURCE).alias("record_source"),
        F.max("load_dts").alias("load_dts"),
    ]
    return aggs


def _lone_mart_rows(outlier_rule: str) -> list:
    """``mart_aggregates`` of a group's only row."""
    cols = []
    for m in spec.MEASURES:
        c = F.col(m.name)
        for a in m.aggs:
            if a in ("avg", "sum"):
                e = c + F.lit(0.0)  # they start from 0.0, which turns -0.0 to 0.0
            elif a == "std":
                e = F.lit(None).cast("double")
            elif a == "circavg":
                s, co = (f(F.radians(c)) + F.lit(0.0) for f in (F.sin, F.cos))
                theta = F.degrees(F.atan2(s, co))
                e = F.when(s >= 0, theta).otherwise(theta + F.lit(360.0))
            else:
                e = c
            cols.append(e.alias(f"{m.name}_{'avg' if a == 'circavg' else a}"))
    flag = F.col("outlier_flag")
    out = flag == F.lit(spec.FAITHFUL_OUTLIER_CODE) if outlier_rule == "faithful" else flag.isNotNull()
    return cols + [
        F.lit(1).cast("long").alias("station_count"),
        F.lit(1.0).alias("data_completeness"),  # rows without the required measure are filtered before
        F.when(out, 1).otherwise(0).cast("long").alias("outlier_count"),
        (F.col("confidence_score") + F.lit(0.0)).alias("confidence_score_avg"),
        F.col("weather_condition").alias("weather_condition_mode"),
        F.col("weather_icon").alias("weather_icon_mode"),
        F.lit(spec.MART_RECORD_SOURCE).alias("record_source"),
        F.col("load_dts"),
    ]


def mart_weather(fact: DataFrame, dim_area: DataFrame, *, outlier_rule: str = "faithful",
                 sort: bool = True) -> DataFrame:
    """Per (plz, hour) statistics of the fact rows with a temperature (``fact`` is best a written table: it is read several
    times). A row that is alone in its group is taken as it is, the others in one aggregation pass with map-side partial
    aggregates (mode's value counts combine partially too)."""
    aggregates = mart_aggregates(outlier_rule)
    ar = dim_area.select(F.col("id").alias("postal_area_id"), "plz")
    df = fact.join(ar, "postal_area_id").filter(F.col(spec.MART_REQUIRED_MEASURE).isNotNull())
    lone, several = by_group_size(df, ["plz", "timestamp_utc"])
    out = None if lone is None else lone.select("plz", "timestamp_utc", *_lone_mart_rows(outlier_rule))
    if several is not None:
        rest = several.groupBy("plz", "timestamp_utc").agg(*aggregates)
        out = rest if out is None else out.unionByName(rest)
    out = out.select(*spec.mart_columns())
    return out.orderBy("plz", "timestamp_utc") if sort else out
