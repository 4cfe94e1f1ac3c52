"""Landing-zone readers: station lists, weather response documents, postal polygons, topology arcs.

All parsing is Catalyst expressions over text/JSON columns; files are read with ``spark.read.text``
(one row per line, splittable) — a single JSON document per file (``wholetext``) only where the format
is one document.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.geometry import geom_from_wkt, geom_to_wkt
from stratus.functions.timeutil import hour_floor
from stratus.operators.clean import bad_measures
from stratus.session import materialize

# A number as Python's float() accepts it in these files (plain decimal / exponent, nan, inf).
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i)nan|(?i)inf(inity)?)$"


def _num(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


# ------------------------------------------------------------------------------------------ station list
STATION_LIST_FIELDS = ("wmo_station_id", "station_name", "lat", "lon", "height", "country")


def drop_file_headers(lines: DataFrame) -> DataFrame:
    """Drop the first line of every file. The first line lives in the split that starts at byte 0;
    within it, it has the smallest row id. One small (file -> id) aggregate, one row per file, locates
    them all. Both uses of the ids read the same file listing, whose split packing and in-split row order
    are fixed, so a recomputed task yields the same ids (no extra copy of the input is written)."""
    tagged = lines.select("value", F.input_file_name().alias("_file"), F.input_file_block_start().alias("_blk"),
                          F.monotonically_increasing_id().alias("_rid"))
    heads = tagged.filter(F.col("_blk") == 0).groupBy("_file").agg(F.min("_rid").alias("_rid"))
    return tagged.join(heads.select("_rid"), "_rid", "left_anti").select("value")


def parse_station_lines(lines: DataFrame, record_source: str = "station_list") -> DataFrame:
    """``id;name;lat;lon;height;country`` lines -> station records.

    Blank lines and lines with fewer than 6 fields are skipped; fields are trimmed; an empty lat / lon /
    height is NULL; a non-empty field that is not a number drops the line; no lat or no lon drops it.
    """
    parts = F.split(F.col("value"), ";")
    f = {n: F.trim(parts.getItem(i)) for i, n in enumerate(STATION_LIST_FIELDS)}
    nums = {n: F.when(f[n] == "", F.lit(None).cast("double")).otherwise(_num(f[n])) for n in ("lat", "lon", "height")}
    bad = F.lit(False)
    for n in ("lat", "lon", "height"):
        bad = bad | ((f[n] != "") & nums[n].isNull())
    out = (lines.filter(F.trim("value") != "")
           .filter(F.size(parts) >= 6)
           .select(f["wmo_station_id"].alias("station_id"), f["station_name"].alias("station_name"),
                   f["wmo_station_id"].alias("wmo_station_id"), nums["lat"].alias("lat"), nums["lon"].alias("lon"),
                   nums["height"].alias("height"), f["country"].alias("country"), bad.alias("_bad")))
    return (out.filter(~F.col("_bad") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .drop("_bad").withColumn("record_source", F.lit(record_source)))


def read_station_list(spark: SparkSession, path: str, record_source: str = "station_list",
                      skip_header: bool = True) -> DataFrame:
    lines = spark.read.text(path)
    if skip_header:
        lines = drop_file_headers(lines)
    return parse_station_lines(lines, record_source)


def station_raw(records: DataFrame, load_dts: str, record_source: str | None = None) -> DataFrame:
    """Station records -> ``station_raw`` rows: id, lat and lon required (a 0.0 coordinate is kept — the
    reference's truthiness test dropped it, quirk Q7); the name falls back to ``name``, lat/lon to
    ``latitude``/``longitude``; the whole record is kept as JSON ``properties``."""
    cols = set(records.columns)

    def pick(*names: str) -> Column:
        present = [F.col(n) for n in names if n in cols]
        return F.coalesce(*present) if len(present) > 1 else (present[0] if present else F.lit(None))

    # a blank name is no name: each column is blanked before the fallback
    names = [F.when(F.trim(F.col(n).cast("string")) != "", F.col(n).cast("string")) for n in ("station_name", "name") if n in cols]
    name = F.coalesce(*names) if names else F.lit(None).cast("string")
    rs = F.lit(record_source) if record_source else pick("record_source")
    out = records.select(pick("wmo_station_id").cast("string").alias("wmo_station_id"), name.alias("station_name"),
                         pick("lat", "latitude").cast("double").alias("lat"),
                         pick("lon", "longitude").cast("double").alias("lon"),
                         F.to_json(F.struct(*[F.col(c) for c in records.columns])).alias("properties"),
                         rs.cast("string").alias("record_source"),
                         F.lit(load_dts).cast("timestamp_ntz").alias("load_dts"))
    return out.filter(F.col("wmo_station_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())


# ------------------------------------------------------------------------------------------ weather responses
RESPONSE_SCHEMA = T.StructType([
    T.StructField("weather", T.ArrayType(T.StringType())),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("_no_data", T.BooleanType()),
    T.StructField("_station_id", T.StringType()),
    T.StructField("_timestamp_str", T.StringType()),
    T.StructField("_api_url", T.StringType()),
    T.StructField("_http_status", T.LongType()),
    T.StructField("_response_message", T.StringType()),
])

_EPOCH_NTZ = "1970-01-01 00:00:00"


def iso_to_utc_ntz(text: Column) -> Column:
    """ISO-8601 text -> UTC wall-clock TIMESTAMP_NTZ. With an offset or ``Z`` the instant is converted to
    UTC; without one the wall clock is kept. Unparseable -> NULL. Independent of the session time zone."""
    aware = text.rlike(r"(Z|z|[+-]\d{2}(:?\d{2})?)$")
    instant = F.try_to_timestamp(text)
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.when(aware, utc).otherwise(text.try_cast("timestamp_ntz"))


def parse_responses(docs: DataFrame, doc_col: str = "value") -> DataFrame:
    return docs.select(F.from_json(F.col(doc_col), RESPONSE_SCHEMA).alias("r")).filter(F.col("r").isNotNull())


def no_data_split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data documents, "no data" marker documents). Markers write no weather rows."""
    marker = F.coalesce(F.col("r._no_data"), F.lit(False))
    return parsed.filter(~marker), parsed.filter(marker).select("r._station_id", "r._timestamp_str", "r._api_url",
                                                                "r._http_status", "r._response_message")


def explode_weather_response(docs: DataFrame, record_source: str = "weather_api", doc_col: str = "value",
                             keep_unknown_sources: bool = False, load_dts: str | None = None) -> DataFrame:
    """Response documents -> one raw row per observation: (wmo_station_id, timestamp_utc, raw,
    bright_sky_source_mapping, record_source).

    The station is the ``wmo_station_id`` of the source whose ``id`` equals the observation's
    ``source_id`` (the last such source when ids repeat). An observation without a parseable timestamp
    is skipped. An unknown ``source_id`` (the reference fails the whole batch) yields a NULL station;
    such rows are dropped unless ``keep_unknown_sources`` (for quarantine).
    """
    data, _ = no_data_split(parse_responses(docs, doc_col))
    srcs = F.transform(F.coalesce(F.col("r.sources"), F.array().cast("array<string>")),
                       lambda s: F.named_struct(F.lit("id"), F.get_json_object(s, "$.id"), F.lit("doc"), s))
    obs = data.select(F.explode(F.col("r.weather")).alias("w"), srcs.alias("srcs"))
    sid = F.get_json_object("w", "$.source_id")
    match = F.filter(F.col("srcs"), lambda s: s.id == sid)
    src = F.try_element_at(match, F.lit(-1)).getField("doc")
    ts = iso_to_utc_ntz(F.get_json_object("w", "$.timestamp"))
    out = obs.select(F.get_json_object(src, "$.wmo_station_id").alias("wmo_station_id"), ts.alias("timestamp_utc"),
                     F.col("w").alias("raw"), src.alias("bright_sky_source_mapping"),
                     F.lit(record_source).alias("record_source"))
    out = out.filter(F.col("timestamp_utc").isNotNull())
    if load_dts is not None:  # the batch's load stamp, as the raw insert sets it
        out = out.withColumn("load_dts", F.lit(load_dts).cast("timestamp_ntz"))
    return out if keep_unknown_sources else out.filter(F.col("wmo_station_id").isNotNull())


# Why an observation, or a document, is set aside (in the order they are asked).
REASONS = ("ok", "bad_document", "no_data", "bad_timestamp", "unknown_source", "bad_number")


def route_responses(docs: DataFrame, record_source: str = "weather_api", doc_col: str = "value") -> DataFrame:
    """Every observation of every response document, and every document that has none to give, with where it goes:
    ``reason, wmo_station_id, timestamp_utc, raw, bright_sky_source_mapping, record_source``.

    * ``ok``: a raw weather row;
    * ``bad_document``: the text is not JSON (the document itself is ``raw``);
    * ``no_data``: a "no data" marker document;
    * ``bad_timestamp``: missing, or not ISO-8601 (the reference skips it without a word);
    * ``unknown_source``: a ``source_id`` that no source of the document has (it fails the reference's whole batch);
    * ``bad_number``: a measure that is there but is no number (it aborts the reference's staging).

    A valid document without observations gives no row. NULL documents count as not JSON.
    """
    doc = F.col(doc_col)
    parsed = docs.select(doc.alias("doc"), F.from_json(doc, RESPONSE_SCHEMA).alias("r"))
    nothing = F.col("r.weather").isNull() & F.col("r.sources").isNull() & F.col("r._no_data").isNull()
    whole = (F.when(nothing & F.try_parse_json("doc").isNull(), F.lit("bad_document"))
             .when(F.coalesce("r._no_data", F.lit(False)), F.lit("no_data")))
    no_rows = F.array().cast("array<string>")
    elements = F.when(F.col("whole").isNotNull(), F.array("doc")).otherwise(F.coalesce("r.weather", no_rows))
    rows = parsed.withColumn("whole", whole).select(
        "whole", F.explode(elements).alias("w"), F.coalesce("r.sources", no_rows).alias("sources"))
    source_id = F.get_json_object("w", "$.source_id")
    of_id = F.filter("sources", lambda x: F.get_json_object(x, "$.id") == source_id)
    rows = rows.select("whole", "w", F.try_element_at(of_id, F.lit(-1)).alias("src"),  # the last of equal ids wins
                       iso_to_utc_ntz(F.get_json_object("w", "$.timestamp")).alias("ts"))
    station = F.get_json_object("src", "$.wmo_station_id")
    reason = (F.when(F.col("whole").isNotNull(), F.col("whole")).when(F.col("ts").isNull(), F.lit("bad_timestamp"))
              .when(station.isNull(), F.lit("unknown_source")).when(F.size(bad_measures("w")) > 0, F.lit("bad_number"))
              .otherwise(F.lit("ok")))
    return rows.select(reason.alias("reason"), station.alias("wmo_station_id"), F.col("ts").alias("timestamp_utc"),
                       F.col("w").alias("raw"), F.col("src").alias("bright_sky_source_mapping"),
                       F.lit(record_source).alias("record_source"))


@dataclass(frozen=True)
class Landed:
    """One written batch: its raw rows, the rows set aside (with their ``reason``), and the number of rows that went
    each way, as counted by the write itself."""

    accepted: DataFrame
    set_aside: DataFrame
    counts: dict[str, int]
    path: str


def land_responses(docs: DataFrame, path: str, load_dts: str, record_source: str = "weather_api") -> Landed:
    """Route a batch of response documents and write all of it in one pass to a folder of its own under ``path``,
    partitioned by reason, one load stamp for the batch. Rows in are rows out plus rows set aside, or it raises."""
    routed = route_responses(docs, record_source).withColumn("load_dts", F.lit(load_dts).cast("timestamp_ntz"))
    seen = Observation()
    counted = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    own = f"{path}/batch-{uuid.uuid4().hex}"
    routed.observe(seen, F.count(F.lit(1)).alias("rows_in"), *counted).write.partitionBy("reason").parquet(own)
    counts = dict(seen.get)
    if counts["rows_in"] != sum(counts[r] for r in REASONS):
        raise RuntimeError(f"rows in and out differ: {counts}")
    written = docs.sparkSession.read.schema(routed.schema).parquet(own)
    return Landed(written.filter(F.col("reason") == "ok").drop("reason"), written.filter(F.col("reason") != "ok"), counts, own)


def append_raw(df: DataFrame, path: str, load_dts: str) -> None:
    """Bulk append with one load stamp for the whole batch, partitioned by load date."""
    (df.withColumn("load_dts", F.lit(load_dts).cast("timestamp_ntz"))
     .withColumn("load_date", F.to_date("load_dts"))
     .write.mode("append").partitionBy("load_date").parquet(path))


# ------------------------------------------------------------------------------------------ request windows
def request_window(kind: str, now: str, forecast_days: int = 1) -> tuple[Column, Column]:
    """Observed: the previous full hour [HH-1:00, HH-1:59]; forecast: [HH:01, HH:01 + days]."""
    n = F.lit(now).cast("timestamp_ntz")
    if kind == "observed":
        start = F.timestamp_add("HOUR", F.lit(-1), hour_floor(n))
        return start, F.timestamp_add("MINUTE", F.lit(59), start)
    start = F.timestamp_add("MINUTE", F.lit(1), hour_floor(n))
    return start, F.timestamp_add("DAY", F.lit(forecast_days), start)


def in_request_window(df: DataFrame, kind: str, now: str, ts_col: str = "timestamp_utc",
                      forecast_days: int = 1) -> DataFrame:
    lo, hi = request_window(kind, now, forecast_days)
    return df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))


# ------------------------------------------------------------------------------------------ scopes
def prefix_scope(df: DataFrame, prefix: str | None = None, col: str = "plz") -> DataFrame:
    return df.filter(F.col(col).startswith(prefix)) if prefix else df


def station_scope(station_raw_df: DataFrame, name_pattern: str | None = None) -> DataFrame:
    """Distinct station ids, all or those whose lower-cased name matches a LIKE pattern."""
    df = station_raw_df
    if name_pattern:
        df = df.filter(F.lower(F.col("station_name")).like(name_pattern))
    return df.select("wmo_station_id").distinct()


# ------------------------------------------------------------------------------------------ postal polygons
_POS = "array<double>"


def _ring(arr: Column) -> Column:
    return F.transform(arr, lambda p: F.named_struct(F.lit("x"), p.getItem(0), F.lit("y"), p.getItem(1)))


def _poly(arr: Column) -> Column:
    return F.transform(arr, _ring)


def geojson_to_multipolygon(geom_json: Column) -> Column:
    """GeoJSON geometry text -> multipolygon array: Polygon wraps, MultiPolygon stays, a
    GeometryCollection keeps and flattens its (multi)polygons; anything else (or nothing left) -> NULL."""
    t = F.get_json_object(geom_json, "$.type")
    coords = F.get_json_object(geom_json, "$.coordinates")
    polygon = F.from_json(coords, f"array<array<{_POS}>>")
    multi = F.from_json(coords, f"array<array<array<{_POS}>>>")
    members = F.from_json(F.get_json_object(geom_json, "$.geometries"), "array<string>")

    def member(g: Column) -> Column:
        gt = F.get_json_object(g, "$.type")
        gc = F.get_json_object(g, "$.coordinates")
        return (F.when(gt == "Polygon", F.array(_poly(F.from_json(gc, f"array<array<{_POS}>>"))))
                .when(gt == "MultiPolygon", F.transform(F.from_json(gc, f"array<array<array<{_POS}>>>"), _poly))
                .otherwise(F.array().cast("array<array<array<struct<x:double,y:double>>>>")))

    coll = F.flatten(F.transform(members, member))
    g = (F.when(t == "Polygon", F.array(_poly(polygon)))
         .when(t == "MultiPolygon", F.transform(multi, _poly))
         .when(t == "GeometryCollection", coll))
    return F.when(F.size(g) > 0, g)


def read_postal_features(features: DataFrame, prefix: str | None = None, feature_col: str = "value",
                         record_source: str = "geojson", load_dts: str | None = None) -> DataFrame:
    """GeoJSON features (one per row) -> postal_area_raw rows (plz, wkt, geometry, record_source).

    Features without ``postcode`` are dropped; the code is trimmed; the prefix scope is always applied
    (the reference skipped it on a fallback path, quirk Q8); geometries that do not coerce are dropped."""
    f = F.col(feature_col)
    pc = F.trim(F.get_json_object(f, "$.properties.postcode"))
    out = features.select(pc.alias("plz"), geojson_to_multipolygon(F.get_json_object(f, "$.geometry")).alias("geometry"))
    out = out.filter(F.col("plz").isNotNull())
    if prefix:
        out = prefix_scope(out, prefix)
    out = out.filter(F.col("geometry").isNotNull())
    out = out.select("plz", geom_to_wkt("geometry").alias("wkt"), "geometry", F.lit(record_source).alias("record_source"))
    if load_dts is not None:  # the batch's load stamp, as the raw insert sets it
        out = out.withColumn("load_dts", F.lit(load_dts).cast("timestamp_ntz"))
    return out


def read_postal_geojson(spark: SparkSession, path: str, prefix: str | None = None, lines: bool = True,
                        load_dts: str | None = None) -> DataFrame:
    """GeoJSON-seq (one feature per line, splittable) or a FeatureCollection document per file."""
    if lines:
        feats = spark.read.text(path)
    else:
        docs = spark.read.text(path, wholetext=True)
        feats = docs.select(F.explode(F.from_json("value", "struct<features:array<string>>").features).alias("value"))
    return read_postal_features(feats, prefix, load_dts=load_dts)


def wkt_to_raw(df: DataFrame, wkt_col: str = "wkt") -> DataFrame:
    """``ST_Multi(ST_GeomFromText(wkt))`` on a column of WKT."""
    return df.withColumn("geometry", geom_from_wkt(wkt_col))


# ------------------------------------------------------------------------------------------ topology arcs
def stitch_topology_arcs(arc_points: DataFrame, ring_refs: DataFrame, scale=(1.0, 1.0),
                         translate=(0.0, 0.0)) -> DataFrame:
    """Decode shared, delta-encoded arcs and stitch them into rings and multipolygons.

    ``arc_points``: (arc_id, pos, dx, dy) — quantised deltas, first point absolute. With ``sx, sy, tx, ty`` columns these
    are the arc's scale and translation instead of the arguments; NULL there: the positions are absolute.
    ``ring_refs``: (feature, poly, ring, ref_pos, ref) — ``ref >= 0`` is arc ``ref``; ``ref < 0`` is arc
    ``~ref`` walked backwards. Consecutive arcs share their joint point, which is kept once. Arc ids are numbers of a
    document: with a ``doc`` column in both tables, references mean arcs of their own document. Only arcs that
    are referred to are decoded. Returns ([doc,] feature, geometry, wkt).
    """
    key = ["doc"] if "doc" in arc_points.columns else []
    refs = ring_refs.select(*key, "feature", "poly", "ring", "ref_pos",
                            F.when(F.col("ref") >= 0, F.col("ref")).otherwise(-F.col("ref") - 1).alias("arc_id"),
                            (F.col("ref") < 0).alias("rev"))
    used = arc_points.join(refs.select(*key, "arc_id").distinct(), [*key, "arc_id"], "left_semi")
    w = Window.partitionBy(*key, "arc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)

    def position(delta: str, axis: int, s: str, t: str) -> Column:
        if s not in arc_points.columns:
            return F.sum(delta).over(w) * F.lit(float(scale[axis])) + F.lit(float(translate[axis]))
        return F.when(F.col(s).isNull(), F.col(delta)).otherwise(F.sum(delta).over(w) * F.col(s) + F.col(t))

    pts = used.select(*key, "arc_id", "pos", position("dx", 0, "sx", "tx").alias("x"), position("dy", 1, "sy", "ty").alias("y"))
    n = used.groupBy(*key, "arc_id").agg(F.max("pos").alias("last"))
    joined = (refs.join(n, [*key, "arc_id"]).join(pts, [*key, "arc_id"])
              .withColumn("k", F.when(F.col("rev"), F.col("last") - F.col("pos")).otherwise(F.col("pos")))
              .filter((F.col("ref_pos") == 0) | (F.col("k") > 0)))
    rings = (joined.groupBy(*key, "feature", "poly", "ring")
             .agg(F.array_sort(F.collect_list(F.struct("ref_pos", "k", "x", "y"))).alias("p"))
             .select(*key, "feature", "poly", "ring", F.transform("p", lambda q: F.named_struct(F.lit("x"), q.x, F.lit("y"), q.y)).alias("pts")))
    polys = (rings.groupBy(*key, "feature", "poly").agg(F.array_sort(F.collect_list(F.struct("ring", "pts"))).alias("r"))
             .select(*key, "feature", "poly", F.transform("r", lambda q: q.pts).alias("rings")))
    geoms = (polys.groupBy(*key, "feature").agg(F.array_sort(F.collect_list(F.struct("poly", "rings"))).alias("g"))
             .select(*key, "feature", F.transform("g", lambda q: q.rings).alias("geometry")))
    return geoms.select(*key, "feature", "geometry", geom_to_wkt("geometry").alias("wkt"))


_TOPOLOGY = "struct<arcs:array<array<array<double>>>, objects:map<string,string>, transform:struct<scale:array<double>,translate:array<double>>>"


def _documents(docs: DataFrame, doc_col: str) -> DataFrame:
    """``doc`` (the text's SHA-256) and the parsed topology ``t``; equal documents once."""
    return docs.filter(F.col(doc_col).isNotNull()).select(F.sha2(F.col(doc_col), 256).alias("doc"), F.col(doc_col).alias("_text")) \
        .dropDuplicates(["doc"]).select("doc", F.from_json("_text", _TOPOLOGY).alias("t"))


def _arcs(parsed: DataFrame, *cols) -> DataFrame:
    arcs = parsed.select("doc", *cols, F.posexplode("t.arcs").alias("arc_id", "pts"))
    keep = [c for c in arcs.columns if c != "pts"]
    arcs = arcs.select(*keep, F.posexplode("pts").alias("pos", "p"))
    return arcs.select(*[F.col(c).cast("long").alias(c) if c == "arc_id" else c for c in keep], "pos",
                       F.col("p")[0].alias("dx"), F.col("p")[1].alias("dy"))


def topology_tables(doc: DataFrame, object_name: str, doc_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """TopoJSON documents -> (arc_points, ring_refs) for ``stitch_topology_arcs``, keyed by document; the feature
    key is ``properties.postcode``. Arcs are taken as deltas."""
    t = _documents(doc, doc_col)
    geoms = t.select("doc", F.explode(F.from_json(F.get_json_object(F.col("t.objects")[object_name], "$.geometries"),
                                                  "array<string>")).alias("g"))
    geoms = geoms.select("doc", F.trim(F.get_json_object("g", "$.properties.postcode")).alias("feature"), "g")
    return _arcs(t), _ring_refs(geoms.withColumn("path", F.array(F.lit(0))), "doc", "feature").drop("path") \
        .select("doc", "feature", F.col("poly")[1].alias("poly"), "ring", "ref_pos", "ref")


def _ring_refs(geoms: DataFrame, *keys: str) -> DataFrame:
    """Ring references of the geometries ``g`` that are polygons; a polygon is numbered by its geometry's ``path``
    and its place there."""
    a, t = F.get_json_object("g", "$.arcs"), F.get_json_object("g", "$.type")
    polys = F.when(t == "Polygon", F.array(F.from_json(a, "array<array<long>>"))) \
        .when(t == "MultiPolygon", F.from_json(a, "array<array<array<long>>>"))
    return (geoms.select(*keys, "path", F.posexplode(polys).alias("p", "rings"))
            .select(*keys, F.concat("path", F.array("p")).alias("poly"), F.posexplode("rings").alias("ring", "arcs"))
            .select(*keys, "poly", "ring", F.posexplode("arcs").alias("ref_pos", "ref")).withColumn("path", F.lit(None)))


def postal_from_topology(docs: DataFrame, prefix: str | None = None, load_dts: str | None = None, doc_col: str = "value",
                         record_source: str = "topojson") -> DataFrame:
    """TopoJSON documents -> postal_area_raw rows, as the GeoJSON reader gives them.

    A feature is a geometry with ``properties.postcode`` in any object of a document, or inside collections there, however deep;
    the polygons of a collection belong to the nearest feature around them. Codes are trimmed, features without one, outside the
    prefix or without a polygon dropped. Arcs are deltas where the document has a ``transform``, else absolute.
    The loop runs over the depth of nesting, not over data.
    """
    t = _documents(docs, doc_col)
    level = t.select("doc", F.posexplode(F.map_values("t.objects")).alias("i", "g")) \
        .withColumn("path", F.array("i")).withColumns({"plz": F.lit(None).cast("string"), "of": F.lit(None).cast("array<int>")})
    found = None
    while True:
        own = F.trim(F.get_json_object("g", "$.properties.postcode"))
        level = materialize(level.select("doc", "path", "g", F.coalesce(own, "plz").alias("plz"),
                                         F.when(own.isNotNull(), F.col("path")).otherwise(F.col("of")).alias("of")), "topology")
        found = level if found is None else found.unionByName(level)
        collections = level.filter(F.get_json_object("g", "$.type") == "GeometryCollection")
        if collections.isEmpty():
            break
        members = F.from_json(F.get_json_object("g", "$.geometries"), "array<string>")
        level = collections.select("doc", "plz", "of", "path", F.posexplode(members).alias("i", "member")) \
            .select("doc", "plz", "of", F.concat("path", F.array("i")).alias("path"), F.col("member").alias("g"))
    scoped = prefix_scope(found.filter(F.col("plz").isNotNull()), prefix)
    refs = _ring_refs(scoped.withColumn("feature", F.struct("of", "plz")), "doc", "feature").drop("path")
    scale = {s: F.col(f"t.transform.{part}")[axis].alias(s) for s, part, axis in
             (("sx", "scale", 0), ("sy", "scale", 1), ("tx", "translate", 0), ("ty", "translate", 1))}
    out = stitch_topology_arcs(_arcs(t, *scale.values()), refs)
    out = out.select(F.col("feature.plz").alias("plz"), "wkt", "geometry", F.lit(record_source).alias("record_source"))
    return out if load_dts is None else out.withColumn("load_dts", F.lit(load_dts).cast("timestamp_ntz"))


def read_postal_topojson(spark: SparkSession, path: str, prefix: str | None = None, load_dts: str | None = None) -> DataFrame:
    """TopoJSON files, one document each."""
    return postal_from_topology(spark.read.text(path, wholetext=True), prefix, load_dts)
