"""Landing files derived from the driver's tables, for the reader queries (files are written by Spark
jobs into the shared scratch folder; each generated file format matches what the readers accept).

Fixed values of the derivation (mirrored by the oracles):
* station list  <- customer: id lpad(c_custkey, 5); name c_name (padded when c_custkey % 7 = 0);
  lat/lon (4700 + c*37 % 800)/100, (600 + c*53 % 900)/100; height c_acctbal (empty when c % 5 = 0);
  country c_mktsegment; blank line when c % 23 = 0; five fields when c % 19 = 0; empty lat when
  c % 13 = 0; lon 'abc' when c % 17 = 0.
* responses     <- events grouped by (user_id, event_id div 16): source id user_id + 100000, a stale
  duplicate source listed first; timestamp 'not-a-time' when k % 50 = 7, absent when k % 50 = 8,
  suffix 'Z' for even k else '+00:00'; users with user_id % 17 = 0 answer with a no-data marker.
  With ``faults``: an unknown source id when k % 50 = 9, temperature "n/a" when k % 50 = 11, and documents cut
  in half where (event_id div 16) % 40 = 39.
* features      <- supplier: plz 10000 + s (20000 + s when s % 5 = 0), padded when s % 4 = 0, no
  postcode when s % 11 = 0; Polygon (s % 3 = 0), MultiPolygon of the square and its copy shifted by
  +100 x (s % 3 = 1), GeometryCollection of a point and the square (s % 3 = 2), LineString when s % 13 = 0.
* topology      <- supplier squares as 4 arcs each (odd sides stored reversed), quantised with scale 0.5
  and translate (100, 200).
* topology documents <- supplier: five documents (s % 5), arcs numbered from 0 in each; Polygon (s % 3 = 0), MultiPolygon
  (s % 3 = 1), a Polygon two collections deep (s % 3 = 2); postcode 10000 + s, padded when s % 4 = 0, absent when
  s % 11 = 0, 20000 + s when s % 7 = 0; the document s % 5 = 4 is not quantised.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.session import scratch_path
from stratus.sources.standins import k_of, wmo_id

TOPO_SCALE = (0.5, 0.5)
TOPO_TRANSLATE = (100.0, 200.0)
STATION_LIST_HEADER = "WMO-StationID;StationName;Latitude;Longitude;Height;Country"


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "stratus", "landing", f"{name}_{uuid.uuid4().hex[:10]}")


def write_station_list(customer: DataFrame, path: str) -> str:
    c = F.col("c_custkey")
    lat = ((F.lit(4700) + (c * 37) % 800).cast("double") / F.lit(100.0)).cast("string")
    lon = ((F.lit(600) + (c * 53) % 900).cast("double") / F.lit(100.0)).cast("string")
    name = F.when(c % 7 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name"))
    fields = [wmo_id(c), name,
              F.when(c % 13 == 0, F.lit("")).otherwise(lat),
              F.when(c % 17 == 0, F.lit("abc")).otherwise(lon),
              F.when(c % 5 == 0, F.lit("")).otherwise(F.col("c_acctbal").cast("string")),
              F.col("c_mktsegment")]
    line = (F.when(c % 23 == 0, F.lit(""))
            .when(c % 19 == 0, F.concat_ws(";", *fields[:5]))
            .otherwise(F.concat_ws(";", *fields)))
    (customer.select(line.alias(STATION_LIST_HEADER)).write
     .option("header", True).option("sep", "\u0001").option("quote", "\u0000").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_weather_responses(events: DataFrame, path: str, faults: bool = False) -> str:
    k = k_of()
    ev = events.select("event_id", "user_id", "ts", "event_type", "value", k.alias("k"))
    ts_txt = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ts_txt = (F.when(F.col("k") % 50 == 7, F.lit("not-a-time"))
              .when(F.col("k") % 50 == 8, F.lit(None).cast("string"))
              .when(F.col("k") % 2 == 0, F.concat(ts_txt, F.lit("Z")))
              .otherwise(F.concat(ts_txt, F.lit("+00:00"))))
    source_id, temperature = F.col("user_id") + 100000, F.col("value") - F.lit(60.0)
    if faults:
        source_id = F.when(F.col("k") % 50 == 9, F.lit(-1)).otherwise(source_id)
        temperature = F.when(F.col("k") % 50 == 11, F.lit("n/a")).otherwise(temperature.cast("string"))
    elem = F.to_json(F.named_struct(F.lit("timestamp"), ts_txt, F.lit("source_id"), source_id,
                                    F.lit("temperature"), temperature, F.lit("condition"), F.col("event_type")))
    grouped = (ev.groupBy("user_id", F.floor(F.col("event_id") / 16).alias("chunk"))
               .agg(F.collect_list(elem).alias("weather")))
    src_id = F.col("user_id") + 100000
    stale = F.to_json(F.named_struct(F.lit("id"), src_id, F.lit("wmo_station_id"), F.lit("99999"),
                                     F.lit("station_name"), F.lit("stale")))
    fresh = F.to_json(F.named_struct(F.lit("id"), src_id, F.lit("wmo_station_id"), wmo_id(F.col("user_id")),
                                     F.lit("station_name"), F.concat(F.lit("station-"), F.col("user_id").cast("string"))))
    doc = F.concat(F.lit('{"weather":['), F.array_join("weather", ","), F.lit('],"sources":['), stale, F.lit(","),
                   fresh, F.lit("]}"))
    marker = F.concat(F.lit('{"weather":[],"sources":[],"_no_data":true,"_station_id":"'), wmo_id(F.col("user_id")),
                      F.lit('","_http_status":404,"_response_message":"Not Found"}'))
    if faults:
        doc = F.when(F.col("chunk") % 40 == 39, F.substr(doc, F.lit(1), F.floor(F.length(doc) / 2).cast("int"))).otherwise(doc)
    grouped.select(F.when(F.col("user_id") % 17 == 0, marker).otherwise(doc).alias("value")).write.text(path)
    return path


def _square(cx: Column, cy: Column, h: int = 40) -> Column:
    def pt(x, y):
        return F.array(x.cast("double"), y.cast("double"))
    return F.array(pt(cx - h, cy - h), pt(cx + h, cy - h), pt(cx + h, cy + h), pt(cx - h, cy + h), pt(cx - h, cy - h))


def _shifted(ring: Column, dx: int) -> Column:
    return F.transform(ring, lambda p: F.array(p[0] + F.lit(float(dx)), p[1]))


def write_postal_features(supplier: DataFrame, path: str) -> str:
    s = F.col("s_suppkey")
    cx = F.lit(600) + (s * 71) % 900
    cy = F.lit(4700) + (s * 29) % 800
    plz = (F.when(s % 5 == 0, F.lit(20000)).otherwise(F.lit(10000)) + s).cast("string")
    plz = F.when(s % 11 == 0, F.lit(None).cast("string")).when(s % 4 == 0, F.concat(F.lit(" "), plz, F.lit("  "))).otherwise(plz)
    ring = _square(cx, cy)
    poly = F.to_json(F.array(ring))
    multi = F.to_json(F.array(F.array(ring), F.array(_shifted(ring, 100))))
    geom = (F.when(s % 13 == 0, F.concat(F.lit('{"type":"LineString","coordinates":'), F.to_json(F.slice(ring, 1, 2)), F.lit("}")))
            .when(s % 3 == 0, F.concat(F.lit('{"type":"Polygon","coordinates":'), poly, F.lit("}")))
            .when(s % 3 == 1, F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), multi, F.lit("}")))
            .otherwise(F.concat(F.lit('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":['),
                                cx.cast("double").cast("string"), F.lit(","), cy.cast("double").cast("string"),
                                F.lit(']},{"type":"Polygon","coordinates":'), poly, F.lit("}]}"))))
    props = F.to_json(F.named_struct(F.lit("postcode"), plz, F.lit("note"), F.lit("x")), {"ignoreNullFields": "false"})
    feat = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geom, F.lit("}"))
    supplier.select(feat.alias("value")).write.text(path)
    return path


def topology_from_suppliers(supplier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(arc_points, ring_refs) of the supplier squares: arc 4s+j is side j; odd sides stored reversed."""
    s = F.col("s_suppkey")
    cx = F.lit(600) + (s * 71) % 900
    cy = F.lit(4700) + (s * 29) % 800
    sq = supplier.select(s.alias("s"), _square(cx, cy).alias("ring"),
                         (F.lit(10000) + s).cast("string").alias("feature"))
    sides = sq.select("s", "feature", F.posexplode(F.sequence(F.lit(0), F.lit(3))).alias("j", "_j")).drop("_j")
    sides = sides.join(sq.select("s", "ring"), "s")
    a = F.col("ring")[F.col("j")]
    b = F.col("ring")[F.col("j") + 1]
    odd = F.col("j") % 2 == 1
    first = F.when(odd, b).otherwise(a)
    second = F.when(odd, a).otherwise(b)
    q = lambda p, i: ((p[i] - F.lit(TOPO_TRANSLATE[i])) / F.lit(TOPO_SCALE[i]))
    arc_id = (F.col("s") * 4 + F.col("j")).cast("long")
    p0 = sides.select(arc_id.alias("arc_id"), F.lit(0).alias("pos"), q(first, 0).alias("dx"), q(first, 1).alias("dy"))
    p1 = sides.select(arc_id.alias("arc_id"), F.lit(1).alias("pos"), (q(second, 0) - q(first, 0)).alias("dx"),
                      (q(second, 1) - q(first, 1)).alias("dy"))
    arcs = p0.unionByName(p1)
    refs = sides.select("feature", F.lit(0).alias("poly"), F.lit(0).alias("ring"), F.col("j").alias("ref_pos"),
                        F.when(odd, -arc_id - 1).otherwise(arc_id).alias("ref"))
    return arcs, refs


def write_topology_documents(supplier: DataFrame, path: str) -> str:
    s = F.col("s_suppkey")
    ring = _square(F.lit(600) + (s * 71) % 900, F.lit(4700) + (s * 29) % 800)
    plz = (F.when(s % 7 == 0, F.lit(20000)).otherwise(F.lit(10000)) + s).cast("string")
    plz = F.when(s % 11 == 0, F.lit(None).cast("string")).when(s % 4 == 0, F.concat(F.lit(" "), plz, F.lit(" "))).otherwise(plz)
    first = F.row_number().over(Window.partitionBy(s % 5).orderBy("s_suppkey")) - 1
    rows = supplier.select("s_suppkey", (s % 5).alias("d"), (first * 4).alias("a"), ring.alias("ring"), plz.alias("plz"))

    def arc(j: int) -> Column:  # side j, odd ones backwards; deltas in quantised documents
        p, q = (F.col("ring")[j + j % 2], F.col("ring")[j + 1 - j % 2])
        at = [[(x[i] - F.lit(TOPO_TRANSLATE[i])) / F.lit(TOPO_SCALE[i]) for i in (0, 1)] for x in (p, q)]
        quantised = F.array(F.array(*at[0]), F.array(*[b - a for a, b in zip(*at, strict=True)]))
        return F.when(F.col("d") == 4, F.array(p, q)).otherwise(quantised)

    refs = F.concat(F.lit("[["), F.concat_ws(",", *[(F.col("a") + j if j % 2 == 0 else -F.col("a") - j - 1).cast("string") for j in range(4)]), F.lit("]]"))
    props = F.concat(F.lit(',"properties":'), F.to_json(F.struct(F.col("plz").alias("postcode")), {"ignoreNullFields": "false"}))
    polygon = F.concat(F.lit('"type":"Polygon","arcs":'), refs)
    geometry = (F.when(s % 3 == 0, polygon).when(s % 3 == 1, F.concat(F.lit('"type":"MultiPolygon","arcs":['), refs, F.lit("]")))
                .otherwise(F.concat(F.lit('"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[0,0]},'
                                          '{"type":"GeometryCollection","geometries":[{'), polygon, F.lit("}]}]"))))
    parts = rows.select("d", "s_suppkey", F.to_json(F.array(*[arc(j) for j in range(4)])).alias("arcs"),
                        F.concat(F.lit("{"), geometry, props, F.lit("}")).alias("geometry"))
    listed = parts.groupBy("d").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "arcs", "geometry"))).alias("p"))
    arcs = F.array_join(F.transform("p", lambda x: F.substr(x.arcs, F.lit(2), F.length(x.arcs) - 2)), ",")
    transform = F.when(F.col("d") == 4, F.lit("")).otherwise(
        F.lit(f'"transform":{{"scale":[{TOPO_SCALE[0]},{TOPO_SCALE[1]}],"translate":[{TOPO_TRANSLATE[0]},{TOPO_TRANSLATE[1]}]}},'))
    doc = F.concat(F.lit('{"type":"Topology",'), transform, F.lit('"objects":{"areas":{"type":"GeometryCollection","geometries":['),
                   F.array_join(F.transform("p", lambda x: x.geometry), ","), F.lit(']}},"arcs":['), arcs, F.lit("]}"))
    # one document a file
    listed.select("d", doc.alias("value")).repartition(5, "d").write.partitionBy("d").text(path)
    return path
