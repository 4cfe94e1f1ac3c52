"""Landing readers; cases follow the reference's ingestion tests plus the edge cases it leaves open."""

import datetime as dt
import json

from pyspark.sql import functions as F

from stratus.sources import landing as L

OBS = {"timestamp": "2021-03-14T09:20:00+00:00", "source_id": 71, "temperature": -2.25, "precipitation": 1.5,
       "wind_speed": 11.0, "wind_direction": 20, "pressure_msl": 987.5, "relative_humidity": 91.0,
       "cloud_cover": 100.0, "visibility": 350, "dew_point": -3.0, "solar": 0.0, "sunshine": 0,
       "wind_gust_speed": 19.5, "wind_gust_direction": 35, "precipitation_probability": 80,
       "precipitation_probability_6h": 95, "condition": "snow", "icon": "snow"}
SRC = {"id": 71, "wmo_station_id": "40777", "station_name": "Hill Top"}


def _docs(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


def test_parse_valid_response(spark):
    rows = L.explode_weather_response(_docs(spark, {"weather": [OBS], "sources": [SRC]}), "test").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.wmo_station_id == "40777" and r.timestamp_utc == dt.datetime(2021, 3, 14, 9, 20)
    assert r.record_source == "test" and json.loads(r.raw)["temperature"] == -2.25


def test_empty_and_missing_fields_and_marker(spark):
    partial = {"timestamp": "2021-03-14T09:20:00Z", "source_id": 71, "temperature": 4.0}
    marker = {"weather": [], "sources": [], "_no_data": True, "_station_id": ["40777"], "_http_status": 404}
    docs = _docs(spark, {"weather": [], "sources": []}, {"weather": [partial], "sources": [SRC]}, marker)
    rows = L.explode_weather_response(docs).collect()
    assert [(r.wmo_station_id, r.timestamp_utc) for r in rows] == [("40777", dt.datetime(2021, 3, 14, 9, 20))]
    _, markers = L.no_data_split(L.parse_responses(docs))
    assert [r._http_status for r in markers.collect()] == [404]


def test_bad_timestamp_unknown_source_duplicate_source(spark):
    w = [dict(OBS, timestamp="bad"), dict(OBS, timestamp=None), dict(OBS, source_id=1),
         dict(OBS, timestamp="2021-03-14T11:20:00+02:00")]
    srcs = [dict(SRC, wmo_station_id="00000"), SRC]  # repeated id: the last one wins
    docs = _docs(spark, {"weather": w, "sources": srcs})
    kept = L.explode_weather_response(docs).collect()
    assert [(r.wmo_station_id, r.timestamp_utc) for r in kept] == [("40777", dt.datetime(2021, 3, 14, 9, 20))]
    quarantine = L.explode_weather_response(docs, keep_unknown_sources=True).filter(F.col("wmo_station_id").isNull())
    assert quarantine.count() == 1


def test_station_list(spark, tmp_dir):
    text = ("WMO-StationID;StationName;Latitude;Longitude;Height;Country\n"
            "01001;ALPHA PIER;12.5;-3.25;9.0;Nowhere\n"
            "01002;BETA RIDGE;-7.75;44.5;14.0;Nowhere\n\n"
            "01003;GAMMA FIELD;33.0;15.5;28.0;Nowhere\n"
            "01004;FIVE;1;2;3\n01005; PADDED ;0;0;;X\n01006;BAD;x;1;1;Y\n01007;NOLAT;;1;1;Y\n")
    p = tmp_dir + "/stations"
    import os
    os.makedirs(p)
    with open(p + "/list.txt", "w") as f:
        f.write(text)
    rows = L.read_station_list(spark, p).orderBy("station_id").collect()
    assert [r.station_id for r in rows] == ["01001", "01002", "01003", "01005"]
    assert rows[3].station_name == "PADDED" and rows[3].lat == 0.0 and rows[3].height is None
    raw = L.station_raw(L.read_station_list(spark, p), "2024-01-01 00:00:00").collect()
    assert len(raw) == 4  # lat/lon 0.0 kept (quirk Q7 fixed)


def test_postal_features(spark):
    sq = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    feats = [
        {"properties": {"postcode": " 10115 "}, "geometry": {"type": "Polygon", "coordinates": sq}},
        {"properties": {"postcode": "10117"}, "geometry": {"type": "GeometryCollection", "geometries": [
            {"type": "Point", "coordinates": [0, 0]}, {"type": "MultiPolygon", "coordinates": [sq, sq]}]}},
        {"properties": {"postcode": None}, "geometry": {"type": "Polygon", "coordinates": sq}},
        {"properties": {"postcode": "20115"}, "geometry": {"type": "Polygon", "coordinates": sq}},
        {"properties": {"postcode": "10119"}, "geometry": {"type": "LineString", "coordinates": sq[0]}},
        {"properties": {"postcode": "10120"}, "geometry": None},
    ]
    rows = {r.plz: r.wkt for r in L.read_postal_features(_docs(spark, *feats), prefix="10").collect()}
    assert rows == {"10115": "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))",
                    "10117": "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((0 0, 1 0, 1 1, 0 0)))"}


def test_topology_shared_reversed_arcs(spark):
    # two unit squares sharing the edge x=1; arc 1 is that edge, walked backwards by the second square
    topo = {"arcs": [[[0, 0], [1, 0]], [[1, 0], [0, 1]], [[1, 0], [1, 0], [0, 1], [-1, 0]],
                     [[1, 1], [-1, 0], [0, -1]]],
            "objects": {"areas": {"type": "GeometryCollection", "geometries": [
                {"type": "Polygon", "arcs": [[0, 1, 3]], "properties": {"postcode": "A"}},
                {"type": "Polygon", "arcs": [[2, -2]], "properties": {"postcode": "B"}}]}}}
    arcs, refs = L.topology_tables(spark.createDataFrame([(json.dumps(topo),)], "value string"), "areas")
    got = {r.feature: r.wkt for r in L.stitch_topology_arcs(arcs, refs).collect()}
    assert got == {"A": "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)))",
                   "B": "MULTIPOLYGON (((1 0, 2 0, 2 1, 1 1, 1 0)))"}


def test_readers_feed_the_models(spark):
    """Reader output goes straight into staging and the postal dimension."""
    from stratus.plans import models
    rows = L.explode_weather_response(_docs(spark, {"weather": [OBS], "sources": [SRC]}), load_dts="2024-01-01 00:00:00")
    stg = models.stg_weather(rows).collect()
    assert len(stg) == 1 and stg[0].temperature == -2.25 and stg[0].outlier_flag is None
    sq = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    feats = _docs(spark, {"properties": {"postcode": "10115"}, "geometry": {"type": "Polygon", "coordinates": sq}})
    dim = models.dim_postal_area(models.stg_postal_area(L.read_postal_features(feats, load_dts="2024-01-01 00:00:00")))
    assert [(r.id, r.plz) for r in dim.collect()] == [(1, "10115")]


def test_every_element_goes_one_way(spark, tmp_dir):
    w = [dict(OBS), dict(OBS, timestamp="bad"), dict(OBS, timestamp=None), dict(OBS, source_id=1), dict(OBS, solar="much"),
         dict(OBS, timestamp="bad", source_id=1, solar="x"), dict(OBS, source_id=1, solar="x")]
    marker = {"weather": [OBS], "sources": [], "_no_data": True}
    whole = [{"weather": w, "sources": [dict(SRC, wmo_station_id="0"), SRC]}, marker, {}, {"weather": [], "sources": []}]
    docs = spark.createDataFrame([(json.dumps(d),) for d in whole] + [('{"weather": [{"a"',), (None,), ("",)], "value string")
    landed = L.land_responses(docs, tmp_dir + "/landed", "2024-01-01 00:00:00")
    ways = {"ok": 1, "bad_timestamp": 3, "unknown_source": 2, "bad_number": 1, "no_data": 1, "bad_document": 3}
    assert landed.counts == {**ways, "rows_in": sum(ways.values())}
    assert [(r.wmo_station_id, r.timestamp_utc, r.load_dts) for r in landed.accepted.collect()] == [
        ("40777", dt.datetime(2021, 3, 14, 9, 20), dt.datetime(2024, 1, 1))]
    aside = landed.set_aside.groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in aside} == {k: v for k, v in ways.items() if k != "ok"}
    assert landed.accepted.columns == L.explode_weather_response(docs, load_dts="2024-01-01 00:00:00").columns
    none = L.land_responses(docs.limit(0), tmp_dir + "/landed", "2024-01-01 00:00:00")
    assert none.counts["rows_in"] == 0 and none.accepted.count() == none.set_aside.count() == 0


def test_topology_documents_keep_their_own_arcs(spark):
    def square(x, y, code, absolute=False):
        pts = [[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]
        deltas = pts[:1] + [[b[0] - a[0], b[1] - a[1]] for a, b in zip(pts, pts[1:])]
        geometry = {"type": "Polygon", "arcs": [[0]], "properties": {"postcode": code}}
        doc = {"arcs": [pts if absolute else deltas, [[0, 0]]], "objects": {"x": {"type": "GeometryCollection", "geometries": [geometry]}}}
        return doc if absolute else {**doc, "transform": {"scale": [2, 2], "translate": [10, 0]}}

    nested = square(0, 0, None, True)
    nested["objects"]["x"]["geometries"] = [
        {"type": "GeometryCollection", "properties": {"postcode": "10003"}, "geometries": [
            {"type": "GeometryCollection", "geometries": [{"type": "Polygon", "arcs": [[0]]}, {"type": "Point", "coordinates": [0, 0]}]},
            {"type": "MultiPolygon", "arcs": [[[0]], [[-1]]]}, {"type": "Polygon", "arcs": [[0]], "properties": {"postcode": "10004"}}]},
        {"type": "LineString", "arcs": [0], "properties": {"postcode": "10005"}}, {"type": None, "properties": {"postcode": "10006"}}]
    docs = _docs(spark, square(0, 0, " 10001 "), square(5, 5, "10002", True), square(0, 0, "20001"), square(0, 0, None), nested, nested)
    got = {}
    for r in L.postal_from_topology(docs, prefix="10", load_dts="2024-01-01 00:00:00").collect():
        assert r.plz not in got and r.load_dts == dt.datetime(2024, 1, 1) and r.record_source == "topojson"
        got[r.plz] = r.wkt
    unit, back = "((0 0, 1 0, 1 1, 0 1, 0 0))", "((0 0, 0 1, 1 1, 1 0, 0 0))"
    assert got == {"10001": "MULTIPOLYGON (((10 0, 12 0, 12 2, 10 2, 10 0)))", "10002": "MULTIPOLYGON (((5 5, 6 5, 6 6, 5 6, 5 5)))",
                   "10003": f"MULTIPOLYGON ({unit}, {unit}, {back})", "10004": f"MULTIPOLYGON ({unit})"}
    assert L.postal_from_topology(docs.limit(0)).count() == 0
