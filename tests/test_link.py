"""Nearest-station link against a brute-force Python reference (planar distance, even-odd inside test)."""

import math
import random

from pyspark.sql import functions as F

from stratus.functions.geometry import geom_from_wkt, make_point
from stratus.operators.link import nearest_link


def _seg_d2(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / l2))
    cx, cy = x1 + t * dx, y1 + t * dy
    return (px - cx) ** 2 + (py - cy) ** 2


def _brute_d2(poly_rings, px, py):
    best, crossings = math.inf, 0
    for ring in poly_rings:
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            best = min(best, _seg_d2(px, py, x1, y1, x2, y2))
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                crossings += 1
    return 0.0 if crossings % 2 else best


def _wkt(polys):
    return "MULTIPOLYGON(" + ", ".join(
        "(" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in ring + [ring[0]]) + ")" for ring in poly) + ")"
        for poly in polys) + ")"


def _fixture(seed, n_areas=40, n_st=60):
    rnd = random.Random(seed)
    areas = []
    for a in range(n_areas):
        cx, cy, r = rnd.randint(0, 1000), rnd.randint(0, 1000), rnd.randint(5, 60)
        outer = [(cx - r, cy - r), (cx + r, cy - r), (cx + r, cy + r), (cx - r, cy + r)]
        polys = [[outer]]
        if a % 3 == 0:  # hole
            h = r // 3
            polys[0].append([(cx - h, cy - h), (cx + h, cy - h), (cx + h, cy + h), (cx - h, cy + h)])
        if a % 4 == 1:  # second part: a triangle
            polys.append([[(cx + 2 * r, cy), (cx + 3 * r, cy), (cx + 2 * r, cy + r)]])
        areas.append((a, polys))
    stations = [(s, float(rnd.randint(0, 1000)), float(rnd.randint(0, 1000))) for s in range(n_st)]
    stations.append((n_st, stations[0][1], stations[0][2]))  # co-located duplicate (higher id)
    return areas, stations


def _expected(areas, stations, k):
    out = {}
    for aid, polys in areas:
        rings = [ring for poly in polys for ring in poly]
        d = sorted((_brute_d2(rings, x, y), sid) for sid, x, y in stations)
        out[aid] = [sid for _, sid in d[:k]]
    return out


def _frames(spark, areas, stations):
    a = spark.createDataFrame([(aid, _wkt(p)) for aid, p in areas], "id long, wkt string").withColumn(
        "geometry", geom_from_wkt("wkt"))
    s = spark.createDataFrame(stations, "id long, lon double, lat double").withColumn("geometry", make_point("lon", "lat"))
    return a, s


def test_nearest_matches_brute_force(spark):
    areas, stations = _fixture(1)
    a, s = _frames(spark, areas, stations)
    got = {r.postal_area_id: [r.station_id] for r in nearest_link(a, s).collect()}
    assert got == _expected(areas, stations, 1)


def test_nearest_k2_and_unpruned_and_small_cells(spark):
    areas, stations = _fixture(2, 25, 30)
    a, s = _frames(spark, areas, stations)
    want = _expected(areas, stations, 2)
    for kw in ({}, {"prune": False}, {"cell_size": 3.0}):
        rows = nearest_link(a, s, k=2, **kw).collect()
        got = {}
        for r in sorted(rows, key=lambda r: (r.postal_area_id, r.rank)):
            got.setdefault(r.postal_area_id, []).append(r.station_id)
        assert got == want, kw


def test_far_station_found_by_coarser_levels(spark):
    areas = [(0, [[[(0, 0), (1, 0), (1, 1), (0, 1)]]]), (1, [[[(500, 500), (501, 500), (501, 501)]]])]
    stations = [(7, 1000.0, 1000.0), (9, -800.0, 3.0)]
    a, s = _frames(spark, areas, stations)
    got = {r.postal_area_id: r.station_id for r in nearest_link(a, s).collect()}
    assert got == {aid: v[0] for aid, v in _expected(areas, stations, 1).items()}


def test_no_stations_no_rows(spark):
    areas, _ = _fixture(3, 3, 1)
    a, s = _frames(spark, areas, [(1, 0.0, 0.0)])
    assert nearest_link(a, s.filter(F.lit(False))).count() == 0


def _star(rnd, cx, cy, n, rmin, rmax):
    pts = []
    for i in range(n):
        a = 2 * math.pi * i / n
        r = rnd.uniform(rmin, rmax)
        pts.append((round(cx + r * math.cos(a), 3), round(cy + r * math.sin(a), 3)))
    return pts


def test_non_convex_polygons_match_brute_force(spark):
    rnd = random.Random(11)
    areas = [(a, [[_star(rnd, rnd.uniform(0, 500), rnd.uniform(0, 500), rnd.randint(5, 12), 5, 40)]])
             for a in range(30)]
    stations = [(s, rnd.uniform(-50, 550), rnd.uniform(-50, 550)) for s in range(80)]
    a, s = _frames(spark, areas, stations)
    got = {r.postal_area_id: [r.station_id] for r in nearest_link(a, s).collect()}
    want = _expected(areas, stations, 1)
    assert got == want


def _ring(n, cx, cy, rmin, rmax, seed):
    """A winding outline of short edges between two radii."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        a = 2 * math.pi * i / n
        r = (rmin + rmax) / 2 + (rmax - rmin) * 0.45 * math.sin((3 + seed) * a) + rnd.uniform(-0.01, 0.01)
        out.append((cx + r * math.cos(a), cy + r * math.sin(a)))
    return out


def _brute_numpy(polys, stations, k):
    import numpy as np
    edges = np.array([(*r[i], *r[(i + 1) % len(r)]) for p in polys for r in p for i in range(len(r))], float)
    x1, y1, x2, y2 = edges.T
    out = []
    for sid, px, py in stations:
        dx, dy = x2 - x1, y2 - y1
        t = np.clip(((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy), 0, 1)
        d2 = ((px - x1 - t * dx) ** 2 + (py - y1 - t * dy) ** 2).min()
        straddle = (y1 > py) != (y2 > py)
        s = edges[straddle]
        odd = (px < (s[:, 2] - s[:, 0]) * (py - s[:, 1]) / (s[:, 3] - s[:, 1]) + s[:, 0]).sum() % 2
        out.append((0.0 if odd else d2, sid))
    return [sid for _, sid in sorted(out)[:k]]


def test_many_edges_and_stations_join_few_edges_per_station(spark):
    """An area of 30,000 edges (hole, second part) with 2,000 stations in its box, and one whose ring holds none."""
    from stratus.operators import link
    from stratus.functions.geometry import explode_segments
    rnd = random.Random(21)
    outer, hole = _ring(16000, 0, 0, 80, 100, 1), _ring(8000, 0, 0, 30, 50, 2)
    part = _ring(6000, 150, 0, 20, 30, 3)
    big = [[outer, hole], [part]]
    hollow = [[_ring(4000, 1000, 0, 95, 100, 4), _ring(4000, 1000, 0, 80, 85, 5)]]  # stations in its hole only
    stations = [(s, rnd.uniform(-100, 180), rnd.uniform(-100, 100)) for s in range(2000)]
    inside = [(5000 + s, 1000 + rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for s in range(1000)]
    a, s = _frames(spark, [(0, big), (1, hollow)], stations + inside)
    got = {}
    for r in nearest_link(a, s, k=3).collect():
        got.setdefault(r.postal_area_id, {})[r.rank] = r.station_id
    assert [got[0][i] for i in (1, 2, 3)] == _brute_numpy(big, stations, 3)
    assert [got[1][i] for i in (1, 2, 3)] == _brute_numpy(hollow, inside, 3)
    edges = explode_segments(a.select(F.col("id").alias("aid"), F.col("geometry").alias("g")), "aid", "g")
    pairs = spark.createDataFrame([(0, *x) for x in stations], "aid long, sid long, x double, y double")
    assert link._meet_bands(pairs, edges).count() < 30 * len(stations)


def test_wide_area_and_far_cluster_hold_few_cells(spark):
    from stratus.operators import link
    rnd = random.Random(22)
    wide = [(0, [[[(0, 0), (1000, 0), (1000, 1000), (0, 1000)]]])]
    small = [(i, [[[(x, y), (x + 1, y), (x + 1, y + 1)]]]) for i, (x, y) in enumerate(
        [(rnd.uniform(0, 1000), rnd.uniform(0, 1000)) for _ in range(60)], 1)]
    cluster = [(s, 50000 + rnd.uniform(0, 5), 50000 + rnd.uniform(0, 5)) for s in range(3000)]
    a, s = _frames(spark, wide + small, cluster + [(9000, -3.0, 500.0)])
    fronts = []
    orig = link._cells_for_areas

    def spy(*args):
        fronts.append(orig(*args))
        return fronts[-1]

    link._cells_for_areas = spy
    try:
        got = {r.postal_area_id: r.station_id for r in nearest_link(a, s, cell_size=1.0).collect()}
        near = {r.postal_area_id: r.station_id for r in nearest_link(a, s.filter("id < 9000")).collect()}
    finally:
        link._cells_for_areas = orig
    assert max(f.groupBy("aid").count().agg(F.max("count")).first()[0] or 0 for f in fronts) <= 64
    assert got == {i: 9000 for i in range(61)}
    for i, polys in wide + small:
        assert [near[i]] == _brute_numpy(polys, cluster, 1)


def test_stations_on_the_boundary_are_at_distance_zero(spark):
    areas = [(0, [[[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]])]
    stations = [(9, 5.0, 1.0), (3, 10.0, 10.0), (2, 5.0, 4.0), (1, 5.0, 5.0), (4, 10.0, 3.0), (5, 3.0, 10.0)]
    a, s = _frames(spark, areas, stations)
    rows = {r["rank"]: (r.station_id, r.distance) for r in nearest_link(a, s, k=6).collect()}
    assert [rows[i] for i in range(1, 7)] == [(2, 0.0), (3, 0.0), (4, 0.0), (5, 0.0), (9, 0.0), (1, 1.0)]
    assert nearest_link(a.filter("false"), s).count() == 0


def test_co_located_stations_are_met_k_a_place(spark, monkeypatch):
    """Of very many stations at one place only the k lowest ids meet the areas."""
    from stratus.operators import link
    met, candidates = [], link._candidates

    def counted(areas, stations, levels, k, prune):
        met.append(stations.count())
        return candidates(areas, stations, levels, k, prune)

    monkeypatch.setattr(link, "_candidates", counted)
    places = [(10.0, 10.0), (12.0, 10.0), (80.0, 80.0)]
    st = spark.createDataFrame([(300 - n, *places[n % 3]) for n in range(300)], "id long, x double, y double")
    st = st.select("id", make_point("x", "y").alias("geometry"))
    ar = spark.createDataFrame([(1, _wkt([[[(9, 9), (11, 9), (11, 11), (9, 11)]]])), (2, _wkt([[[(70, 70), (75, 70), (75, 75)]]]))],
                               "id long, wkt string").select("id", geom_from_wkt("wkt").alias("geometry"))
    got = nearest_link(ar, st, k=2).orderBy("postal_area_id", "rank").collect()
    assert [(r.postal_area_id, r.station_id) for r in got] == [(1, 3), (1, 6), (2, 1), (2, 4)]
    assert met == [6]
