"""Planar geometry as Catalyst expressions: WKT <-> nested arrays, bounding boxes, segment distances.

A multipolygon is ``array<array<array<struct<x:double,y:double>>>>`` (polygons -> rings -> points);
a point is ``struct<x:double,y:double>``. Distances are planar, in the coordinate units of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))

# polygon-level groups "(ring),(ring)" inside WKT; ring-level "x y, x y"
_POLY_RE = r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)"
_RING_RE = r"\(([^()]*)\)"


def make_point(x: Column | str, y: Column | str) -> Column:
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    return F.struct(xc.cast("double").alias("x"), yc.cast("double").alias("y"))


def geom_from_wkt(wkt: Column | str) -> Column:
    """POLYGON / MULTIPOLYGON WKT -> multipolygon array (``ST_Multi(ST_GeomFromText(...))``).

    Anything that is not a (multi)polygon yields NULL; an empty result yields NULL.
    """
    w = F.col(wkt) if isinstance(wkt, str) else wkt
    polys = F.regexp_extract_all(w, F.lit(_POLY_RE), 1)

    def ring_points(ring_txt):
        pts = F.split(F.trim(ring_txt), r"\s*,\s*")
        return F.transform(pts, lambda p: F.named_struct(
            F.lit("x"), F.split(F.trim(p), r"\s+").getItem(0).try_cast("double"),
            F.lit("y"), F.split(F.trim(p), r"\s+").getItem(1).try_cast("double")))

    geom = F.transform(polys, lambda ptxt: F.transform(F.regexp_extract_all(ptxt, F.lit(_RING_RE), 1), ring_points))
    ok = w.rlike(r"^\s*(?i)(MULTI)?POLYGON\s*\(") & (F.size(geom) > 0)
    return F.when(ok, geom)


def _fmt(v: Column) -> Column:
    # integral doubles print without a fraction (as WKT writers do); others in Java's shortest form
    return F.when(v == F.floor(v), v.cast("long").cast("string")).otherwise(v.cast("string"))


def geom_to_wkt(geom: Column | str) -> Column:
    """Multipolygon array -> ``MULTIPOLYGON (((x y, ...)), ...)`` text."""
    g = F.col(geom) if isinstance(geom, str) else geom
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", _fmt(p.x), _fmt(p.y))), ", "), F.lit(")"))
    poly = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(g, poly), ", "), F.lit(")"))


def all_points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bbox_cols(geom: Column) -> dict[str, Column]:
    pts = all_points(geom)
    xs = F.transform(pts, lambda p: p.x)
    ys = F.transform(pts, lambda p: p.y)
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys),
            "vx": pts.getItem(0).x, "vy": pts.getItem(0).y}


def explode_segments(df: DataFrame, id_col: str, geom_col: str) -> DataFrame:
    """One row per ring edge: (id, no, x1, y1, x2, y2), numbered from 0 along the geometry's rings. Rings are walked
    cyclically, so open and closed rings both give every edge (a closed ring adds one zero-length edge, which changes no
    result)."""
    def ring_edges(r: Column) -> Column:
        nxt = F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1))
        return F.transform(F.arrays_zip(r.alias("a"), nxt.alias("b")), lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b")))

    rings = F.filter(F.flatten(F.col(geom_col)), lambda r: F.size(r) > 0)
    edges = df.select(id_col, F.posexplode(F.flatten(F.transform(rings, ring_edges))).alias("no", "_e"))
    return edges.select(id_col, F.col("no").cast("long").alias("no"), F.col("_e.a.x").alias("x1"), F.col("_e.a.y").alias("y1"),
                        F.col("_e.b.x").alias("x2"), F.col("_e.b.y").alias("y2"))


def segment_dist2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance from point to segment. Uses the cross product for the interior case, so integral
    inputs on axis-parallel edges give exact results (no cancellation, exact division)."""
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    dot = (px - x1) * dx + (py - y1) * dy
    cross = dx * (py - y1) - dy * (px - x1)
    to_a = (px - x1) * (px - x1) + (py - y1) * (py - y1)
    to_b = (px - x2) * (px - x2) + (py - y2) * (py - y2)
    return (F.when((len2 == 0) | (dot <= 0), to_a)
            .when(dot >= len2, to_b)
            .otherwise(F.try_divide(cross * cross, len2)))


def ray_crosses(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Even-odd rule: does a ray from the point towards +x cross this edge? (horizontal edges never do)."""
    straddles = (y1 > py) != (y2 > py)
    x_at = F.try_divide((x2 - x1) * (py - y1), (y2 - y1)) + x1
    return straddles & (px < x_at)


def point_bbox_dist2(px: Column, py: Column, xmin: Column, xmax: Column, ymin: Column, ymax: Column) -> Column:
    ddx = F.greatest(xmin - px, F.lit(0.0), px - xmax)
    ddy = F.greatest(ymin - py, F.lit(0.0), py - ymax)
    return ddx * ddx + ddy * ddy
