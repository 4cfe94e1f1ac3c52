"""Nearest station per postal area (``CROSS JOIN LATERAL ... ORDER BY ST_Distance LIMIT k``) without a
cross join.

Exact search in three steps, each a chain of equi-joins:

1. **Station cells.** Stations are counted in a pyramid of grid cells (8 x 8, then 4 x 4 children a cell), each
   with the box its stations span. Areas descend from the top: a cell stays with an area unless its box is farther
   from the area's box than the k-th station can be (the farthest corner of the cells nearest to a vertex
   of the area). An area stops at the level whose cells are as wide as a quarter of its own box, or at the finest, so
   it holds a bounded number of cells around its box whatever its size, and a far cluster of stations is one cell
   to it. Only then are the stations of the cells met, and pruned the same way.
2. **Inside or not.** The edges of an area are placed in bands of y, as many as keep two entries an edge on average.
   A station in the area's box meets the edges of its band only: an odd number of crossings, or an edge through
   the station, is distance 0 (holes and parts included). An area with k such stations is done: the lowest ids win.
3. **Edge blocks.** For the other areas the distance to the boundary is found by descending blocks of consecutive
   edges (16 a block, 16 blocks a block, ...) with their boxes and first vertices: a station and a block stay while
   the block may hold the k-th distance of the area. At the bottom are the edges themselves.

Step 1's loop runs over levels (about log4 of the station grid), step 3's over log16 of the largest edge number; no loop runs
over rows. Results of a level are written under the shared checkpoint folder (bounded lineage, survives lost executors).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.geometry import bbox_cols, explode_segments, point_bbox_dist2, ray_crosses, segment_dist2
from stratus.operators.joins import by_rows, few_rows, fits
from stratus.session import checkpoint_dir, materialize

ROOT, FAN_BITS = 8, 2  # cells a side at the top, and bits of a cell's number per level (4 a side)
MOST_LEVELS = 12
BLOCK = 16  # edges, or blocks, of a block
SLACK = 1 + 1e-12  # of squared bounds, for rounding
BOX = ("xmin", "xmax", "ymin", "ymax")


def _box_dist2(bx0: Column, bx1: Column, by0: Column, by1: Column) -> Column:
    """Squared distance between the row's box and another one."""
    dx = F.greatest(F.col("xmin") - bx1, F.lit(0.0), bx0 - F.col("xmax"))
    dy = F.greatest(F.col("ymin") - by1, F.lit(0.0), by0 - F.col("ymax"))
    return dx * dx + dy * dy


def _farthest2(x: Column, y: Column, bx0: Column, bx1: Column, by0: Column, by1: Column) -> Column:
    dx, dy = F.greatest(F.abs(x - bx0), F.abs(bx1 - x)), F.greatest(F.abs(y - by0), F.abs(by1 - y))
    return dx * dx + dy * dy


def _kth_smallest(df: DataFrame, key: str, val: str, k: int, out: str) -> DataFrame:
    """Per key, the k-th smallest ``val`` (none when fewer than k): top-k window (planned with a
    partial WindowGroupLimit before the shuffle) then a max."""
    if k == 1:
        return df.groupBy(key).agg(F.min(val).alias(out))
    w = Window.partitionBy(key).orderBy(F.col(val).asc(), F.col("sid").asc())
    top = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.groupBy(key).agg(F.max(F.when(F.col("_r") == k, F.col(val))).alias(out))


# ------------------------------------------------------------------------------------------ 1: station cells
def _station_cells(stations: DataFrame, levels: int) -> DataFrame:
    """``lv, ix, iy, n`` and the stations' box, of every cell that holds stations; level ``levels`` is the finest."""
    lv = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("lv")
    return _at_level(stations.select("x", "y", "ix", "iy", lv), levels).groupBy("lv", "ix", "iy").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("cx0"), F.max("x").alias("cx1"), F.min("y").alias("cy0"),
        F.max("y").alias("cy1"))


def _at_level(df: DataFrame, levels: int) -> DataFrame:
    """``ix, iy`` of the finest level as those of level ``lv``."""
    shift = (F.lit(levels) - F.col("lv")) * FAN_BITS
    return df.withColumns({c: F.call_function("shiftright", F.col(c), shift) for c in ("ix", "iy")})


def _cells_for_areas(front: DataFrame, cells: DataFrame, level: int, k: int) -> DataFrame:
    """One level down: the cells of ``level`` below the areas' cells, without those that are too far."""
    up = (lambda c: F.lit(0)) if level == 0 else (lambda c: F.shiftright(c, FAN_BITS))
    below = cells.filter(F.col("lv") == level).withColumns({"px": up("ix").cast("long"), "py": up("iy").cast("long")}).drop("lv")
    # of a level's cells, never of what the areas hold of them, a copy goes to every task
    few = fits(ROOT ** 2 << 2 * FAN_BITS * level) or few_rows(cells)
    met = front.join(F.broadcast(below), ["px", "py"]) if few else by_rows(front).join(below, ["px", "py"])
    corners = [F.col(c) for c in ("cx0", "cx1", "cy0", "cy1")]
    met = met.withColumns({"lb2": _box_dist2(*corners), "ub2": _farthest2(F.col("vx"), F.col("vy"), *corners)})
    # the cells nearest by their farthest corner that hold k stations between them; an area has few cells
    if k == 1:
        bound = F.min("ub2").over(Window.partitionBy("aid"))
    else:
        upto = Window.partitionBy("aid").orderBy("ub2", "ix", "iy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = met.withColumn("_held", F.sum("n").over(upto))
        bound = F.min(F.when(F.col("_held") >= k, F.col("ub2"))).over(Window.partitionBy("aid"))
    met = met.withColumn("_bound", bound).filter(F.col("_bound").isNull() | (F.col("lb2") <= F.col("_bound") * SLACK))
    return met.select("aid", *BOX, "vx", "vy", "leaf", F.col("ix").alias("px"), F.col("iy").alias("py"))


def _candidates(areas: DataFrame, stations: DataFrame, levels: int, k: int, prune: bool) -> DataFrame:
    """``aid, sid, x, y, lb2`` (squared distance to the area's box): a superset of each area's k nearest."""
    cells = materialize(_station_cells(stations, levels), "link_cells")
    front = areas.withColumns({"px": F.lit(0).cast("long"), "py": F.lit(0).cast("long")})
    leaves = None
    deepest = areas.agg(F.max("leaf")).first()[0]
    for level in range((deepest or 0) + 1):
        front = materialize(_cells_for_areas(front, cells, level, k), "link_front")
        own = front.filter(F.col("leaf") == level)
        leaves = own if leaves is None else leaves.unionByName(own)
        front = front.filter(F.col("leaf") > level)
    lv = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("lv")
    placed = _at_level(stations.select("sid", "x", "y", "ix", "iy", lv), levels).select(
        "sid", "x", "y", F.col("lv").alias("leaf"), F.col("ix").alias("px"), F.col("iy").alias("py"))
    there = cells.filter(F.col("lv") == 0).agg(F.sum("n")).first()[0] or 0
    met = leaves.join(F.broadcast(placed), ["leaf", "px", "py"]) if fits(there * (levels + 1)) \
        else by_rows(leaves).join(placed, ["leaf", "px", "py"])
    pairs = met.withColumn(
        "lb2", point_bbox_dist2(F.col("x"), F.col("y"), *(F.col(c) for c in BOX)))
    if not prune:
        return materialize(pairs.select("aid", "sid", "x", "y", "lb2"), "link_pairs")
    vertex2 = (F.col("x") - F.col("vx")) ** 2 + (F.col("y") - F.col("vy")) ** 2
    pairs = materialize(pairs.select("aid", "sid", "x", "y", "lb2", vertex2.alias("ub2")), "link_pairs")
    kth = _kth_smallest(pairs, "aid", "ub2", k, "kub2")
    kept = pairs.join(kth, "aid").filter(F.col("kub2").isNull() | (F.col("lb2") <= F.col("kub2") * SLACK))
    return kept.select("aid", "sid", "x", "y", "lb2")


# ------------------------------------------------------------------------------------------ 2: bands of y
def _band(y: Column) -> Column:
    return F.when(F.col("bh") > 0, F.floor((y - F.col("y0")) / F.col("bh"))).otherwise(F.lit(0)).cast("long")


def _band_sizes(edges: DataFrame) -> DataFrame:
    """``aid, y0, bh``: where an area's bands begin and how high they are."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    per = edges.groupBy("aid").agg(F.min(low).alias("y0"), (F.max(high) - F.min(low)).alias("h"),
                                   F.sum(high - low).alias("v"), F.count(F.lit(1)).alias("e"))
    bands = F.greatest(F.ceil(F.try_divide(2 * F.col("e") * F.col("h"), F.col("v"))), F.lit(1))
    return per.select("aid", "y0", F.coalesce(F.col("h") / bands, F.lit(0.0)).alias("bh"))


def _meet_bands(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Each (area, station) pair with the edges of the station's band."""
    sizes = _band_sizes(edges)
    b1, b2 = _band(F.col("y1")), _band(F.col("y2"))
    placed = by_rows(edges).join(sizes, "aid").select("aid", "x1", "y1", "x2", "y2",
                                                      F.explode(F.sequence(F.least(b1, b2), F.greatest(b1, b2))).alias("band"))
    own = pairs.join(sizes, "aid").select("aid", "sid", "x", "y", _band(F.col("y")).alias("band"))
    return own.join(by_rows(placed, edges), ["aid", "band"])


def _at_zero(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``aid, sid`` of the pairs whose station is inside its area or on an edge of it."""
    line = [F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]
    per = _meet_bands(pairs, edges).groupBy("aid", "sid").agg(
        F.sum(ray_crosses(*line).cast("int")).alias("nx"), F.min(segment_dist2(*line)).alias("e2"))
    return per.filter((F.col("nx") % 2 == 1) | (F.col("e2") == 0)).select("aid", "sid")


# ------------------------------------------------------------------------------------------ 3: blocks of edges
def _boundary_dist2(pairs: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """``aid, sid, d2`` to the area's boundary, for a superset of the k nearest stations of each area."""
    most = edges.agg(F.max("no")).first()[0]
    top = 0
    while most is not None and BLOCK ** (top + 1) <= most:
        top += 1
    front = pairs.select("aid", "sid", "x", "y", F.lit(0).cast("long").alias("up"))
    point = F.col("x"), F.col("y")
    for level in range(top, 0, -1):
        own = F.floor(F.col("no") / BLOCK ** level)
        blocks = edges.groupBy("aid", own.alias("b")).agg(
            F.min(F.least("x1", "x2")).alias("bx0"), F.max(F.greatest("x1", "x2")).alias("bx1"),
            F.min(F.least("y1", "y2")).alias("by0"), F.max(F.greatest("y1", "y2")).alias("by1"),
            F.min_by(F.struct("x1", "y1"), "no").alias("first"))
        blocks = blocks.withColumn("up", F.floor(F.col("b") / BLOCK) if level < top else F.lit(0).cast("long"))
        to_first = (F.col("x") - F.col("first.x1")) ** 2 + (F.col("y") - F.col("first.y1")) ** 2
        met = materialize(front.join(blocks, ["aid", "up"]).select(
            "aid", "sid", "x", "y", "b", point_bbox_dist2(*point, *(F.col(c) for c in ("bx0", "bx1", "by0", "by1"))).alias("lb2"),
            to_first.alias("ub2")), "link_blocks")
        reach = met.groupBy("aid", "sid").agg(F.min("ub2").alias("ub2"))
        kth = _kth_smallest(reach, "aid", "ub2", k, "kub2")
        front = met.join(kth, "aid").filter(F.col("kub2").isNull() | (F.col("lb2") <= F.col("kub2") * SLACK)) \
            .select("aid", "sid", "x", "y", F.col("b").alias("up"))
    last = edges.withColumn("up", F.floor(F.col("no") / BLOCK) if top else F.lit(0).cast("long"))
    line = [F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]
    return front.join(by_rows(last, edges), ["aid", "up"]).groupBy("aid", "sid").agg(F.min(segment_dist2(*line)).alias("d2"))


def nearest_link(areas: DataFrame, stations: DataFrame, *, area_id: str = "id", area_geom: str = "geometry",
                 station_id: str = "id", station_geom: str = "geometry", k: int = 1,
                 cell_size: float | None = None, prune: bool = True,
                 materialize_inputs: bool = True) -> DataFrame:
    """Return (postal_area_id, station_id, distance, rank) for the k nearest stations of every area.

    Areas without any station get no row (inner LATERAL semantics). Ties break on the lower station id.
    ``materialize_inputs=False`` when both inputs are already written tables (saves a write). ``cell_size``: the
    finest station cells are at most this wide (default: two stations a cell on average). ``prune=False``: the stations
    of all cells around an area are measured.
    """
    spark = areas.sparkSession
    checkpoint_dir(spark)
    G = areas.filter(F.col(area_geom).isNotNull()).select(F.col(area_id).alias("aid"), F.col(area_geom).alias("g"))
    S = (stations.filter(F.col(station_geom).isNotNull())
         .select(F.col(station_id).alias("sid"), F.col(station_geom).x.alias("x"), F.col(station_geom).y.alias("y"))
         .filter(F.col("x").isNotNull() & F.col("y").isNotNull()))
    if k == 1:
        # co-located stations are equally near to everything: only the lowest id can win
        S = S.groupBy("x", "y").agg(F.min("sid").alias("sid"))
    else:  # of them only the k lowest ids
        place = Window.partitionBy("x", "y").orderBy("sid")
        S = S.withColumn("_r", F.row_number().over(place)).filter(F.col("_r") <= k).drop("_r")
    if materialize_inputs:
        G = materialize(G, "link_areas")
        S = materialize(S, "link_stations")
    boxes = G.select("aid", *[v.alias(n) for n, v in bbox_cols(F.col("g")).items()]).filter(F.col("xmin").isNotNull())

    span = S.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
                 F.count(F.lit(1)).alias("n")).first()
    if not span["n"]:
        return spark.createDataFrame([], "postal_area_id long, station_id long, distance double, rank int")
    extent = max(span["x1"] - span["x0"], span["y1"] - span["y0"], 1e-9)
    finest = cell_size or extent / math.sqrt(span["n"] / 2)
    levels = min(max(math.ceil(math.log(max(extent / (ROOT * finest), 1e-9), 2 ** FAN_BITS)), 0), MOST_LEVELS)
    side = ROOT * 2 ** (FAN_BITS * levels)
    S = S.withColumns({i: F.least(F.floor((F.col(c) - F.lit(span[c0])) * F.lit(side / extent)), F.lit(side - 1)).cast("long")
                       for i, c, c0 in (("ix", "x", "x0"), ("iy", "y", "y0"))})
    width = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    # the finest level with cells at least a quarter as wide as the area
    leaf = F.floor(F.log2(F.lit(4 * extent / ROOT) / width) / FAN_BITS)
    leaf = F.when(width > 0, F.greatest(F.least(leaf, F.lit(levels)), F.lit(0))).otherwise(F.lit(levels)).cast("int")
    boxes = materialize(boxes.withColumn("leaf", leaf), "link_boxes")
    edges = materialize(explode_segments(G, "aid", "g"), "link_edges")

    pairs = materialize(_candidates(boxes, S, levels, k, prune), "link_candidates")
    zero = materialize(_at_zero(pairs.filter(F.col("lb2") == 0), edges), "link_zero")
    done = zero.groupBy("aid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    rest = pairs.join(done, "aid", "left_anti").join(by_rows(zero), ["aid", "sid"], "left_anti")
    found = zero.withColumn("d2", F.lit(0.0)).unionByName(_boundary_dist2(rest, edges, k))
    w = Window.partitionBy("aid").orderBy(F.col("d2").asc(), F.col("sid").asc())
    ranked = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(F.col("aid").alias("postal_area_id"), F.col("sid").alias("station_id"),
                         F.sqrt("d2").alias("distance"), F.col("rank").cast("int").alias("rank"))
