import pytest
from pyspark.sql import functions as F

from stratus.functions.geometry import geom_from_wkt, geom_to_wkt, segment_dist2, ray_crosses


@pytest.mark.parametrize("wkt,want", [
    ("MULTIPOLYGON (((-1.5 2e3, 3 4, 5 6, -1.5 2e3)))", "MULTIPOLYGON (((-1.5 2000, 3 4, 5 6, -1.5 2000)))"),
    ("polygon((0 0,1 0,1 1,0 0),(0.2 0.2, 0.3 0.2, 0.3 0.3, 0.2 0.2))",
     "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (0.2 0.2, 0.3 0.2, 0.3 0.3, 0.2 0.2)))"),
    ("  MULTIPOLYGON( ( (0 0, 1 0, 1 1, 0 0) ) , ( (5 5, 6 5, 6 6, 5 5) ) )",
     "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"),
    ("POINT (1 2)", None),
    ("LINESTRING (0 0, 1 1)", None),
    (None, None),
])
def test_wkt_variants(spark, wkt, want):
    df = spark.createDataFrame([(wkt,)], "wkt string")
    assert df.select(geom_to_wkt(geom_from_wkt("wkt")).alias("w")).first().w == want


def test_segment_kernel(spark):
    rows = [(0.0, 5.0, 0.0, 0.0, 10.0, 0.0, 25.0, False),   # above the middle of a horizontal edge
            (-3.0, 4.0, 0.0, 0.0, 10.0, 0.0, 25.0, False),  # beyond the start: distance to the start point
            (5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 0.0, False),     # degenerate edge
            (0.0, 0.5, 1.0, 0.0, 1.0, 1.0, 1.0, True)]      # ray towards +x crosses a vertical edge
    df = spark.createDataFrame(rows, "px double, py double, x1 double, y1 double, x2 double, y2 double, d2 double, c boolean")
    c = [F.col(n) for n in ("px", "py", "x1", "y1", "x2", "y2")]
    out = df.select(segment_dist2(*c).alias("got"), ray_crosses(*c).alias("cross"), "d2", "c").collect()
    for r in out:
        assert r.got == pytest.approx(r.d2) and r.cross == r.c
