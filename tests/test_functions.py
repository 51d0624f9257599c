import math

import pytest
from pyspark.sql import functions as F

from vesselflow.functions import geo
from vesselflow.functions import scalars as S

SQUARE = geo.rectangle(0, 0, 2, 2)
DENT = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.0], [0.0, 4.0], [0.0, 0.0]]


def ask(spark, ring, points):
    rows = spark.createDataFrame([(ring, float(x), float(y)) for x, y in points], "ring array<array<double>>, x double, y double")
    return [r[0] for r in rows.select(geo.covers(F.col("ring"), F.col("x"), F.col("y"))).collect()]


def test_covers_has_its_boundary(spark):
    assert ask(spark, SQUARE, [(1, 1), (0, 0), (2, 1), (1, 2), (2, 2), (2.0001, 1), (-1, 0), (3, 2)]) == [True] * 5 + [False] * 3
    assert ask(spark, DENT, [(2, 1), (2, 0.5), (2, 2), (0.5, 2), (3.5, 3), (1, 2.5), (1, 2.6)]) == [True, True, False, True, True, True, False]


def test_measures(spark):
    row = spark.createDataFrame([(SQUARE,)], "r array<array<double>>").select(
        geo.ring_area(F.col("r")).alias("a"), geo.centroid(F.col("r")).alias("c"), geo.envelope(F.col("r"), 0.5).alias("e"), geo.sphere_m(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("m")
    ).first()
    assert row.a == 4 and tuple(row.c) == (1, 1) and tuple(row.e) == (-0.5, -0.5, 2.5, 2.5)
    assert abs(row.m - math.pi * geo.EARTH_M / 180) < 1e-3 and abs(geo.sphere_m_of(0, 0, 1, 0) - row.m) < 1e-6
    assert abs(geo.local_m_of(0, 0, 0, 0.001) - 110.574) < 0.01 and abs(geo.local_m_of(0, 0, 0.001, 0) - 111.319) < 0.01


def test_angles_wrap(spark):
    rows = spark.createDataFrame([(359.5, 0.4), (10.0, 350.0), (0.0, 180.0)], "a double, b double").select(geo.angle_between(F.col("a"), F.col("b"))).collect()
    assert [round(r[0], 6) for r in rows] == [0.9, 20, 180]


def test_tiles(spark):
    def one(lon, lat, z):
        n = 2**z
        lat = max(-geo.MAX_LAT, min(geo.MAX_LAT, lat))
        y = (1 - math.log(math.tan(math.radians(lat)) + 1 / math.cos(math.radians(lat))) / math.pi) / 2 * n
        return int((lon + 180) / 360 * n), int(y)

    points = [(0.0, 0.0, 5), (-0.1, 51.5, 9), (179.9, -89.0, 6), (-180.0, 89.0, 6)]
    rows = spark.createDataFrame(points, "x double, y double, z int").select(geo.tile_x(F.col("x"), F.col("z")), geo.tile_y(F.col("y"), F.col("z"))).collect()
    assert [tuple(r) for r in rows] == [one(*p) for p in points]


def test_simplify_keeps_a_polygon():
    ring = [[0.0, 0.0], [1.0, 0.001], [2.0, 0.0], [2.0, 2.0], [1.0, 2.001], [0.0, 2.0], [0.0, 0.0]]
    assert geo.simplify_ring(ring, 0.01) == [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]
    assert len(geo.simplify_ring(geo.circle(5, 50, 10), 90)) >= 4
    far = [geo.sphere_m_of(5, 50, *p) for p in geo.circle(5, 50, 10)]
    assert max(far) - min(far) < 1e-3 and abs(far[0] - 18520) < 1e-3


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (S.to_text, {" a ": "a", "  ": None, None: None}),
        (S.to_number, {" 1e2 ": 100.0, "x": None, None: None, "": None}),
        (S.to_whole, {"5.9": 5, "-5.9": -5, "1e3": 1000, "x": None}),
        (S.to_strict_whole, {"5": 5, "+5": 5, "-1": -1, "5.5": None, "x": None, " 7 ": 7}),
        (S.for_hash, {" aB ": "AB", "NaN": "", "none": "", None: ""}),
    ],
)
def test_casts(spark, function, cases):
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select(function(F.col("x"))).collect()
    assert [r[0] for r in rows] == list(cases.values())


def test_buckets(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:59.5' AS t").select(S.bucket(F.col("t"), 5).alias("b"), S.day(F.col("t")).alias("d")).first()
    assert (str(row.b), str(row.d)) == ("2024-01-02 03:00:00", "2024-01-02 00:00:00")
