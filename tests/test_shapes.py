"""Polygons with holes and many sides against brute force, resampled shapes, tables by their footers, counts as rows pass."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from vesselflow.functions import geo
from vesselflow.operators import dedup, label
from vesselflow.plans import dashboard, refresh
from vesselflow.sources import fixture, geofence, payload

from .test_vessels import T0, vendor


def inside(rings, x, y):
    """Even-odd over all rings, borders included, with plain numbers."""
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
                odd = not odd
    return odd


def blob(x, y, r, n, rng):
    pts = [[x + r * rng.uniform(0.6, 1.0) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.6, 1.0) * math.sin(2 * math.pi * k / n)] for k in range(n)]
    return [*pts, pts[0]]


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(4)
    box = geo.rectangle
    return {
        "many": [blob(-3.2, 1.7, 2.9, 1000, rng)],
        "holes": [box(-8, -6, 7, 6), box(-5, -4, -1, 3), box(2, 1, 3, 2), blob(4.5, -2.5, 1.5, 40, rng)],
        "thin": [box(10.25, -1, 10.26, 3)],
        "cell": [box(12, 2, 14, 4)],  # its sides lie on cells' borders
    }


def test_labels_equal_brute_force_with_fewer_side_tests(spark, shapes):
    rng = random.Random(9)
    points = [(rng.uniform(-9, 15), rng.uniform(-7, 7)) for _ in range(3000)]
    points += [tuple(p) for r in shapes.values() for ring in r for p in ring[:30]]
    points += [(float(x), float(y)) for x in range(-9, 16) for y in range(-7, 8)] + [(x / 8, y / 8) for x in range(80, 116, 3) for y in range(-10, 34, 5)]
    points += [(-1e-20, 0.5), (0.5, -1e-20), (12.0, 3.0), (14.0, 4.0), (14.0 + 1e-12, 3.0)]
    fixes = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "arrival_seq long, lon double, lat double")
    none = spark.createDataFrame([], geofence.GATE)
    for name, rings in shapes.items():
        areas = spark.createDataFrame([(name, name, "port", "core", None, None, rings, None)], geofence.AREA)
        got = {r.arrival_seq: r.in_core for r in label.label(fixes, areas, none).collect()}
        assert [i for i, p in enumerate(points) if got[i] != inside(rings, *p)] == []
        if name == "many":
            index = label.cell_index(areas, none).select("_cx", "_cy", F.col("_core")[0].alias("g"))
            keyed = fixes.select(F.floor("lon").cast("int").alias("_cx"), F.floor("lat").cast("int").alias("_cy"), label.part_of(F.col("lon"), F.col("lat")).alias("p")).join(index, ["_cx", "_cy"], "left")
            tests = keyed.agg(F.sum(F.coalesce(F.size(F.get("g.parts", F.col("p"))["sides"]), F.lit(0)))).first()[0]
            assert 0 < tests < 0.02 * 1000 * len(points)


def test_the_smallest_area_counts_its_holes(spark):
    """A ring with a great hole is smaller than a box that is smaller than the ring's outline."""
    box = geo.rectangle
    rows = [("ring", [box(0, 0, 10, 10), box(1, 1, 9.9, 9.9)]), ("box", [box(0, 0, 6, 6)])]
    areas = spark.createDataFrame([(i, i, "port", "core", None, None, r, None) for i, r in rows], geofence.AREA)
    fixes = spark.createDataFrame([(0, 0.5, 0.5), (1, 5.0, 5.0), (2, 9.95, 5.0), (3, 8.0, 8.0), (4, 1.0, 5.0)], "n long, lon double, lat double")
    got = label.label(fixes, areas, spark.createDataFrame([], geofence.GATE)).orderBy("n").collect()
    assert [r.area_id_core for r in got] == ["ring", "box", "ring", None, "ring"]  # a hole's border is covered


def test_resampled_shapes(spark):
    rng = random.Random(6)
    ring = blob(103.5, 1.2, 0.4, 17, rng)
    frame = spark.createDataFrame([(ring,)], "ring array<array<double>>")
    x, y = (sum(p[i] for p in ring[:-1]) / 17 for i in (0, 1))
    radius = sum(geo.sphere_m_of(x, y, *p) for p in ring[:-1]) / 17
    got = frame.select(geo.mean_radius_m(F.col("ring")), geo.resampled(F.col("ring"), 48), geo.resampled(F.col("ring"), 2), geo.resampled(F.col("ring"), 900)).first()
    assert abs(got[0] - radius) < 1e-6 * radius
    assert [len(r) for r in got[1:]] == [49, 4, 201] and got[1][0] == got[1][-1]
    assert all(abs(geo.sphere_m_of(x, y, *p) - radius) < 1e-6 * radius for p in got[1])
    want = geo.circle(x, y, radius / 1852, 48)
    assert max(math.dist(p, q) for p, q in zip(got[1], want)) < 1e-9
    assert geo.slab_at_lon(3.0, -1, 1, 0.2)[:3] == [[2.9, -1.0], [3.1, -1.0], [3.1, 1.0]] and geo.slab_at_lat(5.0, 1, 2, 0.5)[0] == [1.0, 4.75]


def test_catalog_by_footers(spark, tmp_path):
    rows = spark.createDataFrame([(T0 + dt.timedelta(hours=h), f"v{h % 5}") for h in range(60)], "ts timestamp_ntz, vessel_uid string")
    refresh.append_fact(rows, f"file://{tmp_path}/facts")
    rows.limit(7).write.parquet(f"file://{tmp_path}/small")
    rows.where("false").coalesce(1).write.parquet(f"file://{tmp_path}/empty")
    rows.limit(2).write.option("compression", "gzip").mode("append").parquet(f"file://{tmp_path}/small")
    got = {r.table: r for r in refresh.catalog(spark, f"file://{tmp_path}").collect()}
    assert {t: (r["rows"], r.days, r.codec) for t, r in got.items()} == {"facts": (60, 3, "zstd"), "small": (9, 1, None), "empty": (0, 0, None if got["empty"].codec is None else "snappy")}
    assert got["facts"].total_bytes == sum(f.stat().st_size for f in (tmp_path / "facts").rglob("*.parquet"))
    plan = refresh.catalog(spark, f"file://{tmp_path}")._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan.replace("BinaryFile", "binaryFile") and "content" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_counts_are_taken_as_rows_pass(spark, tmp_path):
    docs = [(json.dumps({"data": {"rows": [vendor(MMSI="1", LAT=str(d + i / 100)) for i in range(3)] + [vendor(SHIPTYPE="70")]}}), T0 + dt.timedelta(hours=5 * d), str(d)) for d in range(4)]
    docs += [("busy", T0, "x"), (json.dumps({"data": {"rows": []}}), T0, "y")]
    documents = spark.createDataFrame(docs, "value string, fetch_ts timestamp, path string")
    areas, gates = fixture.areas(spark), fixture.gates(spark)

    def follow(rows):
        return dedup.dedup(label.label(payload.with_arrival(rows, documents), areas, gates))

    got = dashboard.observed_run(documents, follow, lambda rows: refresh.append_fact(rows, f"file://{tmp_path}/fixes"))
    inserted = spark.read.parquet(f"file://{tmp_path}/fixes").count()
    assert got == {"tiles": 6, "tiles_ok": 5, "received": 16, "kept": 12, "inserted": inserted} and 0 < inserted < 12
