"""Membership of fixes in geofences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.functions import geo

#: Membership columns: (condition on the geofence, name).
CORE, APPROACH, LANE = "kind = 'port' AND subtype = 'core'", "kind = 'port' AND subtype = 'approach'", "subtype = 'corridor'"


#: Parts of a degree cell's side.
PARTS = 8
#: Cells are tested this much larger, so that rounding puts no point into a cell that a side has just missed.
_SLACK = 1e-9
OUTSIDE, INSIDE, BORDER = 0, 1, 2


def _box(x: Column, y: Column, size: float) -> Column:
    return F.struct((x - _SLACK).alias("xmin"), (y - _SLACK).alias("ymin"), (x + size + _SLACK).alias("xmax"), (y + size + _SLACK).alias("ymax"))


def _kind(sides: Column, x: Column, y: Column, size: float) -> Column:
    """Of a cell: whether a side touches it, else what its middle is."""
    touched = F.exists(sides, lambda e: geo.touches(e, _box(x, y, size)))
    return F.when(touched, BORDER).when(geo.covered_by(sides, x + size / 2, y + size / 2), INSIDE).otherwise(OUTSIDE)


def cell_index(areas: DataFrame, gates: DataFrame) -> DataFrame:
    """_cx, _cy, and per kind of membership the geofences that have to do with the degree cell, smallest first (ties by id).

    A cell that lies wholly in a geofence is marked so and needs no test of sides. One that its border crosses is cut
    into PARTS x PARTS parts, inside, outside or border again, and a border part has only the sides that a ray to the
    east from a point in it can meet. All rings count, so what lies in a hole lies outside.
    """
    role = F.when(F.expr(CORE), "core").when(F.expr(APPROACH), "approach").when(F.expr(LANE), "lane")
    rows = areas.select(F.col("area_id").alias("id"), role.alias("role"), F.lit(None).cast("string").alias("side"), "rings")
    rows = rows.unionByName(gates.select(F.col("gate_id").alias("id"), F.lit("gate").alias("role"), F.regexp_extract("subtype", "^gate_(west|east|north|south)$", 1).alias("side"), "rings"))
    rows = rows.where("role IS NOT NULL").withColumns({"box": geo.envelope(F.col("rings")[0]), "area": geo.area(F.col("rings")), "sides": geo.all_edges(F.col("rings"))})
    span = lambda a, b: F.sequence(F.floor(f"box.{a}").cast("int"), F.floor(f"box.{b}").cast("int"))
    cells = rows.withColumn("_cx", F.explode(span("xmin", "xmax"))).withColumn("_cy", F.explode(span("ymin", "ymax")))
    cells = cells.withColumn("kind", _kind(F.col("sides"), F.col("_cx"), F.col("_cy"), 1.0)).where(F.col("kind") != OUTSIDE)
    # Only these sides meet a ray to the east from within the cell; for the others what is even or odd doesn't change.
    near = lambda sides, x, y, size: F.filter(sides, lambda e: _ahead(e, x, y, size))
    cells = cells.withColumn("sides", F.when(F.col("kind") == BORDER, near(F.col("sides"), F.col("_cx"), F.col("_cy"), 1.0)))
    size = 1.0 / PARTS

    def part(k: Column) -> Column:
        x, y = F.col("_cx") + F.pmod(k, F.lit(PARTS)) * size, F.col("_cy") + F.floor(k / PARTS) * size
        kind = _kind(F.col("sides"), x, y, size)
        return F.struct(kind.alias("kind"), F.when(kind == BORDER, near(F.col("sides"), x, y, size)).alias("sides"))

    cells = cells.withColumn("parts", F.when(F.col("kind") == BORDER, F.transform(F.sequence(F.lit(0), F.lit(PARTS * PARTS - 1)), part)))
    one = F.struct("area", "id", "side", "kind", "parts")
    of = lambda r: F.sort_array(F.collect_list(F.when(F.col("role") == r, one))).alias(f"_{r}")
    return cells.groupBy("_cx", "_cy").agg(of("core"), of("approach"), of("lane"), of("gate"))


def _ahead(e: Column, x: Column, y: Column, size: float) -> Column:
    """Whether a side reaches into the rows of a cell, at it or east of it."""
    ax, ay, bx, by = (F.get(e[p], F.lit(i)) for p in ("a", "b") for i in (0, 1))
    return (F.greatest(ay, by) >= y - _SLACK) & (F.least(ay, by) <= y + size + _SLACK) & (F.greatest(ax, bx) >= x - _SLACK)


def part_of(lon: Column, lat: Column) -> Column:
    """Number of the point's part in its degree cell."""
    at = lambda c: F.least(F.floor((c - F.floor(c)) * PARTS), F.lit(PARTS - 1)).cast("int")
    return at(lat) * PARTS + at(lon)


def _smallest(name: str) -> Column:
    """First geofence of the cell that covers the fix."""
    lon, lat = F.col("lon"), F.col("lat")

    def hit(g: Column) -> Column:
        part = F.get(g["parts"], F.col("_part"))
        return F.when((g["kind"] == INSIDE) | (part["kind"] == INSIDE), True).when(part["kind"] == BORDER, geo.covered_by(part["sides"], lon, lat)).otherwise(False)

    return F.get(F.filter(name, hit), F.lit(0))


def label(fixes: DataFrame, areas: DataFrame, gates: DataFrame) -> DataFrame:
    """`fixes` with area_id_core, area_id_approach, lane_id, gate_id, gate_end and in_core, in_approach, in_lane.

    Every fix meets the one row of its degree cell, so no fix is repeated or shuffled to be brought together again; the
    index is small and Spark broadcasts it while it is under the session's threshold.
    """
    keyed = fixes.withColumns({"_cx": F.floor("lon").cast("int"), "_cy": F.floor("lat").cast("int"), "_part": part_of(F.col("lon"), F.col("lat"))})
    joined = keyed.join(cell_index(areas, gates), ["_cx", "_cy"], "left")
    found = joined.withColumns({f"_{r}": _smallest(f"_{r}") for r in ("core", "approach", "lane", "gate")})
    found = found.withColumns(
        {
            "area_id_core": F.col("_core.id"),
            "area_id_approach": F.col("_approach.id"),
            "lane_id": F.col("_lane.id"),
            "gate_id": F.col("_gate.id"),
            "gate_end": F.nullif(F.col("_gate.side"), F.lit("")),
        }
    ).drop("_cx", "_cy", "_part", "_core", "_approach", "_lane", "_gate")
    return found.withColumns({"in_core": F.col("area_id_core").isNotNull(), "in_approach": F.col("area_id_approach").isNotNull(), "in_lane": F.col("lane_id").isNotNull()})
