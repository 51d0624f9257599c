"""Geofences: loading from GeoJSON, upserts, gate links and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.functions import geo

AREA = "area_id string, name string, kind string, subtype string, group string, notes string, rings array<array<array<double>>>, flow_role string"
GATE = "gate_id string, area_id string, name string, kind string, subtype string, group string, notes string, rings array<array<array<double>>>"
FEATURE = "type string, properties struct<name: string, kind: string, subtype: string, group: string, notes: string>, geometry struct<type: string, coordinates: array<array<array<double>>>>"

#: Ports by the direction of their cargo.
EXPORT_NAMES = (
    "LOOP - core",
    "Corpus Christi - core",
    "Arthur - core",
    "Houston - core",
    "LOOP - approach",
    "Corpus Christi - approach",
    "Arthur - approach",
    "Houston - approach",
    "Ras Tanura - core",
    "Fujairah - core",
    "Basrah",
    "Ras Tanura - approach",
    "Fujairah - approach",
)
IMPORT_NAMES = (
    "Wilhelmshaven - core",
    "Amsterdam - core",
    "Antwerp - core",
    "Rotterdam - core",
    "Wilhelmshaven - approach",
    "Amsterdam - approach",
    "Antwerp - approach",
    "Rotterdam - approach",
)

#: What the tables accept.
AREA_KINDS = ("port", "lane", "chokepoint", "sts")
AREA_SUBTYPES = ("core", "approach", "corridor")
GATE_SUBTYPES = ("gate_west", "gate_east", "gate_north", "gate_south")
FLOW_ROLES = ("export", "import", "mixed")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of a FeatureCollection or of a plain array of features: pos, name, kind, subtype, group, notes, type, rings, is_gate."""
    docs = spark.read.text(path, wholetext=True).select(F.trim("value").alias("doc"))
    one = F.from_json("doc", f"array<struct<{FEATURE}>>")
    many = F.from_json("doc", f"struct<features: array<struct<{FEATURE}>>>")["features"]
    rows = docs.select(F.posexplode(F.when(F.col("doc").startswith("["), one).otherwise(many)).alias("pos", "f"))
    p = lambda k: F.trim(F.col(f"f.properties.{k}"))
    return rows.select(
        "pos",
        *(p(k).alias(k) for k in ("name", "kind", "subtype")),
        F.nullif(p("group"), F.lit("")).alias("group"),
        F.nullif(p("notes"), F.lit("")).alias("notes"),
        F.col("f.geometry.type").alias("type"),
        F.col("f.geometry.coordinates").alias("rings"),
        F.coalesce(p("subtype").like("gate_%"), F.lit(False)).alias("is_gate"),
    )


def _first(rows: DataFrame, key: str) -> DataFrame:
    """One row per key; of several, the first by subtype, then by place in the file."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.col("subtype").asc_nulls_last(), "pos"))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def flow_role(name: Column) -> Column:
    return F.when(name.isin(*EXPORT_NAMES), "export").when(name.isin(*IMPORT_NAMES), "import")


def link_gates(gates: DataFrame, areas: DataFrame) -> DataFrame:
    """Gates with area_id: the corridor of their kind and group (null groups match); null where there is none."""
    parent = areas.where("subtype = 'corridor'").groupBy("kind", "group").agg(F.min("area_id").alias("area_id"))
    g, p = gates.drop("area_id").alias("g"), parent.alias("p")
    same = (F.col("g.kind") == F.col("p.kind")) & F.col("g.group").eqNullSafe(F.col("p.group"))
    return g.join(p, same, "left").select("g.*", "p.area_id")


def load_geofences(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(areas, gates) of a file; only polygons are taken, gates without a corridor are left out."""
    rows = read_features(spark, path).where("type = 'Polygon'").withColumn("id", F.concat("name", F.lit(" // "), "kind"))
    areas = _first(rows.where("NOT is_gate").withColumnRenamed("id", "area_id"), "area_id")
    areas = areas.select("area_id", "name", "kind", "subtype", "group", "notes", "rings", flow_role(F.col("name")).alias("flow_role"))
    gates = _first(rows.where("is_gate").withColumnRenamed("id", "gate_id"), "gate_id").select("gate_id", "name", "kind", "subtype", "group", "notes", "rings")
    linked = link_gates(gates, areas).where("area_id IS NOT NULL")
    return areas, linked.select("gate_id", "area_id", "name", "kind", "subtype", "group", "notes", "rings")


def upsert(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """`old` with the rows of `new` put in by key; columns in `keep` stay as they are in rows that exist."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    fresh, known = F.col(f"n.{key}").isNotNull(), F.col(f"o.{key}").isNotNull()

    def value(c: str) -> Column:
        if c not in new.columns or c in keep:
            fallback = F.col(f"n.{c}") if c in new.columns else F.lit(None)
            return F.when(known, F.col(f"o.{c}")).otherwise(fallback)
        return F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return joined.select(*(value(c).alias(c) for c in old.columns))


def seed_summary(areas: DataFrame, gates: DataFrame) -> DataFrame:
    """what, num: areas, gates, gates with and without a corridor. gates: before they are linked."""
    linked = link_gates(gates, areas)
    count = lambda df, what: df.agg(F.count("*").alias("num")).select(F.lit(what).alias("what"), "num")
    parts = [count(areas, "areas_inserted"), count(gates, "gates_total")]
    parts += [count(linked.where("area_id IS NOT NULL"), "gates_linked"), count(linked.where("area_id IS NULL"), "gates_unmatched")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations(areas: DataFrame, gates: DataFrame) -> DataFrame:
    """table, id, problem of the rows that the tables don't accept; nulls pass."""
    bad = lambda c, ok: F.coalesce(~F.col(c).isin(*ok), F.lit(False))
    a = areas.select(F.lit("area").alias("table"), F.col("area_id").alias("id"), F.when(bad("kind", AREA_KINDS), "kind").when(bad("subtype", AREA_SUBTYPES), "subtype").when(bad("flow_role", FLOW_ROLES), "flow_role").alias("problem"))
    g = gates.select(F.lit("gate").alias("table"), F.col("gate_id").alias("id"), F.when(bad("kind", AREA_KINDS), "kind").when(bad("subtype", GATE_SUBTYPES), "subtype").alias("problem"))
    orphans = gates.join(areas, "area_id", "left_anti").select(F.lit("gate").alias("table"), F.col("gate_id").alias("id"), F.lit("area_id").alias("problem"))
    return a.unionByName(g).where("problem IS NOT NULL").unionByName(orphans)


def uncontained_cores(areas: DataFrame) -> DataFrame:
    """area_id, group of the cores that no approach of their group holds all corners of, where the group has approaches."""
    core = areas.where("subtype = 'core' AND group IS NOT NULL").select("area_id", "group", F.col("rings")[0].alias("ring"))
    around = areas.where("subtype = 'approach'").select("group", F.col("rings")[0].alias("outer"))
    inside = F.forall("ring", lambda p: geo.covers(F.col("outer"), F.get(p, F.lit(0)), F.get(p, F.lit(1))))
    return core.join(around, "group").withColumn("ok", inside).groupBy("area_id", "group").agg(F.max("ok").alias("ok")).where("NOT ok").select("area_id", "group")


def envelopes(areas: DataFrame, gates: DataFrame, grow: float = 0.15) -> DataFrame:
    """xmin, ymin, xmax, ymax of all areas and gates, grown."""
    rings = areas.select("rings").unionByName(gates.select("rings"))
    return rings.select(F.inline(F.array(geo.envelope(F.col("rings")[0], grow))))


def geojson(rows: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """`rows` with geojson, the simplified polygon, in place of rings and flow_role and notes."""
    simple = F.udf(lambda r: geo.simplify_ring(r, tolerance), "array<array<double>>")
    ring = F.col("rings")[0] if tolerance <= 0 else simple(F.col("rings")[0])
    return rows.withColumn("geojson", geo.polygon_json(ring)).drop("rings", "flow_role", "notes")


def map_centre(rows: DataFrame) -> DataFrame:
    """lon, lat: mean of the polygons' centroids."""
    c = rows.select(geo.centroid(F.col("rings")[0]).alias("c"))
    return c.agg(F.avg("c.lon").alias("lon"), F.avg("c.lat").alias("lat"))
