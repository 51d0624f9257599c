"""Interactive queries. `as_of` stands for now: by default the latest fix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.functions import geo
from vesselflow.functions import scalars as S
from vesselflow.operators import normalize
from vesselflow.sources import payload


def latest(fixes: DataFrame) -> dt.datetime:
    return fixes.agg(F.max("ts")).first()[0]


def _since(fixes: DataFrame, as_of: dt.datetime | None, **ago: int) -> Column:
    now = as_of or latest(fixes)
    return F.col("ts") >= F.lit(now - dt.timedelta(**ago)).cast("timestamp_ntz") if now else F.lit(False)


def newest(fixes: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Newest fix of each vessel; of equal times the last to arrive."""
    row = F.max_by(F.struct(*fixes.columns), F.struct("ts", order)).alias("r")
    return fixes.groupBy("vessel_uid").agg(row).select("r.*")


def overview(fixes: DataFrame, hours: int = 12, as_of: dt.datetime | None = None) -> DataFrame:
    recent = newest(fixes.where(_since(fixes, as_of, hours=hours)).select("vessel_uid", "ts", "arrival_seq", "area_id_core", "area_id_approach"))
    core, near = F.col("area_id_core").isNotNull(), F.col("area_id_approach").isNotNull() & F.col("area_id_core").isNull()
    now = recent.agg(F.sum(core.cast("long")).alias("vessels_in_port"), F.sum(near.cast("long")).alias("vessels_in_approach"))
    return fixes.agg(F.countDistinct("vessel_uid").alias("unique_vessels"), F.max("ts").alias("last_ts")).join(now)


def ingest_rate(fixes: DataFrame, hours: int = 24, as_of: dt.datetime | None = None) -> DataFrame:
    return fixes.where(_since(fixes, as_of, hours=hours)).groupBy(S.bucket(F.col("ts"), 15).alias("minute")).agg(F.count("*").alias("rows_inserted")).orderBy("minute")


def occupancy_snapshot(fixes: DataFrame, areas: DataFrame) -> DataFrame:
    last = newest(fixes.where("area_id_core IS NOT NULL OR area_id_approach IS NOT NULL").select("vessel_uid", "ts", "arrival_seq", "area_id_core", "area_id_approach"))
    core, near = areas.select(F.col("area_id").alias("area_id_core"), F.col("group").alias("cg")), areas.select(F.col("area_id").alias("area_id_approach"), F.col("group").alias("ag"))
    rows = last.join(core, "area_id_core", "left").join(near, "area_id_approach", "left")
    inside = F.col("area_id_core").isNotNull()
    out = rows.groupBy(F.coalesce("cg", "ag").alias("port_group")).agg(
        F.count_if(inside).alias("vessels_in_core"), F.count_if(~inside).alias("vessels_in_approach"), F.count("*").alias("vessels_total")
    )
    return out.orderBy(F.desc_nulls_first("vessels_in_core"), F.desc_nulls_first("vessels_in_approach"), F.asc_nulls_last("port_group"))


def latest_n_fixes(fixes: DataFrame, n: int = 5, hours: int = 12, as_of: dt.datetime | None = None) -> DataFrame:
    w = Window.partitionBy("vessel_uid").orderBy(F.desc("ts"), F.desc("arrival_seq"))
    rows = fixes.where(_since(fixes, as_of, hours=hours)).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    return rows.orderBy("vessel_uid", F.desc("rn"))


def tracks(ranked: DataFrame) -> DataFrame:
    """Per vessel of latest_n_fixes, its points oldest first with fading opacities; bounded by n points."""
    most = F.max("rn").over(Window.partitionBy("vessel_uid"))
    faded = ranked.withColumn("m", most).withColumn("opacity", 0.4 + 0.5 * F.greatest(F.lit(0), F.col("m") - F.col("rn")) / F.greatest(F.lit(1), F.col("m") - 1))
    return faded.groupBy("vessel_uid").agg(F.sort_array(F.collect_list(F.struct("ts", "lat", "lon", "opacity"))).alias("points"))


def port_occupancy_series(fixes: DataFrame, core: str, approach: str, days: int = 14, as_of: dt.datetime | None = None) -> DataFrame:
    """bucket, in_core, in_approach: different vessels in a port's core, and in its approach but in no core, by half hours."""
    inside = F.when(F.col("area_id_core") == core, F.col("vessel_uid"))
    near = F.when((F.col("area_id_approach") == approach) & F.col("area_id_core").isNull(), F.col("vessel_uid"))
    rows = fixes.where(_since(fixes, as_of, days=days)).groupBy(S.bucket(F.col("ts"), 30).alias("bucket"))
    return rows.agg(F.countDistinct(inside).alias("in_core"), F.countDistinct(near).alias("in_approach")).orderBy("bucket")


def area_ports(areas: DataFrame) -> DataFrame:
    return areas.where("kind = 'port' AND subtype IN ('core', 'approach')").select("area_id", "name").orderBy("name", "area_id")


def approaches(areas: DataFrame) -> DataFrame:
    return areas.where("kind = 'port' AND subtype = 'approach'").select("area_id", "name").orderBy("name", "area_id")


def lanes(areas: DataFrame) -> DataFrame:
    return areas.where("kind IN ('lane', 'chokepoint')").select(F.col("area_id").alias("lane_id"), "name").orderBy("name", "lane_id")


def in_range(mart: DataFrame, key: str, value: str, start: str, end: str, **columns: str) -> DataFrame:
    """Rows of one key from start to end, both days included: day, the key and the given columns under new names."""
    days = F.col("day").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return mart.where((F.col(key) == value) & days).select("day", key, *(F.expr(c).alias(k) for k, c in columns.items())).orderBy("day")


def class_mix_shares(mart: DataFrame, integer_shares: bool = False) -> DataFrame:
    """Shares of the classes in a day's tonnage; with integer_shares, cut to 0 or 1 as integer division does."""
    parts = ("dwt_vlcc", "dwt_suezmax", "dwt_aframax", "dwt_other")
    base = mart.select("day", "lane_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in parts)).withColumn("total", sum((F.col(c) for c in parts[1:]), F.col(parts[0])))
    share = lambda c: F.when(F.col("total") > 0, F.floor(F.col(c) / F.col("total")) if integer_shares else F.col(c) / F.col("total"))
    return base.select("day", "lane_id", share("dwt_vlcc").alias("vlcc_share"), share("dwt_suezmax").alias("suezmax_share"), share("dwt_aframax").alias("aframax_share"))


def routing_share(transits: DataFrame, a: str, b: str) -> DataFrame:
    """A / (A + B) of laden tonnage by day; null where one is missing."""
    lane = lambda x, name: transits.where(F.col("lane_id") == x).select("day", F.col("laden_dwt_sum").alias(name))
    both = lane(a, "dwt_a").join(lane(b, "dwt_b"), "day", "full_outer")
    return both.withColumn("share_a", F.col("dwt_a") / F.nullif(F.col("dwt_a") + F.col("dwt_b"), F.lit(0))).orderBy("day")


def row_counts(tables: dict[str, DataFrame], since: dt.datetime | None = None, column: str = "day") -> DataFrame:
    """rel, rows of each table, from a day on where given."""
    out = None
    for name, df in tables.items():
        rows = df.where(F.col(column) >= F.lit(since).cast("timestamp_ntz")) if since else df
        one = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("rel"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def explore(spark: SparkSession, tables: dict[str, DataFrame], query: str, **args) -> DataFrame:
    """The result of any SQL over the given tables, with named parameters."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=args or None)


#: Default zoom by class; grown by degrees of areas and gates; OSM tiles to one vendor tile along each side.
ZOOMS = {"gate": 6, "port_core": 7, "port_approach": 6, "lane": 5, "chokepoint": 6, "sts": 6}
AREA_GROW, GATE_GROW, FACTOR = 0.20, 0.30, 2


def zoom() -> Column:
    kind, sub = F.col("kind"), F.col("subtype")
    z = F.when(F.col("gate"), ZOOMS["gate"]).when((kind == "port") & (sub == "core"), ZOOMS["port_core"])
    z = z.when((kind == "port") & (sub == "approach"), ZOOMS["port_approach"])
    for k in ("chokepoint", "sts"):
        z = z.when((sub == "corridor") & (kind == k), ZOOMS[k])
    return z.otherwise(ZOOMS["lane"])


def tile_cover(areas: DataFrame, gates: DataFrame, factor: int = FACTOR) -> DataFrame:
    """owner, z, x, y: vendor tiles that cover each area and gate; boxes over the date line are split."""
    a = areas.select(F.col("area_id").alias("owner"), "kind", "subtype", F.lit(False).alias("gate"), geo.envelope(F.col("rings")[0], AREA_GROW).alias("box"))
    g = gates.select(F.concat("area_id", F.lit("::"), "gate_id").alias("owner"), "kind", "subtype", F.lit(True).alias("gate"), geo.envelope(F.col("rings")[0], GATE_GROW).alias("box"))
    rows = a.unionByName(g).select("owner", zoom().alias("z"), geo.wrap_lon(F.col("box.xmin")).alias("x0"), geo.wrap_lon(F.col("box.xmax")).alias("x1"), "box.ymin", "box.ymax")
    part = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    parts = F.when(F.col("x1") >= F.col("x0"), F.array(part(F.col("x0"), F.col("x1")))).otherwise(F.array(part(F.col("x0"), F.lit(180.0 - 1e-9)), part(F.lit(-180.0), F.col("x1"))))
    rows = rows.select("owner", "z", "ymin", "ymax", F.inline(parts))
    ends = lambda a, b: F.sequence(F.least(a, b), F.greatest(a, b))
    rows = rows.withColumn("x", F.explode(ends(geo.tile_x(F.col("lo"), F.col("z")), geo.tile_x(F.col("hi"), F.col("z")))))
    rows = rows.withColumn("y", F.explode(ends(geo.tile_y(F.col("ymax"), F.col("z")), geo.tile_y(F.col("ymin"), F.col("z")))))
    down = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    return rows.select("owner", "z", down("x"), down("y")).distinct()


def tile_list(cover: DataFrame) -> DataFrame:
    """tiles: all distinct tiles in order, as one text. A tile list is as long as the areas are many, not as the data."""
    one = cover.select("z", "x", "y").distinct().agg(F.sort_array(F.collect_list(F.struct("z", "x", "y"))).alias("t"))
    return one.select(F.array_join(F.transform("t", lambda t: F.concat_ws("/", t["z"], t["x"], t["y"])), ";").alias("tiles"))


def tile_breakdown(cover: DataFrame) -> DataFrame:
    """owner, n_tiles, tiles: the tiles of each area and gate, as in tile_list."""
    one = cover.groupBy("owner").agg(F.count("*").alias("n_tiles"), F.sort_array(F.collect_list(F.struct("z", "x", "y"))).alias("t"))
    return one.select("owner", "n_tiles", F.array_join(F.transform("t", lambda t: F.concat_ws("/", t["z"], t["x"], t["y"])), ";").alias("tiles"))


def tile_rounds(cover: DataFrame, per_cycle: int = 8, cycles: int = 8) -> DataFrame:
    """cycle, place, z, x, y, path: the tiles that each cycle asks for, in turn, beginning again where the list ends.

    A tile list is as long as the areas are many, so its places are numbered in one task.
    """
    tiles = cover.select("z", "x", "y").distinct()
    listed = tiles.withColumn("n", F.row_number().over(Window.orderBy("z", "x", "y")) - 1).withColumn("total", F.count("*").over(Window.partitionBy()))
    # Slot s of all cycles asks for the tile s modulo their number.
    slots = listed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(per_cycle * cycles - 1)))).where(F.col("slot") % F.col("total") == F.col("n"))
    return slots.select(
        F.floor(F.col("slot") / per_cycle).cast("int").alias("cycle"), (F.col("slot") % per_cycle).cast("int").alias("place"), "z", "x", "y", payload.tile_url("", F.col("z"), F.col("x"), F.col("y")).alias("path")
    )


def cycle_summary(payloads: DataFrame, raw: DataFrame, kept: DataFrame, inserted: DataFrame, minutes: int = 1440) -> DataFrame:
    """cycle, tiles, tiles_ok, received, kept, inserted: documents and those with rows, rows before and after normalising, and after the dedup."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(S.bucket(F.col("fetch_ts"), minutes).alias("cycle")).agg(F.count("*").alias(name))

    out = payload.tiles_by_cycle(payloads, minutes)
    for df, name in ((raw, "received"), (kept, "kept"), (inserted, "inserted")):
        out = out.join(rows(df, name), "cycle", "left")
    return out.fillna(0)


def observed_run(payloads: DataFrame, follow: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write what `follow` makes of the normalised rows, and count on the way: tiles, tiles_ok, received, kept, inserted of the run.

    Rows are counted as they pass, by observations, so the run is one job over one scan of the documents.
    """
    seen = {name: Observation(name) for name in ("tiles", "received", "kept", "inserted")}
    documents = payloads.observe(seen["tiles"], F.count(F.lit(1)).alias("tiles"), F.count_if(payload._rows().isNotNull()).alias("tiles_ok"))
    one = lambda rows, name: rows.observe(seen[name], F.count(F.lit(1)).alias(name))
    raw = one(payload.explode_rows(documents), "received")
    write(one(follow(one(normalize.normalise(raw), "kept")), "inserted"))
    return {k: v for o in seen.values() for k, v in o.get.items()}


def tile_candidates(tiles: DataFrame) -> DataFrame:
    """kind, z, x, y of the addresses that a tile may have: as it is, with its row flipped, and both one zoom up."""
    z, x, y = F.col("z"), F.col("x"), F.col("y")
    up, hx, hy = z - 1, F.floor(x / 2).cast("int"), F.floor(y / 2).cast("int")
    one = lambda kind, zz, xx, yy: F.struct(F.lit(kind).alias("kind"), zz.cast("int").alias("z"), xx.alias("x"), yy.alias("y"))
    all_ = F.array(one("xyz", z, x, y), one("tms", z, x, geo.flip_y(y, z)), one("xyz_up", up, hx, hy), one("tms_up", up, hx, geo.flip_y(hy, up)))
    return tiles.select(F.inline(F.when(z > 0, all_).otherwise(F.slice(all_, 1, 2))))
