"""From vendor rows to position fixes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.functions import scalars as S

MAX_AGE_MIN = 720
MAX_KNOTS = 35.0

FIX = (
    "ts timestamp, src string, vessel_uid string, lat double, lon double, sog float, cog float, heading short, elapsed int, destination string, flag string, "
    "length_m float, width_m float, dwt int, shipname string, shiptype short, ship_id string, rot float"
)


def source_class() -> Column:
    """'sat' for the placeholder name or an id that isn't all digits, else 'terrestrial'."""
    sat = (F.upper(F.trim(F.coalesce("SHIPNAME", F.lit("")))) == "[SAT-AIS]") | ~F.coalesce("SHIP_ID", F.lit("")).rlike("^[0-9]+$")
    return F.when(sat, "sat").otherwise("terrestrial")


def is_tanker() -> Column:
    parts = [F.trim("SHIPTYPE").startswith("8"), F.lower(F.trim("TYPE_NAME")) == "tanker", F.trim("TYPE_IMG") == "8", F.trim("GT_SHIPTYPE") == "17"]
    yes = F.lit(False)
    for p in parts:
        yes = yes | F.coalesce(p, F.lit(False))
    return yes


def vessel_uid(of: Callable[[str], Column] = F.col) -> Column:
    """First that there is of MMSI, IMO, numeric id, opaque id, digest of what else is known. of: the value of a vendor's key."""

    def numbered(name: str, *keys: str) -> Column:
        given = F.coalesce(*(F.nullif(of(k), F.lit("")) for k in keys))
        whole = F.when(F.trim(given).rlike(r"^[+-]?[0-9]+$"), F.trim(given).try_cast("bigint"))
        return F.when(whole != 0, F.concat(F.lit(f"{name}:"), whole.cast("string")))

    ship = F.trim(F.coalesce(of("SHIP_ID"), F.lit("")))
    name = S.for_hash(of("SHIPNAME"))
    name = F.when(name.isin("[SAT-AIS]", "UNKNOWN"), F.lit("")).otherwise(name)
    kind = F.coalesce(F.nullif(of("SHIPTYPE"), F.lit("")), of("TYPE_NAME"))
    parts = [name, *(S.for_hash(of(k)) for k in ("FLAG", "LENGTH", "WIDTH")), S.for_hash(kind)]
    return F.coalesce(
        numbered("mmsi", "MMSI", "mmsi_lower"),
        numbered("imo", "IMO", "imo_lower"),
        F.when(ship.rlike("^[0-9]+$"), F.concat(F.lit("mtid:"), ship)),
        F.when(ship != "", F.concat(F.lit("sat:"), ship)),
        F.concat(F.lit("h:"), F.substring(F.sha1(F.concat_ws("||", *parts)), 1, 16)),
    )


def observed_at(of: Callable[[str], Column] = F.col) -> Column:
    """fetch_ts less the whole minutes of ELAPSED; fetch_ts where that is no whole number; null beyond the limits."""
    minutes = S.to_strict_whole(of("ELAPSED"))
    return F.when(minutes.isNull(), F.col("fetch_ts")).when(minutes.between(0, MAX_AGE_MIN), F.col("fetch_ts") - F.make_interval(mins=minutes))


def near_any(rows: DataFrame, boxes: DataFrame | None) -> DataFrame:
    """`rows` (lon, lat) inside any box (xmin, ymin, xmax, ymax); all of them where there are no boxes.

    Boxes are dealt out to the degree cells that they touch, so the join is by cell and each row is looked up once.
    """
    if boxes is None or boxes.isEmpty():
        return rows
    span = lambda a, b: F.sequence(F.floor(a).cast("int"), F.floor(b).cast("int"))
    cells = boxes.withColumn("_cx", F.explode(span("xmin", "xmax"))).withColumn("_cy", F.explode(span("ymin", "ymax")))
    cells = cells.groupBy("_cx", "_cy").agg(F.collect_list(F.struct("xmin", "ymin", "xmax", "ymax")).alias("_boxes"))
    keyed = rows.withColumn("_cx", F.floor("lon").cast("int")).withColumn("_cy", F.floor("lat").cast("int")).join(cells, ["_cx", "_cy"])
    inside = lambda b: F.col("lon").between(b["xmin"], b["xmax"]) & F.col("lat").between(b["ymin"], b["ymax"])
    return keyed.where(F.exists("_boxes", inside)).select(*rows.columns)


def normalise(raw: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """Fixes of the tankers among the vendor rows (see payload.explode_rows): 18 columns, types as in FIX, and where each comes from (fetch_ts, path, place).

    Rows go that have no tanker's type, an age outside the limits, no position on the globe, no place near a geofence
    (boxes), a satellite source or a speed that no tanker has.
    """
    speed = S.to_number(F.col("SPEED")) / 10.0
    rows = raw.where(is_tanker()).withColumns({"ts": F.col("observed"), "lat": S.to_number(F.col("LAT")), "lon": S.to_number(F.col("LON")), "src": source_class(), "_sog": speed})
    rows = rows.where(F.col("ts").isNotNull() & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & (F.col("src") != "sat"))
    rows = rows.where(F.col("_sog").isNull() | F.isnan("_sog") | (F.col("_sog") <= MAX_KNOTS))
    rows = near_any(rows, boxes)
    values = {
        "ts": F.col("ts"),
        "src": F.col("src"),
        "vessel_uid": F.col("uid"),
        "lat": F.col("lat"),
        "lon": F.col("lon"),
        "sog": F.col("_sog").cast("float"),
        "cog": S.to_number(F.col("COURSE")).cast("float"),
        "heading": S.to_whole(F.col("HEADING")).try_cast("short"),
        "elapsed": S.to_whole(F.col("ELAPSED")),
        "destination": S.to_text(F.col("DESTINATION")),
        "flag": S.to_text(F.col("FLAG")),
        "length_m": S.to_number(F.col("LENGTH")).cast("float"),
        "width_m": S.to_number(F.col("WIDTH")).cast("float"),
        "dwt": S.to_whole(F.col("DWT")),
        "shipname": S.to_text(F.col("SHIPNAME")),
        "shiptype": S.to_whole(F.col("SHIPTYPE")).try_cast("short"),
        "ship_id": S.to_text(F.col("SHIP_ID")),
        "rot": S.to_number(F.col("ROT")).cast("float"),
    }
    return rows.select(*(v.alias(k) for k, v in values.items()), "fetch_ts", "path", "place")


def bad_fixes(fixes: DataFrame) -> DataFrame:
    """The fixes that the fact table doesn't accept."""
    return fixes.where("src NOT IN ('terrestrial', 'sat') OR NOT lat BETWEEN -90 AND 90 OR NOT lon BETWEEN -180 AND 180 OR ts IS NULL OR src IS NULL OR lat IS NULL OR lon IS NULL")
