"""Vessel fixes from the driver's `events` table: each user is a vessel that shuttles between two ports.

The expressions are closed forms that any SQL engine evaluates to the same bits.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr

from vesselflow.functions.geo import rectangle
from vesselflow.session import shared_dir
from vesselflow.sources.geofence import AREA, GATE

#: (area_id, kind, subtype, group, flow_role, xmin, ymin, xmax, ymax)
AREAS = [
    ("P0c", "port", "core", "P0", "export", 0, 0, 1, 1),
    ("P0a", "port", "approach", "P0", "export", -1, -1, 2, 2),
    ("P1c", "port", "core", "P1", "import", 10, 0, 11, 1),
    ("P1a", "port", "approach", "P1", "import", 9, -1, 12, 2),
    ("P2c", "port", "core", "P2", None, 5, 6, 6, 7),
    ("P2a", "port", "approach", "P2", None, 4, 5, 7, 8),
    ("L0", "lane", "corridor", "Mid-Atlantic", None, 3.5, -2, 5.5, 2),
    ("L1", "chokepoint", "corridor", "Strait X", None, 6, -2, 8.5, 2),
]
#: (gate_id, area_id, side, xmin, ymin, xmax, ymax)
GATES = [("G0w", "L0", "west", 2.5, -2, 3.7, 2), ("G0e", "L0", "east", 5.3, -2, 6, 2), ("G1w", "L1", "west", 5.7, -2, 6.2, 2), ("G1e", "L1", "east", 8.3, -2, 9.1, 2)]


_RINGS = pa.list_(pa.list_(pa.list_(pa.float64())))


def _local(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small constant table: through Arrow it is a local relation of known size, and no Python runs to read it."""
    names = [c.split()[0] for c in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], _RINGS if n == "rings" else pa.string()) for i, n in enumerate(names)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names), schema)


def areas(spark: SparkSession) -> DataFrame:
    return _local(spark, AREA, [(a, f"Name {a}", k, s, g, None, [rectangle(*box)], r) for a, k, s, g, r, *box in AREAS])


def gates(spark: SparkSession) -> DataFrame:
    of = {a: (k, g) for a, k, _, g, *_ in AREAS}
    return _local(spark, GATE, [(g, a, f"Name {g}", of[a][0], f"gate_{side}", of[a][1], None, [rectangle(*box)]) for g, a, side, *box in GATES])


def features() -> list[dict]:
    """The areas and gates as GeoJSON features, with a corner in the middle of each side that a tolerance of 0.01 degrees takes off."""

    def feature(name: str, kind: str, subtype: str, group: str | None, box: tuple) -> dict:
        ring = rectangle(*box)
        cut = [p for a, b in zip(ring[:-1], ring[1:], strict=True) for p in (a, [(a[0] + b[0]) / 2 + 0.002, (a[1] + b[1]) / 2 + 0.002])] + [ring[-1]]
        return {"type": "Feature", "properties": {"name": name, "kind": kind, "subtype": subtype, "group": group}, "geometry": {"type": "Polygon", "coordinates": [cut]}}

    of = {a: (k, g) for a, k, _, g, *_ in AREAS}
    return [feature(f"Name {a}", k, s, g, box) for a, k, s, g, _, *box in AREAS] + [feature(f"Name {g}", of[a][0], f"gate_{side}", of[a][1], box) for g, a, side, *box in GATES]


def geojson_file(spark: SparkSession) -> str:
    """A folder with the features as one FeatureCollection."""
    path = f"{shared_dir(spark)}/geofences-{uuid.uuid4().hex}"
    doc = json.dumps({"type": "FeatureCollection", "features": features()})
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(path)
    return path


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = rows.selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k", "(unix_micros(cast(ts AS timestamp)) div 3600000000 + user_id * 7) % 240 AS ph")
    return rows.selectExpr(
        "*",
        "CASE WHEN ph < 40 THEN 0e0 WHEN ph < 120 THEN (ph - 40) * 0.125e0 WHEN ph < 160 THEN 10e0 ELSE 10e0 - (ph - 160) * 0.125e0 END AS bx",
        "CASE WHEN k < 30 THEN 0e0 ELSE (k - 50) * 0.004e0 END AS j",
    )
_LAT = "(CASE WHEN user_id % 3 = 2 AND bx > 4.5e0 AND bx < 6.5e0 THEN 6.5e0 ELSE 0.5e0 END) + j + (CASE WHEN k >= 97 THEN 20e0 ELSE 0e0 END)"
_LON = "bx + 0.5e0 + j"
_PATH = "concat('tile-', lpad(cast(event_id AS string), 12, '0')) AS path"
_DWT = "CASE user_id % 5 WHEN 0 THEN 300000 WHEN 1 THEN 150000 WHEN 2 THEN 100000 WHEN 3 THEN 50000 END"


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir).selectExpr(
        "event_id AS arrival_seq",
        "ts",
        "'terrestrial' AS src",
        "concat('mmsi:', 200000000 + user_id) AS vessel_uid",
        f"{_LAT} AS lat",
        f"{_LON} AS lon",
        "cast(value / 10e0 AS float) AS sog",
        "cast(k * 3.6e0 AS float) AS cog",
        "cast(NULL AS smallint) AS heading",
        f"{_DWT} AS dwt",
        "concat('Vessel ', user_id) AS shipname",
    )


#: Hours of the round trip that one leg has.
LEG = 24


def leg_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geofences that grow with the events: whole-degree boxes around each vessel's positions of each leg, spikes left out."""
    at = _positions(spark, sf_dir).where("k < 97").selectExpr("user_id", f"ph div {LEG} AS leg", f"{_LON} AS lon", f"{_LAT} AS lat")
    boxes = at.groupBy("user_id", "leg").agg(*(expr(f"cast(floor({f}({c})) + {d} AS double)").alias(n) for n, f, c, d in (("xmin", "min", "lon", 0), ("ymin", "min", "lat", 0), ("xmax", "max", "lon", 1), ("ymax", "max", "lat", 1))))
    return boxes.selectExpr(
        "concat('A', user_id, '-', leg) AS area_id",
        "concat('Name ', user_id, '-', leg) AS name",
        "CASE user_id % 4 WHEN 2 THEN 'lane' WHEN 3 THEN 'chokepoint' ELSE 'port' END AS kind",
        "CASE user_id % 4 WHEN 0 THEN 'core' WHEN 1 THEN 'approach' ELSE 'corridor' END AS subtype",
        "concat('G', user_id, '-', leg) AS group",
        "cast(NULL AS string) AS notes",
        f"array({_BOX}) AS rings",
        "CASE user_id % 3 WHEN 0 THEN 'export' WHEN 1 THEN 'import' END AS flow_role",
        "leg",
        "xmin",
        "ymin",
        "ymax",
    )


_BOX = "array(array(xmin, ymin), array(xmax, ymin), array(xmax, ymax), array(xmin, ymax), array(xmin, ymin))"


def leg_gates(areas: DataFrame) -> DataFrame:
    """Gates of every other leg: slabs of a degree along the west side of its box; those of ports have no corridor to belong to."""
    rows = areas.where("leg % 2 = 0").selectExpr("*", "xmin + 0.5e0 AS xmax", "xmin - 0.5e0 AS west")
    return rows.selectExpr(
        "concat('W', area_id) AS gate_id",
        "CASE WHEN subtype = 'corridor' THEN area_id END AS area_id",
        "concat('Gate ', area_id) AS name",
        "kind",
        "CASE WHEN leg % 4 = 0 THEN 'gate_west' ELSE 'gate_east' END AS subtype",
        "group",
        "notes",
        f"array({_BOX.replace('xmin', 'west')}) AS rings",
    )


def track_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, fetch_ts: the positions of `fixes` as vendor documents, one each; some are broken, of other ships, too old or of a satellite."""
    return _positions(spark, sf_dir).selectExpr(
        f"""CASE WHEN event_id % 23 = 5 THEN '<html>busy</html>' ELSE concat('{{"data":{{"rows":[{{"SHIP_ID":"', CASE WHEN event_id % 19 = 0 THEN 'ab=/' ELSE cast(user_id AS string) END,
            '","MMSI":"', 200000000 + user_id, '","SHIPNAME":"Vessel ', user_id, '","SHIPTYPE":"', CASE WHEN event_id % 7 = 3 THEN 70 ELSE 80 + user_id % 10 END,
            '","ELAPSED":"', CASE WHEN event_id % 17 = 0 THEN 721 ELSE 0 END, '","LAT":"', {_LAT}, '","LON":"', {_LON}, '","SPEED":"', value, '","COURSE":"', k * 3.6e0,
            '","DWT":', coalesce(cast({_DWT} AS string), '""'), '}}]}}}}') END AS value""",
        "cast(ts AS timestamp) AS fetch_ts",
        _PATH,
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, fetch_ts: one vendor document per event, with the odd values that vendors send."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        """concat('{"data":{"rows":[{"SHIP_ID":"', CASE WHEN event_id % 11 = 0 THEN 'ab=/' ELSE cast(user_id AS string) END,
            '","SHIPNAME":" Vessel ', user_id, ' ","SHIPTYPE":"', 70 + user_id % 20, '","ELAPSED":"', CASE WHEN event_id % 13 = 0 THEN 'x' ELSE cast(event_id % 800 AS string) END,
            '","LAT":"', event_id % 100 - 5, '.5","LON":', event_id % 200 - 10, ',"SPEED":"', event_id % 400, '"',
            CASE WHEN user_id % 2 = 0 THEN concat(',"MMSI":"', 200000000 + user_id, '"') WHEN user_id % 3 = 0 THEN concat(',"MMSI":0,"IMO":', 9000000 + user_id) ELSE '' END,
            ',"HEADING":"', event_id % 360, '.7","DWT":"', event_id % 1000, '","COURSE":', event_id % 720 * 0.5e0, ',"FLAG":"', CASE WHEN user_id % 4 = 0 THEN ' ' ELSE 'PA ' END,
            '","LENGTH":"', user_id % 300, '.5","WIDTH":"', CASE WHEN user_id % 3 = 0 THEN 'n/a' ELSE '32' END, '","DESTINATION":" Port ', user_id % 5, ' ","ROT":"-', event_id % 9 + 1, '"}]}}') AS value""",
        "cast(ts AS timestamp) AS fetch_ts",
        _PATH,
    )


#: Rows of one document of `crowded_payloads`, and documents that a task puts together.
CROWD, DEALT = 5000, 16


def crowded_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, fetch_ts, path: documents of up to CROWD positions, a vessel's several times and in no order of time; each two documents have one time.

    An event is observed whole minutes before its document; a few are of no tanker or of a satellite. Tasks grow in number
    with the events and not in size: positions are dealt out by document before they are grouped.
    """
    at = _positions(spark, sf_dir).withColumn("doc", expr(f"event_id div {CROWD}"))
    n = at.agg(expr("coalesce(max(doc), 0) + 1")).first()[0]
    rows = at.repartition(-(-n // DEALT), "doc").selectExpr(
        "doc",
        "event_id * 7919 % 4993 AS at",
        "event_id",
        f"""named_struct('SHIP_ID', CASE WHEN event_id % 31 = 0 THEN 'ab=/' ELSE cast(user_id AS string) END, 'MMSI', cast(200000000 + user_id AS string), 'SHIPNAME', concat('Vessel ', user_id),
            'SHIPTYPE', CASE WHEN event_id % 29 = 3 THEN '70' ELSE '80' END, 'ELAPSED', cast(event_id * 37 % 700 AS string), 'LAT', cast({_LAT} AS string), 'LON', cast({_LON} AS string),
            'SPEED', cast(value AS string), 'COURSE', cast(k * 3.6e0 AS string), 'DWT', cast({_DWT} AS string)) AS r""",
    )
    docs = rows.groupBy("doc").agg(expr("to_json(named_struct('data', named_struct('rows', transform(array_sort(collect_list(struct(at, event_id, r))), s -> s.r))))").alias("value"))
    return docs.selectExpr("value", "timestamp_seconds(1704067200 + doc div 2 * 86400) AS fetch_ts", "concat('tile-', lpad(cast(doc AS string), 12, '0')) AS path")


def echoed_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixes, four of five followed by one more of the same vessel that isn't newer: a second or three before or at the same time, next to it or 2 km away."""
    rows = fixes(spark, sf_dir)
    echo = rows.where("arrival_seq % 5 < 4").selectExpr(
        "arrival_seq * 2 + 1 AS arrival_seq",
        "ts - make_dt_interval(0, 0, 0, CASE arrival_seq % 5 WHEN 2 THEN 3 WHEN 3 THEN 0 ELSE 1 END) AS ts",
        *(c for c in rows.columns if c not in ("arrival_seq", "ts", "lat")),
        "lat + CASE arrival_seq % 5 WHEN 1 THEN 0.000001e0 ELSE 0.02e0 END AS lat",
    )
    return rows.withColumn("arrival_seq", expr("arrival_seq * 2")).unionByName(echo)
