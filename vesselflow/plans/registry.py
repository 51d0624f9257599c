"""The named queries over the driver's tables, and the DuckDB statements that they are compared with."""

from __future__ import annotations

import datetime as dt
import functools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.functions import geo
from vesselflow.operators import dedup, dwell, events, label, normalize
from vesselflow.plans import dashboard, days, invalidation, marts, refresh
from vesselflow.plans.oracle import ECHOED, LEGS, sql
from vesselflow.sources import fixture, geofence, payload

Query = Callable[[SparkSession, str], DataFrame]
RANGE = ("2024-01-05", "2024-01-25")
MEMBER = ("area_id_core", "area_id_approach", "lane_id", "gate_id", "gate_end")


class Tables:
    """The pipeline's tables over one folder, each a lazy DataFrame made from the one before."""

    def __init__(self, spark: SparkSession, sf_dir: str, fixes: DataFrame | None = None) -> None:
        self.spark, self.areas, self.gates = spark, fixture.areas(spark), fixture.gates(spark)
        self.labelled = label.label(fixture.fixes(spark, sf_dir) if fixes is None else fixes, self.areas, self.gates)

    @functools.cached_property
    def fixes(self) -> DataFrame:
        return dedup.dedup_with_before(self.labelled)

    @functools.cached_property
    def events(self) -> DataFrame:
        return events.emit_events(self.fixes, self.areas)

    def write_events(self) -> None:
        """From now on events are read from a table in the session's shared folder: what makes several marts folds the fixes once."""
        self.events = refresh.written(self.events, "events")

    @functools.cached_property
    def sessions(self) -> DataFrame:
        return dwell.dwell_sessions(self.events)

    def mart(self, name: str) -> DataFrame:
        make = getattr(marts, name)
        if name == "class_mix_daily":
            return make(self.events)
        if name == "lane_transit_time_daily":
            return make(self.sessions)
        return make(self.sessions if name == "area_occupancy_daily" else self.events, self.areas)

    def marts(self) -> dict[str, DataFrame]:
        self.write_events()
        return {n: self.mart(n) for n in MARTS}


MARTS = ("port_lifts_daily", "lane_transit_daily", "ballast_return_daily", "class_mix_daily", "lane_transit_time_daily", "area_occupancy_daily")
_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}
#: Functions of Tables by the name of their query.
_made: dict[str, Callable] = {}


def add(name: str, oracle: str | None, base: bool = True):
    """Register a function of Tables under a name, with the SELECT that gives the same."""

    def wrap(f: Callable[[Tables], DataFrame]):
        _queries[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        _made[name] = f
        if oracle:
            _oracle[name] = sql(oracle) if base else oracle
        return f

    return wrap


def add_with_dir(name: str, oracle: str | None):
    def wrap(f: Query):
        _queries[name] = f
        if oracle:
            _oracle[name] = oracle
        return f

    return wrap


for _name, _cte, _rounded in (
    ("lane_transit_daily", "q2", ()),
    ("port_lifts_daily", "q1", ()),
    ("lane_transit_time_daily", "q3", ("transit_time_mean_s",)),
    ("area_occupancy_daily", "q4", ("avg_open_sessions",)),
    ("ballast_return_daily", "q5", ()),
    ("class_mix_daily", "q6", ()),
):
    _replace = ", ".join(f"round({c}, 6) AS {c}" for c in _rounded)
    add(_name, f"SELECT * REPLACE ({_replace}) FROM {_cte}" if _rounded else f"SELECT * FROM {_cte}")(
        lambda t, name=_name, rounded=_rounded: t.mart(name).withColumns({c: F.round(c, 6) for c in rounded})
    )


@add("label_fixes", "SELECT arrival_seq, ts, vessel_uid, lat, lon, area_id_core, area_id_approach, lane_id, gate_id, gate_end FROM lb")
def _(t):
    return t.labelled.select("arrival_seq", "ts", "vessel_uid", "lat", "lon", *MEMBER)


@add("dedup_fixes", "SELECT arrival_seq, ts, vessel_uid, lat, lon, sog, cog, dwt FROM ac")
def _(t):
    return t.fixes.select("arrival_seq", "ts", "vessel_uid", "lat", "lon", "sog", "cog", "dwt")


@add_with_dir("dedup_out_of_order", sql("SELECT le.arrival_seq, le.ts, le.vessel_uid, lat, lon FROM le JOIN fk USING (arrival_seq) WHERE rule = 0", tables=ECHOED))
def _(spark, sf_dir):
    t = Tables(spark, sf_dir, fixture.echoed_fixes(spark, sf_dir))
    return dedup.dedup(t.labelled).select("arrival_seq", "ts", "vessel_uid", "lat", "lon")


def _folded(t: Tables) -> str:
    """The labelled fixes written by day and folded a week at a time, each week onto the state that the one before has left."""
    facts, root = refresh.scratch(t.spark, "facts"), refresh.scratch(t.spark, "folded")
    refresh.append_fact(t.labelled, facts)
    days.fold_by_days(t.spark, facts, root, days.roles_of(t.areas), every=7)
    return root


@add("events_by_days", "SELECT * FROM ev")
def _(t):
    return days.events(t.spark, _folded(t))


@add("sessions_by_days", "SELECT * FROM dw")
def _(t):
    return days.sessions(t.spark, _folded(t))


def _refreshed(t: Tables, name: str) -> DataFrame:
    """A mart after two batches of facts, the second of a seventh of the vessels, each followed by a refresh of what it has touched."""
    root = refresh.scratch(t.spark, "live")
    t.write_events()
    second, opened = F.pmod(F.xxhash64("vessel_uid"), F.lit(7)) == 3, t.sessions.where("is_open")

    def facts(kind: str, some: list[dt.date]) -> DataFrame:
        rows = invalidation.on_days(t.spark.read.parquet(f"{root}/{kind}"), some)
        return rows if kind == "event" else rows.unionByName(opened.where(F.to_date("start_ts").isin(some)))

    for number, of in enumerate((~second, second)):
        invalidation.append(root, number, t.events.where(of), t.sessions.where(of & ~F.col("is_open")))
        invalidation.refresh_pending(t.spark, root, t.areas, facts, which={name: invalidation.MARTS[name]})
    return invalidation.mart(t.spark, root, name)


@add("lane_transit_by_refresh", "SELECT * FROM q2")
def _(t):
    return _refreshed(t, "lane_transit_daily")


@add("area_occupancy_by_refresh", "SELECT * REPLACE (round(avg_open_sessions, 6) AS avg_open_sessions) FROM q4")
def _(t):
    return _refreshed(t, "area_occupancy_daily").withColumn("avg_open_sessions", F.round("avg_open_sessions", 6))


for _kind in ("port", "approach", "lane"):
    add(f"{_kind}_events", f"SELECT * FROM ev WHERE area_kind = '{_kind}'")(lambda t, kind=_kind: t.events.where(F.col("area_kind") == kind))


@add("cargo_state", "SELECT vessel_uid, arg_max(laden, arrival_seq) AS laden, arg_max(confidence, arrival_seq) AS confidence, arg_max(cargo_ts, arrival_seq) AS updated_ts FROM t4 WHERE laden IS NOT NULL GROUP BY 1")
def _(t):
    return events.cargo_state(t.fixes, t.areas)


@add(
    "vessel_state",
    "SELECT vessel_uid, area_id_core AS core_area_id, area_id_approach AS approach_area_id, lane_id, gate_end, ts AS updated_ts FROM ac QUALIFY row_number() OVER (PARTITION BY vessel_uid ORDER BY arrival_seq DESC) = 1",
)
def _(t):
    return events.vessel_state(t.fixes)


@add("dwell_sessions", "SELECT * FROM dw")
def _(t):
    return t.sessions


# Dashboard

_NOW = "(SELECT max(ts) FROM lb)"
_LAST = "row_number() OVER (PARTITION BY vessel_uid ORDER BY ts DESC, arrival_seq DESC)"


@add(
    "overview",
    f"""SELECT (SELECT count(DISTINCT vessel_uid) FROM lb) AS unique_vessels, {_NOW} AS last_ts, CAST(sum(CAST(area_id_core IS NOT NULL AS INT)) AS BIGINT) AS vessels_in_port,
    CAST(sum(CAST(area_id_approach IS NOT NULL AND area_id_core IS NULL AS INT)) AS BIGINT) AS vessels_in_approach FROM (SELECT *, {_LAST} AS rn FROM lb WHERE ts >= {_NOW} - INTERVAL 12 HOUR) WHERE rn = 1""",
)
def _(t):
    return dashboard.overview(t.labelled)


@add("ingest_rate", f"SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS minute, count(*) AS rows_inserted FROM lb WHERE ts >= {_NOW} - INTERVAL 24 HOUR GROUP BY 1")
def _(t):
    return dashboard.ingest_rate(t.labelled)


@add(
    "occupancy_snapshot",
    f"""SELECT coalesce(c.grp, p.grp) AS port_group, count(*) FILTER (WHERE area_id_core IS NOT NULL) AS vessels_in_core, count(*) FILTER (WHERE area_id_core IS NULL) AS vessels_in_approach, count(*) AS vessels_total
    FROM (SELECT *, {_LAST} AS rn FROM lb WHERE area_id_core IS NOT NULL OR area_id_approach IS NOT NULL) l LEFT JOIN area c ON c.id = area_id_core LEFT JOIN area p ON p.id = area_id_approach WHERE rn = 1 GROUP BY 1""",
)
def _(t):
    return dashboard.occupancy_snapshot(t.labelled, t.areas)


@add("latest_fixes", f"SELECT vessel_uid, ts, lat, lon, sog, cog, shipname, area_id_core, area_id_approach, lane_id FROM (SELECT *, {_LAST} AS rn FROM lb) WHERE rn = 1")
def _(t):
    return dashboard.newest(t.labelled).select("vessel_uid", "ts", "lat", "lon", "sog", "cog", "shipname", "area_id_core", "area_id_approach", "lane_id")


@add("latest_n_fixes", f"SELECT vessel_uid, ts, lat, lon, area_id_core, lane_id, CAST(rn AS INT) AS rn FROM (SELECT *, {_LAST} AS rn FROM lb WHERE ts >= {_NOW} - INTERVAL 72 HOUR) WHERE rn <= 5")
def _(t):
    return dashboard.latest_n_fixes(t.labelled, 5, 72).select("vessel_uid", "ts", "lat", "lon", "area_id_core", "lane_id", "rn")


@add(
    "vessel_tracks",
    f"""SELECT vessel_uid, count(*) AS n_points, round(sum(0.4e0 + 0.5e0 * greatest(0, m - rn) / greatest(1, m - 1)), 6) AS opacity FROM (SELECT *, max(rn) OVER (PARTITION BY vessel_uid) AS m FROM
    (SELECT *, {_LAST} AS rn FROM lb WHERE ts >= {_NOW} - INTERVAL 72 HOUR) WHERE rn <= 5) GROUP BY 1""",
)
def _(t):
    rows = dashboard.tracks(dashboard.latest_n_fixes(t.labelled, 5, 72))
    return rows.select("vessel_uid", F.size("points").cast("long").alias("n_points"), F.round(F.aggregate("points", F.lit(0.0), lambda a, p: a + p["opacity"]), 6).alias("opacity"))


@add(
    "port_occupancy_series",
    f"""SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bucket, count(DISTINCT vessel_uid) FILTER (WHERE area_id_core = 'P0c') AS in_core,
    count(DISTINCT vessel_uid) FILTER (WHERE area_id_approach = 'P0a' AND area_id_core IS NULL) AS in_approach FROM lb WHERE ts >= {_NOW} - INTERVAL 14 DAY GROUP BY 1""",
)
def _(t):
    return dashboard.port_occupancy_series(t.labelled, "P0c", "P0a")


@add("area_ports", "SELECT id AS area_id, name FROM area WHERE kind = 'port'")
def _(t):
    return dashboard.area_ports(t.areas)


@add("lanes", "SELECT id AS lane_id, name FROM area WHERE kind IN ('lane', 'chokepoint')")
def _(t):
    return dashboard.lanes(t.areas)


@add("approaches", "SELECT id AS area_id, name FROM area WHERE subtype = 'approach'")
def _(t):
    return dashboard.approaches(t.areas)


_IN = f"day BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"
for _name, _mart, _cte, _key, _value, _cols in (
    ("port_lifts_range", "port_lifts_daily", "q1", "port_id", "P1c", {"arrive_dwt": "arrive_dwt_laden", "depart_dwt": "depart_dwt_laden"}),
    ("port_lifts_ewm", "port_lifts_daily", "q1", "port_id", "P0c", {"arrive_dwt_ewm": "arrive_dwt_laden", "depart_dwt_ewm": "depart_dwt_laden"}),
    ("lane_flow_range", "lane_transit_daily", "q2", "lane_id", "L0", {"transit_cnt_ewm": "transit_cnt", "laden_dwt_sum_ewm": "laden_dwt_sum"}),
    ("lane_transit_time_range", "lane_transit_time_daily", "q3", "lane_id", "L1", {"p50_hours": "round(transit_time_p50_s / 3600e0, 6)", "p90_hours": "round(transit_time_p90_s / 3600e0, 6)", "mean_hours": "round(transit_time_mean_s / 3600e0, 6)"}),
    ("area_occupancy_range", "area_occupancy_daily", "q4", "area_id", "P0a", {"avg_cnt": "round(avg_open_sessions, 6)", "p50_cnt": "p50_open_sessions"}),
    ("ballast_range", "ballast_return_daily", "q5", "lane_id", "L0", {"ballast_dwt_ewm": "ballast_dwt"}),
):
    add(_name, f"SELECT day, {_key}, {', '.join(f'{v} AS {k}' for k, v in _cols.items())} FROM {_cte} WHERE {_key} = '{_value}' AND {_IN}")(
        lambda t, m=_mart, k=_key, v=_value, c=_cols: dashboard.in_range(t.mart(m), k, v, *RANGE, **c)
    )

_TOTAL = "coalesce(dwt_vlcc, 0) + coalesce(dwt_suezmax, 0) + coalesce(dwt_aframax, 0) + coalesce(dwt_other, 0)"
_SHARE = ", ".join(f"round(CAST(coalesce(dwt_{c}, 0) AS DOUBLE) / nullif({_TOTAL}, 0), 6) AS {c}_share" for c in ("vlcc", "suezmax", "aframax"))


@add("class_mix_shares", f"SELECT day, lane_id, {_SHARE} FROM q6")
def _(t):
    return dashboard.class_mix_shares(t.mart("class_mix_daily")).withColumns({f"{c}_share": F.round(f"{c}_share", 6) for c in ("vlcc", "suezmax", "aframax")})


@add(
    "class_mix_integer_shares",
    f"SELECT day, lane_id, {', '.join(f'CAST(coalesce(dwt_{c}, 0) // nullif({_TOTAL}, 0) AS BIGINT) AS {c}_share' for c in ('vlcc', 'suezmax', 'aframax'))} FROM q6",
)
def _(t):
    return dashboard.class_mix_shares(t.mart("class_mix_daily"), integer_shares=True)


@add(
    "routing_share",
    "SELECT coalesce(a.day, b.day) AS day, dwt_a, dwt_b, round(dwt_a / nullif(dwt_a + dwt_b, 0), 6) AS share_a FROM (SELECT day, laden_dwt_sum AS dwt_a FROM q2 WHERE lane_id = 'L0') a FULL JOIN (SELECT day, laden_dwt_sum AS dwt_b FROM q2 WHERE lane_id = 'L1') b ON a.day = b.day",
)
def _(t):
    return dashboard.routing_share(t.mart("lane_transit_daily"), "L0", "L1").withColumn("share_a", F.round("share_a", 6))


def _polygon(box) -> str:
    return json.dumps({"type": "Polygon", "coordinates": [geo.rectangle(*box)]}, separators=(",", ":"))


def _values(rows: list[tuple], names: str) -> str:
    text = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) v({names})"


_kinds = {a[0]: (a[1], a[3]) for a in fixture.AREAS}


@add("areas_geojson", _values([(a[0], f"Name {a[0]}", a[1], a[2], a[3], _polygon(a[5:])) for a in fixture.AREAS], 'area_id, name, kind, subtype, "group", geojson'), base=False)
def _(t):
    return geofence.geojson(t.areas, 0.01)


@add("gates_geojson", _values([(g[0], g[1], f"Name {g[0]}", _kinds[g[1]][0], f"gate_{g[2]}", _kinds[g[1]][1], _polygon(g[3:])) for g in fixture.GATES], 'gate_id, area_id, name, kind, subtype, "group", geojson'), base=False)
def _(t):
    return geofence.geojson(t.gates, 0.01)


@add(
    "geofence_load",
    _values(
        [("area", f"Name {a[0]} // {a[1]}", None, f"Name {a[0]}", a[1], a[2], a[3], _polygon(a[5:])) for a in fixture.AREAS]
        + [("gate", f"Name {g[0]} // {_kinds[g[1]][0]}", f"Name {g[1]} // {_kinds[g[1]][0]}", f"Name {g[0]}", _kinds[g[1]][0], f"gate_{g[2]}", _kinds[g[1]][1], _polygon(g[3:])) for g in fixture.GATES],
        'what, id, parent, name, kind, subtype, "group", geojson',
    ),
    base=False,
)
def _(t):
    """A GeoJSON file read, its gates linked, its polygons simplified."""
    areas, gates = geofence.load_geofences(t.spark, fixture.geojson_file(t.spark))
    areas = areas.withColumns({"id": F.col("area_id"), "parent": F.lit(None).cast("string"), "what": F.lit("area")})
    gates = gates.withColumns({"id": F.col("gate_id"), "parent": F.col("area_id"), "what": F.lit("gate"), "flow_role": F.lit(None).cast("string")})
    columns = ("what", "id", "parent", "name", "kind", "subtype", "group", "geojson")
    return geofence.geojson(areas, 0.01).select(*columns).unionByName(geofence.geojson(gates, 0.01).select(*columns))


@add("link_gates", "SELECT g.id AS gate_id, a.id AS area_id FROM gate g LEFT JOIN area a ON a.kind = g.kind AND a.subtype = 'corridor' AND a.grp IS NOT DISTINCT FROM g.grp")
def _(t):
    return geofence.link_gates(t.gates, t.areas).select("gate_id", "area_id")


@add("seed_summary", _values([("areas_inserted", 8), ("gates_total", 4), ("gates_linked", 4), ("gates_unmatched", 0)], "what, num"), base=False)
def _(t):
    return geofence.seed_summary(t.areas, t.gates)


@add("map_centre", "SELECT round(avg((xmin + xmax) / 2), 6) AS lon, round(avg((ymin + ymax) / 2), 6) AS lat FROM area")
def _(t):
    return geofence.map_centre(t.areas).select(F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@add("geofence_envelopes", "SELECT round(CAST(xmin AS DOUBLE) - 0.15e0, 6) AS xmin, round(CAST(ymin AS DOUBLE) - 0.15e0, 6) AS ymin, round(CAST(xmax AS DOUBLE) + 0.15e0, 6) AS xmax, round(CAST(ymax AS DOUBLE) + 0.15e0, 6) AS ymax FROM (SELECT xmin, ymin, xmax, ymax FROM area UNION ALL SELECT xmin, ymin, xmax, ymax FROM gate)")
def _(t):
    return geofence.envelopes(t.areas, t.gates).select(*(F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


@add("bbox_prefilter", "SELECT arrival_seq FROM fx WHERE EXISTS (SELECT 1 FROM (SELECT xmin, ymin, xmax, ymax FROM area UNION ALL SELECT xmin, ymin, xmax, ymax FROM gate) b WHERE lon BETWEEN xmin - 0.15 AND xmax + 0.15 AND lat BETWEEN ymin - 0.15 AND ymax + 0.15)")
def _(t):
    return normalize.near_any(t.labelled.select("arrival_seq", "lon", "lat"), geofence.envelopes(t.areas, t.gates)).select("arrival_seq")


@add("aggregate_row_counts", " UNION ALL ".join(f"SELECT '{m}' AS rel, count(*) AS rows FROM {q} WHERE day >= TIMESTAMP '2024-01-20'" for m, q in zip(MARTS, ("q1", "q2", "q5", "q6", "q3", "q4"))))
def _(t):
    return dashboard.row_counts(t.marts(), dt.datetime(2024, 1, 20))


@add(
    "table_health",
    """SELECT 'fixes' AS rel, count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS days, true AS sized, 'zstd' AS codec FROM ac
    UNION ALL SELECT 'events', count(*), count(DISTINCT CAST(ts AS DATE)), true, 'zstd' FROM ev""",
)
def _(t):
    """Both fact tables are written as facts are, and looked at on disk."""
    fixes = refresh.written(t.fixes, "fixes", refresh.append_fact)
    t.fixes = fixes.drop("date")
    written = {"fixes": fixes, "events": refresh.written(t.events, "events", refresh.append_fact)}
    health = refresh.table_health(t.spark, {k: refresh.path_of(v) for k, v in written.items()})
    return health.select(F.col("table").alias("rel"), "rows", "days", (F.col("total_bytes") > 0).alias("sized"), "codec")


@add(
    "ml_features_daily",
    """SELECT * FROM (SELECT day, CAST(sum(depart_dwt_laden) AS BIGINT) AS depart_dwt, CAST(sum(arrive_dwt_laden) AS BIGINT) AS arrive_dwt FROM q1 GROUP BY 1)
    FULL JOIN (SELECT day, CAST(sum(transit_cnt) AS BIGINT) AS transits, CAST(sum(laden_dwt_sum) AS BIGINT) AS laden_dwt FROM q2 GROUP BY 1) USING (day)
    FULL JOIN (SELECT day, round(avg(transit_time_p50_s), 3) AS p50_s FROM q3 GROUP BY 1) USING (day) FULL JOIN (SELECT day, round(avg(avg_open_sessions), 6) AS occupancy FROM q4 GROUP BY 1) USING (day)
    FULL JOIN (SELECT day, CAST(sum(ballast_dwt) AS BIGINT) AS ballast_dwt FROM q5 GROUP BY 1) USING (day)
    FULL JOIN (SELECT day, CAST(sum(dwt_vlcc) AS BIGINT) AS vlcc_dwt, CAST(sum(dwt_suezmax) AS BIGINT) AS suezmax_dwt, CAST(sum(dwt_aframax) AS BIGINT) AS aframax_dwt, CAST(sum(dwt_other) AS BIGINT) AS other_dwt FROM q6 GROUP BY 1) USING (day)""",
)
def _(t):
    return marts.ml_features_daily(t.marts())


@add(
    "ewma",
    """, s AS (SELECT lane_id, day, CAST(coalesce(laden_dwt_sum, 0) AS DOUBLE) AS x, row_number() OVER (PARTITION BY lane_id ORDER BY day) AS i FROM q2),
    y AS (SELECT lane_id, day, i, x AS y FROM s WHERE i = 1 UNION ALL SELECT s.lane_id, s.day, s.i, 0.3e0 * s.x + (1 - 0.3e0) * y.y FROM y JOIN s ON s.lane_id = y.lane_id AND s.i = y.i + 1) SELECT lane_id, day, round(y, 4) AS ewma FROM y""",
)
def _(t):
    return marts.ewma(t.mart("lane_transit_daily"), "lane_id", "laden_dwt_sum")


@add("explorer", f"SELECT lane_id, count(*) AS n, round(avg(sog), 4) AS sog FROM lb WHERE lane_id IS NOT NULL AND sog >= 5 GROUP BY lane_id")
def _(t):
    return dashboard.explore(t.spark, {"ais_fix": t.labelled}, "SELECT lane_id, count(*) AS n, round(avg(sog), 4) AS sog FROM ais_fix WHERE lane_id IS NOT NULL AND sog >= :least GROUP BY lane_id", least=5)


@add("closed_dwells", "SELECT vessel_uid, area_id, start_ts, end_ts, duration_s FROM dw WHERE NOT is_open ")
def _(t):
    return t.sessions.where("NOT is_open").select("vessel_uid", "area_id", "start_ts", "end_ts", "duration_s").orderBy(F.desc("end_ts"), "vessel_uid", "area_id", "start_ts")


@add("recent_fixes", "SELECT arrival_seq, ts, vessel_uid FROM lb ORDER BY ts DESC, arrival_seq DESC LIMIT 100")
def _(t):
    return t.labelled.select("arrival_seq", "ts", "vessel_uid").orderBy(F.desc_nulls_first("ts"), F.desc("arrival_seq")).limit(100)


_TILE = """WITH b AS (SELECT * FROM box), t AS (SELECT owner, z, CAST(floor((x0 + 180) / 360 * pow(2, z)) AS INT) AS xa, CAST(floor((x1 + 180) / 360 * pow(2, z)) AS INT) AS xb,
 CAST(floor((1 - ln(tan(radians(y1)) + 1 / cos(radians(y1))) / pi()) / 2 * pow(2, z)) AS INT) AS ya, CAST(floor((1 - ln(tan(radians(y0)) + 1 / cos(radians(y0))) / pi()) / 2 * pow(2, z)) AS INT) AS yb FROM b)
 SELECT DISTINCT owner, z, CAST(x // 2 AS INT) AS x, CAST(y // 2 AS INT) AS y FROM t, LATERAL (SELECT unnest(range(xa, xb + 1)) AS x) i, LATERAL (SELECT unnest(range(ya, yb + 1)) AS y) j"""
_z = {("port", "core"): 7, ("port", "approach"): 6, ("lane", "corridor"): 5, ("chokepoint", "corridor"): 6}
_boxes = [(a[0], _z[a[1:3]], a[5] - 0.2, a[6] - 0.2, a[7] + 0.2, a[8] + 0.2) for a in fixture.AREAS] + [(f"{g[1]}::{g[0]}", 6, g[3] - 0.3, g[4] - 0.3, g[5] + 0.3, g[6] + 0.3) for g in fixture.GATES]


_COVER = _TILE.replace("SELECT * FROM box", _values([(o, z, *map(float, b)) for o, z, *b in _boxes], "owner, z, x0, y0, x1, y1"))


@add("tile_cover", _COVER, base=False)
def _(t):
    return dashboard.tile_cover(t.areas, t.gates)


_LISTED = "string_agg(z || '/' || x || '/' || y, ';' ORDER BY z, x, y)"


@add("tile_list", f"SELECT {_LISTED} AS tiles FROM (SELECT DISTINCT z, x, y FROM ({_COVER}))", base=False)
def _(t):
    return dashboard.tile_list(dashboard.tile_cover(t.areas, t.gates))


@add("tile_breakdown", f"SELECT owner, count(*) AS n_tiles, {_LISTED} AS tiles FROM ({_COVER}) GROUP BY owner", base=False)
def _(t):
    return dashboard.tile_breakdown(dashboard.tile_cover(t.areas, t.gates))


@add(
    "tile_rounds",
    f"""WITH d AS (SELECT DISTINCT z, x, y FROM ({_COVER})), n AS (SELECT *, row_number() OVER (ORDER BY z, x, y) - 1 AS n, count(*) OVER () AS total FROM d)
    SELECT CAST(s // 8 AS INT) AS cycle, CAST(s % 8 AS INT) AS place, z, x, y, '/z:' || z || '/X:' || x || '/Y:' || y || '/station:0' AS path FROM (SELECT unnest(range(64)) AS s) JOIN n ON s % total = n""",
    base=False,
)
def _(t):
    return dashboard.tile_rounds(dashboard.tile_cover(t.areas, t.gates))


@add("tile_candidates", _values([("xyz", 6, 33, 30), ("tms", 6, 33, 33), ("xyz_up", 5, 16, 15), ("tms_up", 5, 16, 16), ("xyz", 0, 0, 0), ("tms", 0, 0, 0)], "kind, z, x, y"), base=False)
def _(t):
    return dashboard.tile_candidates(t.spark.createDataFrame([(6, 33, 30), (0, 0, 0)], "z int, x int, y int"))


class Legs:
    """Geofences made of the events, as many as vessels have legs."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        areas = fixture.leg_areas(spark, sf_dir)
        self.spark, self.gates = spark, fixture.leg_gates(areas)
        self.areas = areas.drop("leg", "xmin", "ymin", "ymax")


def _grown(c: float, table: str, owner: str, z: str) -> str:
    return f"SELECT {owner} AS owner, {z} AS z, xmin - {c}e0 AS x0, ymin - {c}e0 AS y0, xmax + {c}e0 AS x1, ymax + {c}e0 AS y1 FROM {table}"


_Z = f"CASE WHEN kind = 'lane' THEN {_z['lane', 'corridor']} WHEN subtype = 'core' THEN {_z['port', 'core']} ELSE {_z['port', 'approach']} END"
_LEG_COVER = _TILE.replace("SELECT * FROM box", f"{_grown(0.2, 'da', 'id', _Z)} UNION ALL {_grown(0.3, 'dg', chr(39).join(('area_id || ', '::', ' || id')), '6')}")
_RING = "'{\"type\":\"Polygon\",\"coordinates\":[[[' || xmin || ',' || ymin || '],[' || xmax || ',' || ymin || '],[' || xmax || ',' || ymax || '],[' || xmin || ',' || ymax || '],[' || xmin || ',' || ymin || ']]]}'"
for _name, _select in {
    "area_ports": "SELECT id AS area_id, name FROM da WHERE kind = 'port'",
    "lanes": "SELECT id AS lane_id, name FROM da WHERE kind IN ('lane', 'chokepoint')",
    "approaches": "SELECT id AS area_id, name FROM da WHERE subtype = 'approach'",
    "areas_geojson": f'SELECT id AS area_id, name, kind, subtype, grp AS "group", {_RING} AS geojson FROM da',
    "gates_geojson": f'SELECT id AS gate_id, area_id, name, kind, subtype, grp AS "group", {_RING} AS geojson FROM dg',
    "link_gates": "SELECT g.id AS gate_id, a.id AS area_id FROM dg g LEFT JOIN da a ON a.kind = g.kind AND a.subtype = 'corridor' AND a.grp IS NOT DISTINCT FROM g.grp",
    "seed_summary": """SELECT 'areas_inserted' AS what, count(*) AS num FROM da UNION ALL SELECT 'gates_total', count(*) FROM dg
        UNION ALL SELECT 'gates_linked', count(area_id) FROM dg UNION ALL SELECT 'gates_unmatched', count(*) - count(area_id) FROM dg""",
    "map_centre": "SELECT round(avg((xmin + xmax) / 2), 6) AS lon, round(avg((ymin + ymax) / 2), 6) AS lat FROM da",
    "geofence_envelopes": "SELECT round(xmin - 0.15e0, 6) AS xmin, round(ymin - 0.15e0, 6) AS ymin, round(xmax + 0.15e0, 6) AS xmax, round(ymax + 0.15e0, 6) AS ymax FROM (SELECT xmin, ymin, xmax, ymax FROM da UNION ALL SELECT xmin, ymin, xmax, ymax FROM dg)",
    "tile_cover": f"SELECT * FROM ({_LEG_COVER})",
    "tile_list": f"SELECT {_LISTED} AS tiles FROM (SELECT DISTINCT z, x, y FROM ({_LEG_COVER}))",
    "tile_breakdown": f"SELECT owner, count(*) AS n_tiles, {_LISTED} AS tiles FROM ({_LEG_COVER}) GROUP BY owner",
    "tile_rounds": f"""SELECT CAST(s // 8 AS INT) AS cycle, CAST(s % 8 AS INT) AS place, z, x, y, '/z:' || z || '/X:' || x || '/Y:' || y || '/station:0' AS path FROM (SELECT unnest(range(64)) AS s)
        JOIN (SELECT *, row_number() OVER (ORDER BY z, x, y) - 1 AS n, count(*) OVER () AS total FROM (SELECT DISTINCT z, x, y FROM ({_LEG_COVER}))) ON s % total = n""",
}.items():
    add_with_dir(f"leg_{_name}", sql(_select, tables=LEGS))(lambda spark, sf_dir, f=_made[_name]: f(Legs(spark, sf_dir)))


@add_with_dir(
    "leg_tile_candidates",
    sql(
        f"""SELECT * FROM (WITH t AS (SELECT DISTINCT z, x, y FROM ({_LEG_COVER})) SELECT 'xyz' AS kind, z, x, y FROM t UNION ALL SELECT 'tms', z, x, CAST(pow(2, z) AS INT) - 1 - y FROM t
        UNION ALL SELECT 'xyz_up', z - 1, CAST(x // 2 AS INT), CAST(y // 2 AS INT) FROM t UNION ALL SELECT 'tms_up', z - 1, CAST(x // 2 AS INT), CAST(CAST(pow(2, z - 1) AS INT) - 1 - y // 2 AS INT) FROM t)""",
        tables=LEGS,
    ),
)
def _(spark, sf_dir):
    t = Legs(spark, sf_dir)
    return dashboard.tile_candidates(dashboard.tile_cover(t.areas, t.gates).select("z", "x", "y").distinct())


@add_with_dir(
    "normalize_rows",
    """WITH r AS (SELECT *, event_id % 800 AS el, user_id % 20 + 70 AS st, event_id % 100 - 5 AS la, event_id % 200 - 10 AS lo, event_id % 400 AS sp, dense_rank() OVER (ORDER BY ts, event_id) - 1 AS doc FROM events)
    SELECT CASE WHEN event_id % 13 = 0 THEN ts ELSE ts - to_minutes(el) END AS ts, 'terrestrial' AS src,
      CASE WHEN user_id % 2 = 0 THEN 'mmsi:' || (200000000 + user_id) WHEN user_id % 3 = 0 THEN 'imo:' || (9000000 + user_id) ELSE 'mtid:' || user_id END AS vessel_uid,
      CAST(la || '.5' AS DOUBLE) AS lat, CAST(lo AS DOUBLE) AS lon, CAST(sp / 10e0 AS FLOAT) AS sog, CAST(event_id % 720 * 0.5e0 AS FLOAT) AS cog, CAST(event_id % 360 AS SMALLINT) AS heading,
      CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(el AS INT) END AS elapsed, 'Port ' || (user_id % 5) AS destination, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'PA' END AS flag,
      CAST(user_id % 300 + 0.5e0 AS FLOAT) AS length_m, CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(32 AS FLOAT) END AS width_m,
      CAST(event_id % 1000 AS INT) AS dwt, 'Vessel ' || user_id AS shipname, CAST(st AS SMALLINT) AS shiptype, CAST(user_id AS VARCHAR) AS ship_id, CAST(-(event_id % 9 + 1) AS FLOAT) AS rot,
      doc * 1073741824 AS arrival_seq
    FROM r WHERE st >= 80 AND (event_id % 13 = 0 OR el <= 720) AND CAST(la || '.5' AS DOUBLE) BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 AND event_id % 11 <> 0 AND sp <= 350""",
)
def _(spark, sf_dir):
    documents = fixture.payloads(spark, sf_dir)
    rows = payload.with_arrival(normalize.normalise(payload.explode_rows(documents)), documents)
    return rows.drop("fetch_ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


#: Crowded documents: an event's document, its vessel, the time that it is observed at, and its place among the document's rows.
_CROWD = f"""cr AS (SELECT e1.*, event_id // {fixture.CROWD} AS doc, TIMESTAMP '2024-01-01' + to_days(CAST(event_id // {2 * fixture.CROWD} AS INT)) AS fetch_ts FROM e1),
co AS (SELECT *, fetch_ts - to_minutes(event_id * 37 % 700) AS seen FROM cr),
cs AS (SELECT *, (dense_rank() OVER (ORDER BY fetch_ts, doc) - 1) * 1073741824 + row_number() OVER (PARTITION BY doc ORDER BY 'mmsi:' || (200000000 + user_id), seen, event_id * 7919 % 4993, event_id) - 1 AS seq FROM co)"""


@add_with_dir("arrival_order", sql(f"SELECT seq AS arrival_seq, 'mmsi:' || (200000000 + user_id) AS vessel_uid, seen AS ts FROM cs WHERE event_id % 31 <> 0 AND event_id % 29 <> 3 AND value <= 350", tables=_CROWD))
def _(spark, sf_dir):
    documents = fixture.crowded_payloads(spark, sf_dir)
    rows = payload.with_arrival(normalize.normalise(payload.explode_rows(documents)), documents)
    return rows.select("arrival_seq", "vessel_uid", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _from_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, Tables]:
    """The way of a vendor document to the marts: documents, raw rows, fixes, and the tables made from them."""
    documents = fixture.track_payloads(spark, sf_dir)
    raw = payload.explode_rows(documents)
    kept = payload.with_arrival(normalize.normalise(raw), documents).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return documents, raw, kept, Tables(spark, sf_dir, kept)


_TAKEN = "event_id % 23 <> 5 AND event_id % 19 <> 0 AND event_id % 7 <> 3 AND event_id % 17 <> 0 AND value <= 350"


@add_with_dir("pipeline_from_payloads", sql("SELECT * EXCLUDE (arrival_seq) FROM ev", _TAKEN))
def _(spark, sf_dir):
    return _from_payloads(spark, sf_dir)[3].events.drop("arrival_seq")


@add_with_dir("lane_transit_from_payloads", sql("SELECT * FROM q2", _TAKEN))
def _(spark, sf_dir):
    return _from_payloads(spark, sf_dir)[3].mart("lane_transit_daily")


@add_with_dir(
    "cycle_summary",
    sql(
        f"""SELECT date_trunc('day', e.ts) AS cycle, count(*) AS tiles, count(*) FILTER (WHERE event_id % 23 <> 5) AS tiles_ok, count(*) FILTER (WHERE event_id % 23 <> 5) AS received,
        count(*) FILTER (WHERE {_TAKEN}) AS kept, count(ac.arrival_seq) AS inserted FROM events e LEFT JOIN ac ON ac.arrival_seq = e.event_id GROUP BY 1""",
        _TAKEN,
    ),
)
def _(spark, sf_dir):
    documents, raw, kept, tables = _from_payloads(spark, sf_dir)
    return dashboard.cycle_summary(documents, raw, kept, tables.fixes)


@add_with_dir(
    "run_summary",
    sql(
        f"""SELECT count(*) AS tiles, count(*) FILTER (WHERE event_id % 23 <> 5) AS tiles_ok, count(*) FILTER (WHERE event_id % 23 <> 5) AS received, count(*) FILTER (WHERE {_TAKEN}) AS kept,
        count(ac.arrival_seq) AS inserted FROM events e LEFT JOIN ac ON ac.arrival_seq = e.event_id""",
        _TAKEN,
    ),
)
def _(spark, sf_dir):
    """All documents as one run that writes its fixes, counted as they pass."""
    documents = fixture.track_payloads(spark, sf_dir)

    def follow(rows: DataFrame) -> DataFrame:
        return Tables(spark, sf_dir, payload.with_arrival(rows, documents).withColumn("ts", F.col("ts").cast("timestamp_ntz"))).fixes

    counts = dashboard.observed_run(documents, follow, lambda rows: refresh.append_fact(rows, refresh.scratch(spark, "fixes")))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)
