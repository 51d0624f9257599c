"""DuckDB statements for the driver's comparison: the same results from plain SQL over `events`."""

from __future__ import annotations

from vesselflow.sources.fixture import AREAS, GATES, LEG


def _v(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{float(x)!r}"


_AREA = ", ".join("(" + ", ".join(map(_v, (a[0], f"Name {a[0]}", *a[1:]))) + ")" for a in AREAS)
_KIND = {a[0]: (a[1], a[3]) for a in AREAS}
_GATE = ", ".join("(" + ", ".join(map(_v, (g[0], g[1], _KIND[g[1]][0], f"gate_{g[2]}", _KIND[g[1]][1], g[2], *g[3:]))) + ")" for g in GATES)


def _pick(table: str, column: str, where: str) -> str:
    return f"(SELECT {column} FROM {table} a WHERE {where} AND k.lon BETWEEN a.xmin AND a.xmax AND k.lat BETWEEN a.ymin AND a.ymax ORDER BY (a.xmax - a.xmin) * (a.ymax - a.ymin), a.id LIMIT 1)"


def _m(a: str, b: str) -> str:
    return f"2 * 6371008.77 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"


_E2 = "0.0066943799901413165"
_MID = "sin(radians((x.p.lat + x.c.lat) / 2))"
_NEAR = (
    f"sqrt(pow(6378137.0 * (1 - {_E2}) / pow(1 - {_E2} * pow({_MID}, 2), 1.5) * radians(x.c.lat - x.p.lat), 2)"
    f" + pow(6378137.0 / sqrt(1 - {_E2} * pow({_MID}, 2)) * cos(radians((x.p.lat + x.c.lat) / 2)) * radians(x.c.lon - x.p.lon), 2)) <= 25"
)

BASE = f"""
area(id, name, kind, subtype, grp, role, xmin, ymin, xmax, ymax) AS (VALUES {_AREA}),
gate(id, area_id, kind, subtype, grp, side, xmin, ymin, xmax, ymax) AS (VALUES {_GATE}),
e0 AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k, (epoch_us(ts) // 3600000000 + user_id * 7) % 240 AS ph FROM events),
e1 AS (SELECT *, CASE WHEN ph < 40 THEN 0e0 WHEN ph < 120 THEN (ph - 40) * 0.125e0 WHEN ph < 160 THEN 10e0 ELSE 10e0 - (ph - 160) * 0.125e0 END AS bx,
  CASE WHEN k < 30 THEN 0e0 ELSE (k - 50) * 0.004e0 END AS j FROM e0),
fx AS (SELECT event_id AS arrival_seq, ts, 'terrestrial' AS src, 'mmsi:' || (200000000 + user_id) AS vessel_uid,
  (CASE WHEN user_id % 3 = 2 AND bx > 4.5e0 AND bx < 6.5e0 THEN 6.5e0 ELSE 0.5e0 END) + j + (CASE WHEN k >= 97 THEN 20e0 ELSE 0e0 END) AS lat, bx + 0.5e0 + j AS lon,
  CAST(value / 10e0 AS FLOAT) AS sog, CAST(k * 3.6e0 AS FLOAT) AS cog, CAST(NULL AS SMALLINT) AS heading,
  CAST(CASE user_id % 5 WHEN 0 THEN 300000 WHEN 1 THEN 150000 WHEN 2 THEN 100000 WHEN 3 THEN 50000 END AS INT) AS dwt, 'Vessel ' || user_id AS shipname FROM e1),
lb AS (SELECT k.*, {_pick("area", "id", "a.kind = 'port' AND a.subtype = 'core'")} AS area_id_core, {_pick("area", "id", "a.kind = 'port' AND a.subtype = 'approach'")} AS area_id_approach,
  {_pick("area", "id", "a.subtype = 'corridor'")} AS lane_id, {_pick("gate", "id", "true")} AS gate_id, {_pick("gate", "side", "true")} AS gate_end FROM fx k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vessel_uid ORDER BY arrival_seq) AS rn,
  struct_pack(us := epoch_us(ts), lat := lat, lon := lon, sog := sog, cog := cog, a := area_id_core, b := area_id_approach, l := lane_id, g := gate_id) AS c FROM lb),
fold AS (
  SELECT vessel_uid, rn, arrival_seq, true AS keep, c AS p, CAST(NULL AS STRUCT(us BIGINT, lat DOUBLE, lon DOUBLE, sog FLOAT, cog FLOAT, a VARCHAR, b VARCHAR, l VARCHAR, g VARCHAR)) AS q FROM ranked WHERE rn = 1
  UNION ALL
  SELECT vessel_uid, rn, arrival_seq, keep, CASE WHEN keep THEN c ELSE p END, CASE WHEN keep THEN p ELSE q END FROM (
    SELECT r.vessel_uid, r.rn, r.arrival_seq, r.c AS c, d.p AS p, d.q AS q, CASE
      WHEN d.p.us - r.c.us > 2000000 THEN false
      WHEN x.c.lat = x.p.lat AND x.c.lon = x.p.lon THEN false
      WHEN {_NEAR} AND abs(x.c.sog - x.p.sog) <= 0.3e0 AND least(abs(x.c.cog - x.p.cog), 360 - abs(x.c.cog - x.p.cog)) <= 1e0
        AND x.c.a IS NOT DISTINCT FROM x.p.a AND x.c.b IS NOT DISTINCT FROM x.p.b AND x.c.l IS NOT DISTINCT FROM x.p.l AND x.c.g IS NOT DISTINCT FROM x.p.g THEN false
      WHEN x.c.us <= x.p.us THEN false
      WHEN {_m("x.p", "x.c")} / 1852.0 / ((x.c.us - x.p.us) / 3.6e9) > 30 THEN false
      WHEN x.q IS NOT NULL AND {_m("x.q", "x.c")} <= 300 AND {_m("x.p", "x.c")} >= 2000 THEN false
      ELSE true END AS keep
    FROM fold d JOIN ranked r ON r.vessel_uid = d.vessel_uid AND r.rn = d.rn + 1, LATERAL (SELECT r.c AS c, d.p AS p, d.q AS q) x)),
ac AS (SELECT l.* FROM lb l JOIN fold f USING (arrival_seq) WHERE f.keep),
t0 AS (SELECT *, lag(area_id_core) OVER w AS b_core, lag(area_id_approach) OVER w AS b_approach, lag(lane_id) OVER w AS b_lane FROM ac WINDOW w AS (PARTITION BY vessel_uid ORDER BY arrival_seq)),
t1 AS (SELECT t0.*, x.role AS exit_role, n.role AS enter_role, b_core IS DISTINCT FROM area_id_core AS moved FROM t0 LEFT JOIN area x ON x.id = b_core LEFT JOIN area n ON n.id = area_id_core),
t2 AS (SELECT *, CASE WHEN moved AND b_core IS NOT NULL THEN CASE exit_role WHEN 'export' THEN true WHEN 'import' THEN false END END AS exit_laden,
  CASE WHEN moved AND area_id_core IS NOT NULL THEN CASE enter_role WHEN 'import' THEN true WHEN 'export' THEN false END END AS enter_laden FROM t1),
t3 AS (SELECT *, last_value(exit_laden IGNORE NULLS) OVER w AS le, first_value(enter_laden IGNORE NULLS) OVER w AS fe,
  last_value(CASE WHEN exit_laden IS NOT NULL THEN ts END IGNORE NULLS) OVER w AS lt, first_value(CASE WHEN enter_laden IS NOT NULL THEN ts END IGNORE NULLS) OVER w AS ft
  FROM t2 WINDOW w AS (PARTITION BY vessel_uid ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING)),
t4 AS (SELECT *, coalesce(le, fe) AS laden, CASE WHEN le IS NOT NULL THEN 'derived_port_exit' WHEN fe IS NOT NULL THEN 'derived_port_enter' END AS confidence, coalesce(lt, ft) AS cargo_ts FROM t3),
ev AS (
  SELECT ts, vessel_uid, arrival_seq, 0 AS ord, 'port_exit' AS event, b_core AS area_id, 'port' AS area_kind, CAST(NULL AS VARCHAR) AS gate_end, lat, lon, src, dwt, exit_laden AS laden,
    CASE WHEN exit_laden IS NULL THEN 'unknown' ELSE 'derived_port_exit' END AS cargo_confidence, CAST(NULL AS BOOLEAN) AS arrival_likely_laden, exit_role AS port_flow_role FROM t4 WHERE moved AND b_core IS NOT NULL
  UNION ALL SELECT ts, vessel_uid, arrival_seq, 1, 'port_enter', area_id_core, 'port', NULL, lat, lon, src, dwt, NULL, NULL, enter_laden, enter_role FROM t4 WHERE moved AND area_id_core IS NOT NULL
  UNION ALL SELECT ts, vessel_uid, arrival_seq, 2, CASE WHEN area_id_approach IS NULL THEN 'approach_exit' ELSE 'approach_enter' END, coalesce(area_id_approach, b_approach), 'approach', NULL, lat, lon, src, dwt,
    laden, confidence, NULL, NULL FROM t4 WHERE b_approach IS DISTINCT FROM area_id_approach
  UNION ALL SELECT ts, vessel_uid, arrival_seq, 3, CASE WHEN lane_id IS NULL THEN 'lane_exit' ELSE 'lane_enter' END, coalesce(lane_id, b_lane), 'lane', gate_end, lat, lon, src, dwt,
    laden, confidence, NULL, NULL FROM t4 WHERE b_lane IS DISTINCT FROM lane_id),
dn AS (SELECT *, coalesce(sum(CAST(ends_with(event, '_exit') AS INT)) OVER (PARTITION BY vessel_uid, area_id ORDER BY arrival_seq, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM ev),
dw AS (SELECT vessel_uid, area_id, any_value(area_kind) AS area_kind, min(ts) AS start_ts, max(CASE WHEN ends_with(event, '_exit') THEN ts END) AS end_ts,
  CASE WHEN max(CASE WHEN ends_with(event, '_exit') THEN ts END) IS NOT NULL THEN greatest(1, CAST(round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS BIGINT)) END AS duration_s,
  max(CASE WHEN ends_with(event, '_exit') THEN ts END) IS NULL AS is_open, CAST(count(*) AS INT) AS samples, arg_min(lat, arrival_seq * 4 + ord) AS first_lat, arg_min(lon, arrival_seq * 4 + ord) AS first_lon,
  arg_max(lat, arrival_seq * 4 + ord) AS last_lat, arg_max(lon, arrival_seq * 4 + ord) AS last_lon, 'event' AS source FROM dn GROUP BY vessel_uid, area_id, n),
q1 AS (SELECT date_trunc('day', ts) AS day, area_id AS port_id, a.name AS port_name, coalesce(a.role, 'mixed') AS flow_role,
  CAST(sum(e.dwt) FILTER (WHERE event = 'port_exit' AND coalesce(laden, CASE a.role WHEN 'export' THEN true WHEN 'import' THEN false END)) AS BIGINT) AS depart_dwt_laden,
  CAST(sum(e.dwt) FILTER (WHERE event = 'port_enter' AND coalesce(laden, CASE a.role WHEN 'import' THEN true WHEN 'export' THEN false END)) AS BIGINT) AS arrive_dwt_laden
  FROM ev e JOIN area a ON a.id = e.area_id WHERE area_kind = 'port' GROUP BY ALL),
q2 AS (SELECT date_trunc('day', ts) AS day, area_id AS lane_id, a.name AS lane_name, count(*) FILTER (WHERE event = 'lane_exit') AS transit_cnt,
  CAST(sum(e.dwt) FILTER (WHERE event = 'lane_exit' AND laden) AS BIGINT) AS laden_dwt_sum FROM ev e JOIN area a ON a.id = e.area_id WHERE area_kind = 'lane' GROUP BY ALL),
q3 AS (SELECT date_trunc('day', end_ts) AS day, area_id AS lane_id, CAST(quantile_disc(duration_s, 0.5) AS BIGINT) AS transit_time_p50_s, CAST(quantile_disc(duration_s, 0.9) AS BIGINT) AS transit_time_p90_s,
  avg(duration_s) AS transit_time_mean_s FROM dw WHERE area_kind = 'lane' AND NOT is_open GROUP BY ALL),
sn AS (SELECT time_bucket(INTERVAL 5 MINUTE, coalesce(end_ts, start_ts)) AS ts, area_id, max(CAST(is_open AS INT)) AS open_sessions FROM dw GROUP BY ALL),
q4 AS (SELECT date_trunc('day', ts) AS day, area_id, avg(open_sessions) AS avg_open_sessions, CAST(quantile_disc(open_sessions, 0.5) AS INT) AS p50_open_sessions FROM sn JOIN area a ON a.id = area_id
  WHERE a.kind = 'port' AND a.subtype = 'approach' GROUP BY ALL),
q5 AS (SELECT date_trunc('day', ts) AS day, area_id AS lane_id, CAST(sum(e.dwt) FILTER (WHERE event = 'lane_exit' AND NOT laden AND gate_end = 'west') AS BIGINT) AS ballast_dwt
  FROM ev e JOIN area a ON a.id = area_id WHERE area_kind = 'lane' AND a.grp IN ('Mid-Atlantic', 'Cape of Good Hope') GROUP BY ALL),
q6 AS (SELECT date_trunc('day', ts) AS day, area_id AS lane_id, CAST(sum(dwt) FILTER (WHERE event = 'lane_exit' AND dwt >= 200000) AS BIGINT) AS dwt_vlcc,
  CAST(sum(dwt) FILTER (WHERE event = 'lane_exit' AND dwt BETWEEN 120000 AND 199999) AS BIGINT) AS dwt_suezmax, CAST(sum(dwt) FILTER (WHERE event = 'lane_exit' AND dwt BETWEEN 80000 AND 119999) AS BIGINT) AS dwt_aframax,
  CAST(sum(dwt) FILTER (WHERE event = 'lane_exit' AND dwt < 80000) AS BIGINT) AS dwt_other FROM ev WHERE area_kind = 'lane' GROUP BY ALL)
"""


def labelled(name: str, fixes: str) -> str:
    """A common table: the rows of another one with what they are in."""
    return f"""{name} AS (SELECT k.*, {_pick("area", "id", "a.kind = 'port' AND a.subtype = 'core'")} AS area_id_core, {_pick("area", "id", "a.kind = 'port' AND a.subtype = 'approach'")} AS area_id_approach,
  {_pick("area", "id", "a.subtype = 'corridor'")} AS lane_id, {_pick("gate", "id", "true")} AS gate_id FROM {fixes} k)"""


#: fixture.leg_areas and fixture.leg_gates.
LEGS = f"""da AS (SELECT 'A' || user_id || '-' || (ph // {LEG}) AS id, 'Name ' || user_id || '-' || (ph // {LEG}) AS name, CASE user_id % 4 WHEN 2 THEN 'lane' WHEN 3 THEN 'chokepoint' ELSE 'port' END AS kind,
  CASE user_id % 4 WHEN 0 THEN 'core' WHEN 1 THEN 'approach' ELSE 'corridor' END AS subtype, 'G' || user_id || '-' || (ph // {LEG}) AS grp, ph // {LEG} AS leg,
  floor(min(lon)) AS xmin, floor(min(lat)) AS ymin, floor(max(lon)) + 1 AS xmax, floor(max(lat)) + 1 AS ymax
  FROM (SELECT *, bx + 0.5e0 + j AS lon, (CASE WHEN user_id % 3 = 2 AND bx > 4.5e0 AND bx < 6.5e0 THEN 6.5e0 ELSE 0.5e0 END) + j AS lat FROM e1 WHERE k < 97) GROUP BY user_id, ph // {LEG}),
dg AS (SELECT 'W' || id AS id, CASE WHEN subtype = 'corridor' THEN id END AS area_id, 'Gate ' || id AS name, kind, CASE WHEN leg % 4 = 0 THEN 'gate_west' ELSE 'gate_east' END AS subtype, grp,
  xmin - 0.5e0 AS xmin, ymin, xmin + 0.5e0 AS xmax, ymax FROM da WHERE leg % 2 = 0)"""

#: The fixes of fixture.echoed_fixes, and a fold that carries all that it has kept, as rows don't come in the order of time.
ECHOED = f"""fe AS (SELECT arrival_seq * 2 AS arrival_seq, ts, vessel_uid, lat, lon, sog, cog FROM fx
  UNION ALL SELECT arrival_seq * 2 + 1, ts - to_seconds(CASE arrival_seq % 5 WHEN 2 THEN 3 WHEN 3 THEN 0 ELSE 1 END), vessel_uid,
    lat + CASE arrival_seq % 5 WHEN 1 THEN 0.000001e0 ELSE 0.02e0 END, lon, sog, cog FROM fx WHERE arrival_seq % 5 < 4),
{labelled("le", "fe")},
re AS (SELECT *, row_number() OVER (PARTITION BY vessel_uid ORDER BY arrival_seq) AS rn,
  struct_pack(us := epoch_us(ts), lat := lat, lon := lon, sog := sog, cog := cog, a := area_id_core, b := area_id_approach, l := lane_id, g := gate_id) AS c FROM le),
fk AS (
  SELECT vessel_uid, rn, arrival_seq, 0 AS rule, [c] AS kept FROM re WHERE rn = 1
  UNION ALL
  SELECT vessel_uid, rn, arrival_seq, rule, CASE WHEN rule = 0 THEN list_sort(list_append(kept, c)) ELSE kept END FROM (
    SELECT r.vessel_uid, r.rn, r.arrival_seq, r.c AS c, d.kept AS kept, CASE
      WHEN d.kept[-1].us - x.c.us > 2000000 THEN 1
      WHEN x.p IS NULL THEN 0
      WHEN x.c.lat = x.p.lat AND x.c.lon = x.p.lon THEN 2
      WHEN {_NEAR} AND abs(x.c.sog - x.p.sog) <= 0.3e0 AND least(abs(x.c.cog - x.p.cog), 360 - abs(x.c.cog - x.p.cog)) <= 1e0
        AND x.c.a IS NOT DISTINCT FROM x.p.a AND x.c.b IS NOT DISTINCT FROM x.p.b AND x.c.l IS NOT DISTINCT FROM x.p.l AND x.c.g IS NOT DISTINCT FROM x.p.g THEN 4
      WHEN x.c.us <= x.p.us THEN 5
      WHEN {_m("x.p", "x.c")} / 1852.0 / ((x.c.us - x.p.us) / 3.6e9) > 30 THEN 6
      WHEN x.n IS NOT NULL AND {_m("x.n", "x.c")} / 1852.0 / ((x.n.us - x.c.us) / 3.6e9) > 30 THEN 7
      WHEN x.q IS NOT NULL AND {_m("x.q", "x.c")} <= 300 AND {_m("x.p", "x.c")} >= 2000 THEN 8
      ELSE 0 END AS rule
    FROM fk d JOIN re r ON r.vessel_uid = d.vessel_uid AND r.rn = d.rn + 1,
      LATERAL (SELECT r.c AS c, list_filter(d.kept, lambda k: k.us <= r.c.us)[-1] AS p, list_filter(d.kept, lambda k: k.us > r.c.us)[1] AS n,
        list_filter(d.kept, lambda k: k.us < list_filter(d.kept, lambda m: m.us <= r.c.us)[-1].us)[-1] AS q) x))"""


def sql(select: str, fixes: str = "true", tables: str = "") -> str:
    """The statement with the common tables that it needs and some of its own, over the events that meet a condition; later tables are not evaluated."""
    return f"WITH RECURSIVE {BASE.replace('AS shipname FROM e1)', f'AS shipname FROM e1 WHERE {fixes})')}{', ' if tables else ''}{tables} {select}"
