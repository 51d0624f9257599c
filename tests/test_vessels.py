"""Fold, events and sessions on hand-written tracks, random tracks against a plain fold, and the stream against the batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from vesselflow.operators import dedup, dwell, events, label, normalize
from vesselflow.plans import dashboard, marts, refresh
from vesselflow.sources import fixture, geofence, payload

T0 = dt.datetime(2024, 1, 1)
FIX = (
    "arrival_seq long, ts timestamp_ntz, src string, vessel_uid string, lat double, lon double, sog float, cog float, heading short, dwt int, area_id_core string, area_id_approach string, "
    "lane_id string, gate_id string, gate_end string"
)


def fix(n, seconds, lat, lon, uid="v", sog=1.0, cog=10.0, heading=None, core=None, approach=None, lane=None, end=None, dwt=100):
    return (n, T0 + dt.timedelta(seconds=seconds), "terrestrial", uid, lat, lon, sog, cog, heading, dwt, core, approach, lane, end and "g", end)


def kept(spark, rows):
    return sorted(r.arrival_seq for r in dedup.dedup(spark.createDataFrame(rows, FIX)).collect())


H = 3600


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([fix(0, 0, 0.0, 0.0), fix(1, 600, 0.0, 0.0, sog=9.0)], [0]),  # same point
        ([fix(0, 0, 0.0, 0.0), fix(1, 600, 0.0, 0.00018, sog=1.2)], [0]),  # 20 m, much the same
        ([fix(0, 0, 0.0, 0.0), fix(1, 600, 0.0, 0.00018, sog=1.4)], [0, 1]),  # 20 m, faster
        ([fix(0, 0, 0.0, 0.0, cog=359.5), fix(1, 600, 0.0, 0.00018, cog=0.4)], [0]),  # the turn wraps
        ([fix(0, 0, 0.0, 0.0), fix(1, 600, 0.0, 0.00018, lane="L")], [0, 1]),  # another lane
        ([fix(0, 0, 0.0, 0.0), fix(1, 600, 0.0, 0.00018, heading=5)], [0, 1]),  # heading known now
        ([fix(0, 100, 0.0, 0.0), fix(1, 97, 0.1, 0.1)], [0]),  # too late
        ([fix(0, 100, 0.0, 0.0), fix(1, 99, 0.1, 0.1)], [0, 1]),  # late within the slack, nothing before it
        ([fix(0, 0, 0.0, 0.0), fix(1, 0, 0.1, 0.1)], [0]),  # same time
        ([fix(0, 0, 0.0, 0.0), fix(1, H, 0.0, 1.67)], [0]),  # 100 nm in an hour
        ([fix(0, 0, 0.0, 0.0), fix(1, H, 0.0, 0.4)], [0, 1]),
        ([fix(0, 0, 0.0, 0.0), fix(1, H, 0.0, 0.045), fix(2, 2 * H, 0.0, 0.001)], [0, 1]),  # and back again
        ([fix(0, 0, 0.0, 0.0), fix(1, H, 0.0, 1.67), fix(2, 2 * H, 0.0, 0.1)], [0, 2]),  # compared with the last one kept
        ([fix(0, 0, 0.0, 0.0), fix(1, H, 0.0, 0.1), fix(2, H - 1, 0.0, 0.09)], [0, 1]),  # ten minutes' way to the next fix in a second
        ([fix(0, 0, 0.0, 0.0, uid=None), fix(1, 0, 0.0, 0.0, uid=None)], [0, 1]),
        ([fix(0, 0, 0.0, 0.0), fix(1, 1, 0.0, 0.0, uid="w")], [0, 1]),
        ([fix(0, 0, None, None), fix(1, H, None, None)], [0, 1]),
    ],
)
def test_rules_of_the_fold(spark, rows, want):
    assert kept(spark, rows) == want


def ports(spark):
    roles = {"X": "export", "I": "import", "M": None}
    return spark.createDataFrame([(a, a, "port", "core", a, None, [[]], r) for a, r in roles.items()], geofence.AREA)


def names(spark, rows):
    got = events.emit_events(spark.createDataFrame(rows, FIX), ports(spark)).orderBy("arrival_seq", "ord").collect()
    return [(r.arrival_seq, r.event, r.area_id, r.laden) for r in got]


def test_events(spark):
    assert names(spark, [fix(0, 0, 0.0, 0.0, core="X"), fix(1, 1, 0.0, 0.0, core="I")]) == [(0, "port_enter", "X", None), (1, "port_exit", "X", True), (1, "port_enter", "I", None)]
    assert names(spark, [fix(0, 0, 0.0, 0.0, approach="A"), fix(1, 1, 0.0, 0.0, approach="B"), fix(2, 2, 0.0, 0.0)]) == [
        (0, "approach_enter", "A", None),
        (1, "approach_enter", "B", None),
        (2, "approach_exit", "B", None),
    ]
    assert names(spark, [fix(0, 0, 0.0, 0.0, uid=None, core="X")]) == []
    rows = [fix(0, 0, 0.0, 0.0, lane="L"), fix(1, 1, 0.0, 0.0, end="west")]
    got = events.emit_events(spark.createDataFrame(rows, FIX), ports(spark)).orderBy("arrival_seq").collect()
    assert [(r.event, r.area_kind, r.gate_end) for r in got] == [("lane_enter", "lane", None), ("lane_exit", "lane", "west")]


def test_cargo_belief(spark):
    visits = ["X", None, "I", None, "M", None, "X", None]
    rows = [fix(i, i, 0.0, 0.0, core=c, lane=f"L{i}") for i, c in enumerate(visits)]
    got = [x for x in names(spark, rows) if x[1] == "lane_enter"]
    assert [x[3] for x in got] == [False, True, True, False, False, False, False, True]
    state = events.cargo_state(spark.createDataFrame(rows, FIX), ports(spark)).first()
    assert (state.laden, state.confidence, state.updated_ts) == (True, "derived_port_exit", T0 + dt.timedelta(seconds=7))


def sessions(spark, steps):
    rows = [(i, 0, T0 + dt.timedelta(seconds=s), "v", e, "A", "port", 1.0 * i, None if i == 2 else 2.0 * i) for i, (s, e) in enumerate(steps)]
    frame = spark.createDataFrame(rows, "arrival_seq long, ord int, ts timestamp_ntz, vessel_uid string, event string, area_id string, area_kind string, lat double, lon double")
    return dwell.dwell_sessions(frame).orderBy("start_ts").collect()


def test_sessions(spark):
    (s,) = sessions(spark, [(0, "port_enter"), (5, "port_enter"), (9.5, "port_exit")])
    assert (s.duration_s, s.samples, s.is_open, s.first_lat, s.last_lat, s.last_lon) == (10, 3, False, 0, 2, 2)
    (s,) = sessions(spark, [(3, "port_exit")])
    assert (s.duration_s, s.samples, s.start_ts == s.end_ts) == (1, 1, True)
    a, b = sessions(spark, [(0, "port_enter"), (1, "port_exit"), (2, "port_enter")])
    assert (a.duration_s, b.is_open, b.end_ts, b.duration_s) == (1, True, None, None)


def test_labels(spark):
    points = [(0, 0.5, 0.5), (1, 1.0, 1.0), (2, 1.5, 1.5), (3, 0.0, 3.6), (4, 0.0, 5.4), (5, 50.0, 50.0), (6, None, None)]
    fixes = spark.createDataFrame(points, "arrival_seq long, lat double, lon double")
    got = {r.arrival_seq: (r.area_id_core, r.area_id_approach, r.lane_id, r.gate_end, r.in_core) for r in label.label(fixes, fixture.areas(spark), fixture.gates(spark)).collect()}
    assert got[0] == ("P0c", "P0a", None, None, True) and got[1] == ("P0c", "P0a", None, None, True) and got[2] == (None, "P0a", None, None, False)
    assert got[3] == (None, None, "L0", "west", False) and got[4][2:4] == ("L0", "east") and got[5] == got[6] == (None, None, None, None, False)


def test_smallest_area_wins(spark):
    area = lambda i, *box: (i, i, "port", "core", None, None, [fixture.rectangle(*box)], None)
    areas = spark.createDataFrame([area("big", 0, 0, 3, 3), area("small", 1, 1, 2, 2), area("b", 5, 5, 6, 6), area("a", 5, 5, 6, 6)], geofence.AREA)
    fixes = spark.createDataFrame([(0, 1.5, 1.5), (1, 0.5, 0.5), (2, 5.5, 5.5)], "n long, lat double, lon double")
    got = label.label(fixes, areas, spark.createDataFrame([], geofence.GATE)).orderBy("n").collect()
    assert [r.area_id_core for r in got] == ["small", "big", "a"]


def vendor(**values):
    return {"SHIPTYPE": "80", "LAT": "1", "LON": "2", "SHIP_ID": "7", **values}


def test_normalise(spark, tmp_path):
    rows = [
        vendor(MMSI="123"),
        vendor(MMSI=0, IMO="456"),
        vendor(),
        vendor(SHIPTYPE="70"),
        vendor(SHIPTYPE="70", TYPE_NAME=" Tanker "),
        vendor(SHIPTYPE=None, TYPE_IMG="8"),
        vendor(SHIPTYPE=None, GT_SHIPTYPE=17),
        vendor(ELAPSED="721"),
        vendor(ELAPSED="-1"),
        vendor(ELAPSED="720", SPEED="350"),
        vendor(ELAPSED="5.5", SPEED=None),
        vendor(LAT="90.0001"),
        vendor(LAT="nan"),
        vendor(LAT=None),
        vendor(SPEED="351"),
        vendor(SHIP_ID="a/b+c="),
        vendor(SHIPNAME=" [sat-ais] "),
    ]
    (tmp_path / "a.json").write_text(json.dumps({"data": {"rows": rows}}))
    (tmp_path / "b.json").write_text("no json")
    (tmp_path / "c.json").write_text(json.dumps({"data": {"rows": []}}))
    raw = payload.explode_rows(payload.read_payloads(spark, str(tmp_path)))
    assert raw.count() == len(rows)
    out = normalize.normalise(raw)
    assert [f.name for f in out.schema] == [c.split()[0] for c in normalize.FIX.split(", ")] + ["fetch_ts", "path", "place"]
    assert [f.dataType.simpleString() for f in out.schema][:18] == [{"long": "bigint", "short": "smallint"}.get(c.split()[1], c.split()[1]) for c in normalize.FIX.split(", ")]
    got = {(r.vessel_uid, r.elapsed, r.sog) for r in out.collect()}
    assert got == {("mmsi:123", None, None), ("imo:456", None, None), ("mtid:7", None, None), ("mtid:7", 720, 35.0), ("mtid:7", 5, None)}
    assert out.count() == 8
    age = out.where("elapsed = 720").select((F.unix_seconds("fetch_ts") - F.unix_seconds("ts")).alias("s")).first()
    assert age.s == 720 * 60
    assert normalize.bad_fixes(out).count() == 0


def test_identities(spark):
    raw = spark.createDataFrame([tuple(None for _ in payload.KEYS)], ", ".join(f"{k} string" for k in payload.KEYS))
    uid = lambda **v: raw.withColumns({k: F.lit(x) for k, x in v.items()}).select(normalize.vessel_uid()).first()[0]
    assert uid(MMSI="x", IMO="9") == "imo:9" and uid(mmsi_lower=" 5 ") == "mmsi:5" and uid(SHIP_ID=" 12 ") == "mtid:12" and uid(SHIP_ID="ab=") == "sat:ab="
    assert uid(SHIPNAME="unknown").startswith("h:") and len(uid()) == 18 and uid(FLAG="pa") == uid(FLAG=" PA ") != uid()


def test_geofences(spark, tmp_path):
    def feature(name, kind, subtype, group, *box):
        return {"type": "Feature", "properties": {"name": name, "kind": kind, "subtype": subtype, "group": group, "notes": " "}, "geometry": {"type": "Polygon", "coordinates": [geofence.geo.rectangle(*box)]}}

    some = [
        feature(" Basrah ", "port", "core", "B", 0, 0, 1, 1),
        feature("Basrah", "port", "approach", "B", -1, -1, 2, 2),
        feature("Lane", "lane", "corridor", None, 5, 5, 6, 6),
        feature("W", "lane", "gate_west", "", 4, 5, 5, 6),
        feature("N", "chokepoint", "gate_north", "Q", 4, 5, 5, 6),
        feature("Amsterdam - core", "port", "core", "A", 20, 20, 21, 21),
        feature("Amsterdam - approach", "port", "approach", "A", 20.5, 20, 22, 22),
    ]
    for path, doc in (("a.json", {"type": "FeatureCollection", "features": some}), ("b.json", some)):
        (tmp_path / path).write_text(json.dumps(doc))
        areas, gates = geofence.load_geofences(spark, str(tmp_path / path))
        got = {r.area_id: (r.subtype, r.flow_role, r.notes) for r in areas.collect()}
        assert got == {"Basrah // port": ("approach", "export", None), "Lane // lane": ("corridor", None, None), "Amsterdam - core // port": ("core", "import", None), "Amsterdam - approach // port": ("approach", "import", None)}
        assert [(r.gate_id, r.area_id) for r in gates.collect()] == [("W // lane", "Lane // lane")]
    rows = geofence.read_features(spark, str(tmp_path / "a.json")).where("is_gate").withColumnRenamed("name", "gate_id")
    assert {r.what: r.num for r in geofence.seed_summary(areas, rows).collect()} == {"areas_inserted": 4, "gates_total": 2, "gates_linked": 1, "gates_unmatched": 1}
    assert geofence.violations(areas, gates).count() == 0
    assert [r.area_id for r in geofence.uncontained_cores(areas).collect()] == ["Amsterdam - core // port"]
    new = areas.where("name = 'Lane'").withColumn("notes", F.lit("seen")).withColumn("flow_role", F.lit("mixed"))
    after = {r.area_id: (r.notes, r.flow_role) for r in geofence.upsert(areas, new, "area_id", keep=("flow_role",)).collect()}
    assert len(after) == 4 and after["Lane // lane"] == ("seen", None)


def test_refresh_and_retention(spark, tmp_path):
    days = [(T0 + dt.timedelta(days=d), d) for d in range(5)]
    mart = spark.createDataFrame(days, "day timestamp_ntz, n long")
    path = f"file://{tmp_path}/mart"
    refresh.write_days(mart, path)
    newer = mart.withColumn("n", F.col("n") + 100)
    refresh.write_days(newer, path, *refresh.window(T0 + dt.timedelta(days=4, hours=5), 1))
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 1, 2, 103, 104]
    refresh.write_days(newer.where("n <> 103"), path, *refresh.window(T0 + dt.timedelta(days=4, hours=5), 1))
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 1, 2, 104]  # a day without rows goes
    refresh.write_days(newer, path, *refresh.window(T0 + dt.timedelta(days=4, hours=5), 1))
    assert refresh.expire(spark, path, 2, T0 + dt.timedelta(days=4)) == ["date=2024-01-01", "date=2024-01-02"]
    assert spark.read.parquet(path).count() == 3
    root = f"file://{tmp_path}/mv"
    for k in (1, 2, 3):
        old = refresh.current(spark, root) if k > 1 else None
        refresh.swap(mart.limit(k), root)
        assert refresh.current(spark, root).count() == k and (old is None or old.count() == k - 1)
    assert sum(p.name.startswith("v-") for p in (tmp_path / "mv").iterdir()) == 2  # the one before stays for its readers
    assert refresh.backfill_window(None, T0)[0] == T0 - dt.timedelta(days=180)
    start, end = refresh.policy_window(T0 + dt.timedelta(days=100, minutes=5))
    assert (start, end) == (T0 + dt.timedelta(days=11), T0 + dt.timedelta(days=99))
    health = refresh.table_health(spark, {"mart": path}).first()
    assert (health.rows, health.days, health.codec) == (3, 3, "snappy") and health.total_bytes > 0


def test_facts_are_appended_and_rewritten_by_vessel(spark, tmp_path):
    rows = [(T0 + dt.timedelta(hours=h), f"v{h % 5}", h) for h in range(72)]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, vessel_uid string, n int")
    path = f"file://{tmp_path}/facts"
    for part in range(3):
        refresh.append_fact(frame.where(F.col("n") % 3 == part), path)
    files = lambda day: len(list((tmp_path / "facts" / f"date=2024-01-0{day}").glob("*.parquet")))
    before = files(1), files(3)
    assert refresh.rewrite_days(spark, path, dt.date(2024, 1, 3)) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert files(1) < before[0] and files(3) == before[1]
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == list(range(72))
    assert [p.name for p in tmp_path.iterdir()] == ["facts"]
    for file in (tmp_path / "facts" / "date=2024-01-01").glob("*.parquet"):
        uids = [r.vessel_uid for r in spark.read.parquet(f"file://{file}").collect()]
        assert uids == sorted(uids)
    assert refresh.table_health(spark, {"facts": path}).first().codec == "zstd"


def test_marts_share_one_fold(spark):
    from vesselflow.plans import registry

    t = registry.Tables(spark, "/root/testdata/sf0.001")
    plan = dashboard.row_counts(t.marts())._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan  # events are read from the table that the fold has written
    fold = t.fixes.where("vessel_uid IS NOT NULL")
    events_plan = events.emit_events(fold, t.areas)._jdf.queryExecution().executedPlan().toString()
    assert events_plan.count("MapInPandas") == 1


def test_arrival_numbers(spark, tmp_path):
    """Documents by time, then path; rows of a document by vessel, then time, then place, however many there are."""
    doc = lambda *rows: json.dumps({"data": {"rows": list(rows)}})
    late, early = vendor(MMSI="5", ELAPSED="0", LAT="1"), vendor(MMSI="5", ELAPSED="30", LAT="2")
    same = [vendor(MMSI="3", ELAPSED="7", DWT=str(i)) for i in range(5000)]
    docs = [(doc(late, early), T0, "b"), (doc(vendor(MMSI="9")), T0, "a"), (doc(*same), T0 + dt.timedelta(days=1), "0"), ("no json", T0, "c"), (doc(vendor(MMSI="1", ELAPSED="x"), late), T0 + dt.timedelta(days=2), "0")]
    documents = spark.createDataFrame(docs, "value string, fetch_ts timestamp, path string").repartition(3)
    rows = payload.with_arrival(normalize.normalise(payload.explode_rows(documents)), documents, first=7)
    got = rows.orderBy("arrival_seq").collect()
    assert [r.vessel_uid for r in got] == ["mmsi:9", "mmsi:5", "mmsi:5"] + ["mmsi:3"] * 5000 + ["mmsi:1", "mmsi:5"]
    assert [r.lat for r in got[1:3]] == [2.0, 1.0] and [r.dwt for r in got[3:5003]] == list(range(5000))
    assert len({r.arrival_seq for r in got}) == 5005 and [r.arrival_seq >> payload.PLACE_BITS for r in got[:4]] == [7, 8, 8, 10]
    # The vessel's older fix comes first and both are kept.
    area = spark.createDataFrame([], geofence.AREA)
    labelled = label.label(rows.where("vessel_uid = 'mmsi:5'").limit(2), area, spark.createDataFrame([], geofence.GATE))
    assert dedup.dedup(labelled.withColumn("lat", F.col("lat") / 100)).count() == 2
    for i in (2, 1):  # files of one time are told apart by their paths
        (tmp_path / f"{i}.json").write_text(doc(vendor(MMSI=str(i))))
        os.utime(tmp_path / f"{i}.json", (1.7e9, 1.7e9))
    files = payload.read_payloads(spark, str(tmp_path))
    got = payload.with_arrival(normalize.normalise(payload.explode_rows(files)), files).orderBy("arrival_seq").collect()
    assert [(r.vessel_uid, r.arrival_seq) for r in got] == [("mmsi:1", 0), ("mmsi:2", 1 << payload.PLACE_BITS)]
    assert payload.number_documents(documents.where("false")).count() == 0


def test_marts_have_one_row_per_day_and_key(spark):
    from vesselflow.plans import registry

    t = registry.Tables(spark, "/root/testdata/sf0.001")
    for name, key in zip(registry.MARTS, ("port_id", "lane_id", "lane_id", "lane_id", "lane_id", "area_id")):
        assert t.mart(name).groupBy("day", key).count().where("count > 1").count() == 0
    rows = t.sessions.cache()
    assert rows.where("is_open").groupBy("vessel_uid", "area_id").count().where("count > 1").count() == 0
    assert rows.where("end_ts < start_ts OR duration_s < 1 OR is_open <> (end_ts IS NULL)").count() == 0


def test_daily_helpers(spark):
    frame = spark.createDataFrame([("a", T0 + dt.timedelta(days=i), x) for i, x in enumerate([10.0, None, 20.0])], "k string, day timestamp_ntz, v double")
    assert [r.ewma for r in marts.ewma(frame, "k", "v", 0.5).orderBy("day").collect()] == [10.0, 5.0, 12.5]
    got = dashboard.explore(spark, {"t": frame}, "SELECT count(*) AS n FROM t WHERE v > :least", least=5).first()
    assert got.n == 2


def test_rows_of_documents_are_not_broadcast(spark):
    """Rows made from documents are taken for few; their numbers are joined by merge, and each task puts few documents together."""
    from vesselflow.plans import registry
    from vesselflow.sources import fixture

    for name in ("arrival_order", "normalize_rows", "pipeline_from_payloads"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [fetch_ts" in plan and "BuildLeft" not in plan, name
    documents = fixture.crowded_payloads(spark, "/root/testdata/sf0.1")
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc") == 1 and "REPARTITION_BY_NUM" in plan and documents.count() == 20


def test_fixes_are_compiled(spark):
    """Times and identities are worked out once, so that the method that makes fixes is below the 8,000 bytes that the JVM compiles."""
    import re

    documents = spark.createDataFrame([("{}", T0, "a")], "value string, fetch_ts timestamp, path string")
    plan = normalize.normalise(payload.explode_rows(documents))._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000
