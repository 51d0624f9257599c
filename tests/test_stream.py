"""The stream against the batch, over restarts; late fixes, the snapshot of states, and marts refreshed by what has changed."""

import datetime as dt
import json
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vesselflow.operators import dedup, dwell, events, label, normalize
from vesselflow.plans import invalidation, marts, refresh
from vesselflow.sources import fixture, geofence, payload
from vesselflow.streaming import vessel

from .test_days import rows_of
from .test_vessels import FIX, T0, fix, ports, vendor

TYPED = FIX.replace("timestamp_ntz", "timestamp")


def run(stream, out, checkpoint, **kw):
    query = vessel.start(stream, out, checkpoint, **kw)
    deadline = time.time() + 100
    while query.isActive and time.time() < deadline:
        query.awaitTermination(5)
    assert not query.isActive and query.exception() is None


def places(spark):
    """The ports and a lane."""
    return ports(spark).unionByName(spark.createDataFrame([("L", "Lane", "lane", "corridor", "Mid-Atlantic", None, [[]], None)], geofence.AREA))


def put(spark, rows, path):
    spark.createDataFrame(rows, FIX).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(path)


def fixes_of(spark, folder, roles, **kw):
    stream = spark.readStream.schema(TYPED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    return vessel.vessel_stream(stream, roles, **kw)


def test_stream_equals_batch_over_a_restart(spark, tmp_path):
    rng, areas, rows = random.Random(3), places(spark), []
    for uid in ("a", "b", "c"):
        second = 0
        for _ in range(120):
            second += rng.choice([-1, 0, 30, 600, 600, 3600])
            core = rng.choice([None, None, "X", "I", "M"])
            rows.append(fix(0, second, rng.choice([0.0, 0.0001, 0.02, 0.2, 3.0]), rng.choice([0.0, 0.0001, 0.02, 0.1]), uid, core=core, approach=rng.choice([None, "A", "B"]), lane=rng.choice([None, None, "L"]), sog=rng.choice([1.0, 1.2, 5.0])))
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.choice([0, 1])))
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    kept = dedup.dedup(spark.createDataFrame(rows, FIX))
    found = events.emit_events(kept, areas).cache()
    sessions = dwell.dwell_sessions(found).cache()
    roles, out = {"X": "export", "I": "import"}, f"file://{tmp_path}/out"
    for part in range(3):  # each file is a run of its own, which goes on from the checkpoint
        put(spark, [r for r in rows if r[0] // 120 == part], f"{tmp_path}/in/{part}")
        run(fixes_of(spark, f"{tmp_path}/in", roles, lateness="90 days"), out, f"{tmp_path}/cp", compact_every=2)
    read = lambda what: spark.read.parquet(f"{out}/{what}")
    assert sorted(r.arrival_seq for r in read("fix").collect()) == sorted(r.arrival_seq for r in kept.collect()) and read("late").count() == 0
    assert rows_of(vessel.read(spark, out, "event").drop("date", "batch")) == rows_of(found)
    closed = vessel.read(spark, out, "session").drop("date", "batch")
    opened = vessel.current(spark, out).where("what = 'open'").select(*vessel.SESSION)
    assert rows_of(closed.unionByName(opened)) == rows_of(sessions) and closed.count() > 20
    now = vessel.states(spark, out)
    assert rows_of(now.select("vessel_uid", "core_area_id", "approach_area_id", "lane_id", "gate_end", "updated_ts")) == rows_of(events.vessel_state(kept))
    cargo = now.where("laden IS NOT NULL").select("vessel_uid", "laden", F.col("cargo_confidence").alias("confidence"), F.col("cargo_ts").alias("updated_ts"))
    assert rows_of(cargo) == rows_of(events.cargo_state(kept, areas))
    # Marts by refreshes of what each batch has touched are those of all facts.
    vessel.refresh_marts(spark, out, areas)
    assert rows_of(invalidation.mart(spark, out, "port_lifts_daily")) == rows_of(marts.port_lifts_daily(found, areas))
    assert rows_of(invalidation.mart(spark, out, "lane_transit_time_daily")) == rows_of(marts.lane_transit_time_daily(sessions))


def test_late_fixes_go_to_a_table_of_their_own(spark, tmp_path):
    """With the 12 hours as they are."""
    steps = [
        [fix(0, 0, 0.0, 0.0, "a", core="X"), fix(1, 20 * 3600, 0.1, 0.1, "b", core="X")],
        [fix(2, 7 * 3600, 0.0, 0.2, "a"), fix(3, 9 * 3600, 0.2, 0.3, "a", core="I"), fix(4, 21 * 3600, 0.2, 0.2, "b")],
    ]
    for i, rows in enumerate(steps):
        put(spark, rows, f"{tmp_path}/in/{i}")
        run(fixes_of(spark, f"{tmp_path}/in", {"X": "export"}), f"file://{tmp_path}/out", f"{tmp_path}/cp")
    numbers = lambda what: sorted(r.arrival_seq for r in spark.read.parquet(f"{tmp_path}/out/{what}").collect())
    assert numbers("late") == [2] and numbers("fix") == [0, 1, 3, 4]  # 7 h lies more than 12 h before 20 h, 9 h doesn't
    assert sorted((r.arrival_seq, r.event) for r in vessel.read(spark, f"file://{tmp_path}/out", "event").collect()) == [(0, "port_enter"), (1, "port_enter"), (3, "port_enter"), (3, "port_exit"), (4, "port_exit")]
    assert {r.batch: r.n for r in vessel.late_counts(spark, f"file://{tmp_path}/out").collect()} == {1: 1}
    assert "arrival_seq" in vessel.OUT and all(2 != r.arrival_seq for r in vessel.current(spark, f"file://{tmp_path}/out").collect())


def test_documents_to_marts(spark, tmp_path):
    """Vendor documents in a folder, through the stream to marts, against the batch over the same documents."""
    rng = random.Random(8)
    areas, gates = fixture.areas(spark), fixture.gates(spark)
    for d in range(4):
        rows = [vendor(MMSI=str(100 + rng.randrange(3)), ELAPSED=str(rng.randrange(60)), LAT=str(rng.choice([0.5, 0.6, 1.5, 3.0])), LON=str(rng.choice([0.5, 0.7, 3.6, 5.45, 10.5])), DWT="90000", SPEED="100") for _ in range(40)]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{d}.json").write_text(json.dumps({"data": {"rows": rows}}))
        at = 1.7e9 + d * 40 * 3600
        os.utime(tmp_path / "in" / f"{d}.json", (at, at))
    out = f"file://{tmp_path}/out"
    labelled = vessel.payload_stream(spark, f"{tmp_path}/in", areas, gates)
    roles = {a[0]: a[4] for a in fixture.AREAS if a[4]}
    run(vessel.vessel_stream(labelled, roles, order=vessel.ARRIVAL), out, f"{tmp_path}/cp")
    vessel.refresh_marts(spark, out, areas)
    files = payload.read_payloads(spark, f"{tmp_path}/in")
    fixes = payload.with_arrival(normalize.normalise(payload.explode_rows(files)), files)
    found = events.emit_events(dedup.dedup_with_before(label.label(fixes, areas, gates)), areas).cache()
    assert found.count() > 10
    assert rows_of(vessel.read(spark, out, "event").drop("date", "batch", "arrival_seq")) == rows_of(found.drop("arrival_seq"))
    for name in ("lane_transit_daily", "port_lifts_daily"):
        assert rows_of(invalidation.mart(spark, out, name)) == rows_of(getattr(marts, name)(found, areas))
    assert rows_of(invalidation.mart(spark, out, "area_occupancy_daily")) == rows_of(marts.area_occupancy_daily(dwell.dwell_sessions(found), areas))


def test_the_snapshot_is_bounded_by_vessels(spark, tmp_path):
    out, write = f"file://{tmp_path}", None
    write = vessel.sink(out, compact_every=3)
    for n in range(11):
        rows = [("state", f"v{i}", float(n)) for i in range(5) if (i + n) % 2] + [("open", f"v{i}", float(n)) for i in range(5) if (i + n) % 2 and n % 3]
        batch = spark.createDataFrame(rows, "what string, vessel_uid string, lat double").select(*(F.col(c) if c in ("what", "vessel_uid", "lat") else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in vessel.OUT.split(", "))))
        write(batch, n)
        if n == 5:
            write(batch, n)  # a repeated batch
        assert len(vessel.changes(spark, out)) <= 6
    assert vessel._snapshot(spark, out)[0] == 8 and vessel._snapshot(spark, out)[1].count() <= 10
    now = vessel.current(spark, out).collect()
    assert {r.vessel_uid: r.lat for r in now if r.what == "state"} == {"v0": 9.0, "v1": 10.0, "v2": 9.0, "v3": 10.0, "v4": 9.0}
    assert {r.vessel_uid for r in now if r.what == "open"} == {"v1", "v3"}  # batch 9 had none open


@pytest.fixture
def two_batches(spark):
    """Events and sessions of a batch on three days, and of a late one on the second of them."""
    rows = [fix(i, 86400 * (i // 4) + 3600 * (i % 4), 0.01 * i, 0.0, core="X" if i % 2 else "I", lane="L" if i % 2 else None) for i in range(12)]
    found = events.emit_events(spark.createDataFrame(rows, FIX), ports(spark))
    late = found.where("arrival_seq = 5").withColumns({"vessel_uid": F.lit("w"), "dwt": F.lit(7)})
    return found.cache(), late.cache()


def test_a_late_row_refreshes_just_its_days(spark, two_batches, tmp_path):
    first, late = two_batches
    areas, root = places(spark), f"file://{tmp_path}"
    closed = lambda e: dwell.dwell_sessions(e).where("NOT is_open")
    invalidation.append(root, 0, first, closed(first))
    read = lambda kind: spark.read.parquet(f"{root}/{kind}")
    facts = lambda kind, days: invalidation.on_days(read(kind), days)
    day = lambda d: T0.date() + dt.timedelta(days=d)
    assert invalidation.refresh_pending(spark, root, areas, facts)["event"] == [day(0), day(1), day(2)]
    assert invalidation.pending(spark, root).count() == 0 and invalidation.refresh_pending(spark, root, areas, facts) == {}
    files = lambda name: {p.parent.name: p.name for p in (tmp_path / "marts" / name).glob("date=*/*.parquet")}
    before = files("lane_transit_daily")
    invalidation.append(root, 1, late, closed(late))
    window = refresh.window(T0 + dt.timedelta(days=8), 2)
    assert invalidation.refresh_pending(spark, root, areas, facts, window) == {}  # out of the window: stays pending
    assert invalidation.refresh_pending(spark, root, areas, facts)["event"] == [day(1)]
    after = files("lane_transit_daily")
    assert len(before) == 3 and {d for d in after if after[d] != before[d]} == {f"date={day(1)}"}
    plan = facts("event", [day(1)])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#", plan)
    whole = first.unionByName(late)
    assert rows_of(invalidation.mart(spark, root, "lane_transit_daily")) == rows_of(marts.lane_transit_daily(whole, areas))
    assert rows_of(invalidation.mart(spark, root, "class_mix_daily")) == rows_of(marts.class_mix_daily(whole))


def test_refresh_follows_the_log(spark, two_batches, tmp_path):
    first, late = two_batches
    areas, root = places(spark), f"file://{tmp_path}"
    nothing = dwell.dwell_sessions(first).where("false")
    facts = lambda kind, days: invalidation.on_days(spark.read.parquet(f"{root}/{kind}"), days)
    calls, which = [], {k: v for k, v in invalidation.MARTS.items() if v[0] == "event"}
    query = invalidation.follow(spark, root, f"{tmp_path}/cp", lambda: calls.append(invalidation.refresh_pending(spark, root, areas, facts, which=which)), "1 second")
    try:
        for n, rows in enumerate((first, late)):
            invalidation.append(root, n, rows.where("event LIKE 'lane%'"), nothing)
            deadline = time.time() + 60
            while invalidation.pending(spark, root).count() and time.time() < deadline:
                query.awaitTermination(1)
        assert query.exception() is None and calls
    finally:
        query.stop()
    got = invalidation.mart(spark, root, "lane_transit_daily")
    assert rows_of(got) == rows_of(marts.lane_transit_daily(first.unionByName(late), areas))


def test_policy_force_and_backfill(spark, two_batches, tmp_path):
    first, late = two_batches
    areas, root = places(spark), f"file://{tmp_path}"
    nothing = dwell.dwell_sessions(first).where("false")
    facts = lambda kind, days: invalidation.on_days(spark.read.parquet(f"{root}/{kind}"), days)
    which = {"lane_transit_daily": invalidation.MARTS["lane_transit_daily"]}
    day = lambda d: T0.date() + dt.timedelta(days=d)
    of = lambda: {r.day.date() for r in invalidation.mart(spark, root, "lane_transit_daily").collect()}
    left = lambda: {r.day for r in invalidation.pending(spark, root).where("kind = 'event'").collect()}
    assert invalidation.first_day(spark, root) is None
    invalidation.append(root, 0, first, nothing)
    clock = [T0 + dt.timedelta(days=2, hours=5)]  # the third day isn't over: it isn't the policy's yet
    query = invalidation.policy(spark, root, f"{tmp_path}/cp", areas, facts, lambda: clock[0], "1 second", which)
    try:
        for want in ({day(2)}, set()):
            deadline = time.time() + 60
            while left() != want and time.time() < deadline:
                query.awaitTermination(1)
            assert left() == want and query.exception() is None
            clock[0] += dt.timedelta(days=1)
    finally:
        query.stop()
    assert of() == {day(0), day(1), day(2)}
    invalidation.append(root, 1, late, nothing)
    assert invalidation.force(spark, root, areas, facts, refresh.window(T0 + dt.timedelta(days=2, hours=1), 0), which) == [day(2)] and left() == {day(1)}
    assert invalidation.backfill(spark, root, areas, facts, T0 + dt.timedelta(days=2), which) == [day(d) for d in range(-1, 3)]
    assert left() == set() and rows_of(invalidation.mart(spark, root, "lane_transit_daily")) == rows_of(marts.lane_transit_daily(first.unionByName(late), areas))
