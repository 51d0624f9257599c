"""State carried from day to day against the fold of all history, and refreshes by invalidation."""

import datetime as dt
import pathlib
import random
import re

import pytest
from pyspark.sql import functions as F

from vesselflow.operators import dedup, dwell, events
from vesselflow.plans import days, refresh

from .test_vessels import FIX, T0, fix, ports


@pytest.fixture(scope="module")
def history(spark):
    """Five days of fixes of a few vessels, some of them late or without a vessel, each with the day it arrives on."""
    rng, rows = random.Random(11), []
    for uid in ("a", "b", "c", None):
        second = 0
        for _ in range(150):
            second += rng.choice([-1, 0, 30, 600, 3600, 7200])
            core = rng.choice([None, None, "X", "I", "M"])
            lat = None if rng.random() < 0.03 else rng.choice([0.0, 0.0001, 0.02, 0.2, 3.0])
            rows.append(fix(0, second, lat, rng.choice([0.0, 0.0001, 0.02, 0.1]), uid, core=core, approach=rng.choice([None, "A", "B"]), lane=rng.choice([None, None, "L"]), end=rng.choice([None, "west"]), sog=rng.choice([1.0, 5.0])))
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.choice([0, 1])))
    frame = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], FIX)
    return frame.withColumn("date", F.date_add(F.lit(T0.date()), F.floor(F.col("arrival_seq") / 130).cast("int"))).cache()


def rows_of(frame):
    """Rows as texts, columns by name, times without their zone."""
    plain = lambda v: v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v
    return sorted(repr([(c, plain(r[c])) for c in sorted(frame.columns)]) for r in frame.collect())


@pytest.mark.parametrize("every", [2])
def test_days_equal_the_fold_of_all_history(spark, history, tmp_path, every):
    areas, facts, root = ports(spark), f"file://{tmp_path}/facts", f"file://{tmp_path}/folded"
    history.write.partitionBy("date").parquet(facts)
    roles = days.roles_of(areas)
    steps = days.fold_by_days(spark, facts, root, roles, every=every)
    assert steps == [T0.date() + dt.timedelta(days=d) for d in range(0, 5, every)]
    assert days.fold_by_days(spark, facts, root, roles, every=every) == []
    for k, step in enumerate(steps):
        so_far = history.where(F.col("date") < F.lit(step + dt.timedelta(days=every))).drop("date")
        kept = dedup.dedup(so_far)
        found = events.emit_events(kept, areas)
        sessions = dwell.dwell_sessions(found)
        assert rows_of(days.sessions(spark, root, step)) == rows_of(sessions)
        now = days.state(spark, root, step)
        assert rows_of(now.select("vessel_uid", "core_area_id", "approach_area_id", "lane_id", "gate_end", "updated_ts")) == rows_of(events.vessel_state(kept))
        cargo = now.where("laden IS NOT NULL").select("vessel_uid", "laden", "confidence", F.col("cargo_ts").alias("updated_ts"))
        assert rows_of(cargo) == rows_of(events.cargo_state(kept, areas))
        if k == len(steps) - 1:
            assert rows_of(days.kept_fixes(spark, root)) == rows_of(kept)
            assert rows_of(days.events(spark, root)) == rows_of(found)
            assert sessions.where("is_open").count() and sessions.where("NOT is_open").count() > 20
    # A day folded again, and those after it, come to the same.
    before = rows_of(days.events(spark, root))
    assert days.fold_by_days(spark, facts, root, roles, since=steps[1], every=every) == steps[1:]
    assert rows_of(days.events(spark, root)) == before
    days.drop_states(spark, root, keep=1)
    assert days.state(spark, root, steps[0]) is None and days.state(spark, root).count() == 3


def test_a_day_reads_one_day_and_one_version(spark, history, tmp_path):
    facts, root = f"file://{tmp_path}/facts", f"file://{tmp_path}/folded"
    history.write.partitionBy("date").parquet(facts)
    days.fold_by_days(spark, facts, root, {})
    day = T0.date() + dt.timedelta(days=3)
    read = days.day_rows(spark, facts, day, day)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#", plan)
    files = {pathlib.Path(r[0]).parent.name for r in read.select(F.input_file_name()).distinct().collect()}
    held = {pathlib.Path(r[0]).parent.parent.name for r in days.state_before(spark, root, day).select(F.input_file_name()).distinct().collect()}
    assert files == {f"date={day}"} and held == {f"date={day - dt.timedelta(days=1)}"}
    out = days.fold_onto(read, days.state_before(spark, root, day), {})
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_empty_days(spark, history, tmp_path):
    none = history.where("false").drop("date")
    assert days.fold_onto(none, None, {}).count() == 0
    state = days.fold_onto(history.drop("date"), None, {}).where("what = 'state'").select("state.*")
    assert rows_of(days.fold_onto(none, state, {}).select("state.*")) == rows_of(state)  # vessels without fixes keep theirs
    assert days.events(spark, f"file://{tmp_path}/nothing") is None and days.sessions(spark, f"file://{tmp_path}/nothing") is None


def test_a_lost_replacement_is_repaired(spark, tmp_path):
    root, place = f"file://{tmp_path}", f"file://{tmp_path}/date=2024-01-01"
    spark.range(3).write.parquet(place)
    (tmp_path / "date=2024-01-01").rename(tmp_path / ".old-date=2024-01-01")  # lost between the renames
    assert refresh.repair(spark, root) == ["date=2024-01-01"] and spark.read.parquet(place).count() == 3
    (tmp_path / ".old-date=2024-01-01").mkdir()  # lost before the old one is deleted
    assert refresh.repair(spark, root) == [] and not (tmp_path / ".old-date=2024-01-01").exists()
    spark.range(5).write.parquet(f"{root}/new")
    refresh.replace(spark, f"{root}/new", place)
    assert spark.read.parquet(place).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["date=2024-01-01"]
