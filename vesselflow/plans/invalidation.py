"""Marts kept fresh by what has changed: a log of the days that new or late rows touch, and refreshes of just these.

Facts lie in folders of a batch and, in it, of a day (`event/batch=7/date=2024-01-05`); sessions under the day they end on.
Every batch logs the days whose marts it may change. A refresh takes the days whose last change is later than their last
refresh, computes the marts of these days from the facts of these days, replaces their partitions, and notes how far it
has come; a lost refresh is repeated, as nothing is noted before the marts are there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vesselflow.operators.dedup import SLACK_US
from vesselflow.plans import marts, refresh

LOG = "kind string, day date"
#: Marts by the kind of facts that they come from, and how they are made of these and the areas.
Mart = tuple[str, Callable[[DataFrame, DataFrame], DataFrame]]
MARTS: dict[str, Mart] = {
    "port_lifts_daily": ("event", marts.port_lifts_daily),
    "lane_transit_daily": ("event", marts.lane_transit_daily),
    "ballast_return_daily": ("event", marts.ballast_return_daily),
    "class_mix_daily": ("event", lambda rows, areas: marts.class_mix_daily(rows)),
    "lane_transit_time_daily": ("session", lambda rows, areas: marts.lane_transit_time_daily(rows)),
    "area_occupancy_daily": ("session", marts.area_occupancy_daily),
}
#: Fixed value: how often marts are refreshed.
EVERY = "30 minutes"


def touched(events: DataFrame, closed: DataFrame) -> DataFrame:
    """kind, day: the days whose marts new events and closed sessions may change.

    A closed session is no longer open on the day that it began on. An enter opens a session on its day, or draws the
    start of an open one back by the time slack at most, from the day that has it then.
    """
    day = lambda c: F.to_date(c).alias("day")
    enters = events.where(F.col("event").endswith("_enter"))
    after = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + SLACK_US)
    parts = [
        events.select(F.lit("event").alias("kind"), day("ts")),
        enters.select(F.lit("session").alias("kind"), F.explode(F.array(day("ts"), day(after))).alias("day")),
        closed.select(F.lit("session").alias("kind"), F.explode(F.array(day("start_ts"), day("end_ts"))).alias("day")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def append(root: str, number: int, events: DataFrame, closed: DataFrame) -> None:
    """Add a batch's events and closed sessions to the facts, then its days to the log: what is logged can be read. A repeated batch replaces what it wrote before."""
    for what, rows, ts in (("event", events, "ts"), ("session", closed, "end_ts")):
        rows.withColumn("date", F.to_date(ts)).write.mode("overwrite").partitionBy("date").parquet(f"{root}/{what}/batch={number}")
    touched(events, closed).write.mode("overwrite").parquet(f"{root}/log/batch={number}")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table's rows, or none where there isn't one yet."""
    fs, place = refresh._filesystem(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(place) else spark.createDataFrame([], schema)


def pending(spark: SparkSession, root: str) -> DataFrame:
    """kind, day, batch: days that have changed since they were last refreshed, and the batch of the last change."""
    log = _read(spark, f"{root}/log", f"{LOG}, batch long").groupBy("kind", "day").agg(F.max("batch").alias("batch"))
    done = _read(spark, f"{root}/done", f"{LOG}, batch long").groupBy("kind", "day").agg(F.max("batch").alias("_done"))
    return log.join(done, ["kind", "day"], "left").where("batch > coalesce(_done, -1)").drop("_done")


def refresh_pending(
    spark: SparkSession,
    root: str,
    areas: DataFrame,
    facts: Callable[[str, list[dt.date]], DataFrame],
    window: tuple[dt.datetime, dt.datetime] | None = None,
    which: Mapping[str, Mart] = MARTS,
) -> dict[str, list[dt.date]]:
    """Bring the marts of all pending days (in a window: of its days; the others stay pending) up to date; returns the days by kind.

    The marts of a root are always the same ones (`which`). facts(kind, days): the events of some days, or the sessions that end on them or, while open, began on them.
    """
    rows = [r for r in pending(spark, root).collect() if window is None or window[0].date() <= r["day"] and dt.datetime.combine(r["day"], dt.time()) < window[1]]
    by: dict[str, list[dt.date]] = {}
    for r in rows:
        by.setdefault(r["kind"], []).append(r["day"])
    for kind, days in by.items():
        _compute(root, areas, facts, kind, sorted(days), which)
    _note(spark, root, rows)
    return {kind: sorted(days) for kind, days in by.items()}


def _compute(root: str, areas: DataFrame, facts: Callable[[str, list[dt.date]], DataFrame], kind: str, days: list[dt.date], which: Mapping[str, Mart]) -> None:
    makes = {name: make for name, (of, make) in which.items() if of == kind}
    these = facts(kind, days) if makes else None
    for name, make in makes.items():
        refresh.write_days(make(these, areas), f"{root}/marts/{name}", days=days)


def _note(spark: SparkSession, root: str, rows: list[Row]) -> None:
    if rows:
        spark.createDataFrame([tuple(r) for r in rows], f"{LOG}, batch long").coalesce(1).write.mode("append").parquet(f"{root}/done")


def force(
    spark: SparkSession, root: str, areas: DataFrame, facts: Callable[[str, list[dt.date]], DataFrame], window: tuple[dt.datetime, dt.datetime], which: Mapping[str, Mart] = MARTS
) -> list[dt.date]:
    """Compute the marts of all days of a window again, changed or not (`refresh.window`, `refresh.backfill_window`); returns the days.

    What was pending of these days when it began is done then.
    """
    start, end = window[0].date(), window[1]
    days = [d for k in range((end.date() - start).days + 1) if dt.datetime.combine(d := start + dt.timedelta(days=k), dt.time()) < end]
    rows = [r for r in pending(spark, root).collect() if r["day"] in days]
    for kind in sorted({of for of, _ in which.values()}):
        _compute(root, areas, facts, kind, days, which)
    _note(spark, root, rows)
    return days


def first_day(spark: SparkSession, root: str) -> dt.datetime | None:
    """Midnight of the day of the first event, from the folders' names; where a backfill begins."""
    fs, place = refresh._filesystem(spark, f"{root}/event")
    found = [d for s in (fs.listStatus(place) if fs.exists(place) else ()) for d in refresh._days(spark, s.getPath().toString())[1]]
    return dt.datetime.combine(min(found), dt.time()) if found else None


def backfill(spark: SparkSession, root: str, areas: DataFrame, facts: Callable[[str, list[dt.date]], DataFrame], as_of: dt.datetime, which: Mapping[str, Mart] = MARTS) -> list[dt.date]:
    """All days from the day before the first event to today; half a year without events."""
    return force(spark, root, areas, facts, refresh.backfill_window(first_day(spark, root), as_of), which)


def policy(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    areas: DataFrame,
    facts: Callable[[str, list[dt.date]], DataFrame],
    now: Callable[[], dt.datetime],
    every: str = EVERY,
    which: Mapping[str, Mart] = MARTS,
) -> StreamingQuery:
    """The scheduled refresh: every so often, the pending days of the policy's window. The clock is a stream of its own, as days come into the window without new rows."""
    act = lambda batch, number: refresh_pending(spark, root, areas, facts, refresh.policy_window(now()), which) and None
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def on_days(rows: DataFrame, days: list[dt.date]) -> DataFrame:
    """Facts of some days; only these folders are read."""
    return rows.where(F.col("date").isin(days)).drop("date", "batch")


def mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/marts/{name}").drop("date")


def follow(spark: SparkSession, root: str, checkpoint: str, act: Callable[[], object], every: str = EVERY) -> StreamingQuery:
    """Run `act` (a refresh) whenever the log has grown, at most once in `every`."""
    fs, place = refresh._filesystem(spark, f"{root}/log")
    fs.mkdirs(place)
    log = spark.readStream.schema(f"{LOG}, batch long").parquet(f"{root}/log")
    return log.writeStream.foreachBatch(lambda batch, number: act() and None).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
