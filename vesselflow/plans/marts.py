"""Daily marts over events and sessions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesselflow.functions import scalars as S

LANE_KINDS = ("lane", "chokepoint")
#: Groups whose westward exits in ballast are returns.
RETURN_GROUPS = ("Mid-Atlantic", "Cape of Good Hope")


def _sum(value: str, where: Column) -> Column:
    return F.sum(F.when(where, F.col(value).cast("long")))


def port_lifts_daily(events: DataFrame, areas: DataFrame) -> DataFrame:
    role = F.col("flow_role")
    leaving = F.coalesce(F.col("laden"), F.when(role == "export", True).when(role == "import", False), F.lit(False))
    coming = F.coalesce(F.col("laden"), F.when(role == "import", True).when(role == "export", False), F.lit(False))
    rows = events.where("area_kind = 'port'").join(areas.select("area_id", "name", "flow_role"), "area_id")
    keys = [S.day(F.col("ts")).alias("day"), F.col("area_id").alias("port_id"), F.col("name").alias("port_name"), F.coalesce(role, F.lit("mixed")).alias("flow_role")]
    return rows.groupBy(*keys).agg(
        _sum("dwt", (F.col("event") == "port_exit") & leaving).alias("depart_dwt_laden"), _sum("dwt", (F.col("event") == "port_enter") & coming).alias("arrive_dwt_laden")
    )


def lane_transit_daily(events: DataFrame, areas: DataFrame) -> DataFrame:
    rows = events.where(F.col("area_kind").isin(*LANE_KINDS)).join(areas.select("area_id", "name"), "area_id")
    left = F.col("event") == "lane_exit"
    keys = [S.day(F.col("ts")).alias("day"), F.col("area_id").alias("lane_id"), F.col("name").alias("lane_name")]
    return rows.groupBy(*keys).agg(F.count_if(left).alias("transit_cnt"), _sum("dwt", left & F.coalesce("laden", F.lit(False))).alias("laden_dwt_sum"))


def lane_transit_time_daily(sessions: DataFrame) -> DataFrame:
    """p90 is the extension that the hourly report needs."""
    rows = sessions.where(F.col("area_kind").isin(*LANE_KINDS) & ~F.col("is_open") & F.col("end_ts").isNotNull())
    at = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY duration_s)").cast("long")
    return rows.groupBy(S.day(F.col("end_ts")).alias("day"), F.col("area_id").alias("lane_id")).agg(
        at(0.5).alias("transit_time_p50_s"), at(0.9).alias("transit_time_p90_s"), F.avg("duration_s").alias("transit_time_mean_s")
    )


def area_occupancy_daily(sessions: DataFrame, areas: DataFrame) -> DataFrame:
    """Share of the active 5-minute buckets in which a session is open; p50 is the middle of the buckets' flags."""
    ts = S.bucket(F.coalesce("end_ts", "start_ts"), 5)
    snaps = sessions.groupBy(ts.alias("ts"), "area_id", "area_kind").agg(F.max(F.col("is_open").cast("int")).alias("open_sessions"))
    rows = snaps.join(areas.where("kind = 'port' AND subtype = 'approach'").select("area_id"), "area_id")
    p50 = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY open_sessions)").cast("int")
    return rows.groupBy(S.day(F.col("ts")).alias("day"), "area_id").agg(F.avg("open_sessions").alias("avg_open_sessions"), p50.alias("p50_open_sessions"))


def ballast_return_daily(events: DataFrame, areas: DataFrame) -> DataFrame:
    lanes = areas.where(F.col("group").isin(*RETURN_GROUPS)).select("area_id")
    rows = events.where(F.col("area_kind").isin(*LANE_KINDS)).join(lanes, "area_id")
    back = (F.col("event") == "lane_exit") & F.col("laden").eqNullSafe(False) & F.col("gate_end").eqNullSafe("west")
    return rows.groupBy(S.day(F.col("ts")).alias("day"), F.col("area_id").alias("lane_id")).agg(_sum("dwt", back).alias("ballast_dwt"))


def class_mix_daily(events: DataFrame) -> DataFrame:
    rows, left, dwt = events.where(F.col("area_kind").isin(*LANE_KINDS)), F.col("event") == "lane_exit", F.col("dwt")
    return rows.groupBy(S.day(F.col("ts")).alias("day"), F.col("area_id").alias("lane_id")).agg(
        _sum("dwt", left & (dwt >= 200_000)).alias("dwt_vlcc"),
        _sum("dwt", left & dwt.between(120_000, 199_999)).alias("dwt_suezmax"),
        _sum("dwt", left & dwt.between(80_000, 119_999)).alias("dwt_aframax"),
        _sum("dwt", left & (dwt < 80_000)).alias("dwt_other"),
    )


def ml_features_daily(marts: dict[str, DataFrame]) -> DataFrame:
    """Extension: a row per day with the totals of all six marts."""
    total = lambda name, **cols: marts[name].groupBy("day").agg(*(F.sum(c).alias(k) for k, c in cols.items()))
    parts = [
        total("port_lifts_daily", depart_dwt="depart_dwt_laden", arrive_dwt="arrive_dwt_laden"),
        total("lane_transit_daily", transits="transit_cnt", laden_dwt="laden_dwt_sum"),
        marts["lane_transit_time_daily"].groupBy("day").agg(F.round(F.avg("transit_time_p50_s"), 3).alias("p50_s")),
        marts["area_occupancy_daily"].groupBy("day").agg(F.round(F.avg("avg_open_sessions"), 6).alias("occupancy")),
        total("ballast_return_daily", ballast_dwt="ballast_dwt"),
        total("class_mix_daily", vlcc_dwt="dwt_vlcc", suezmax_dwt="dwt_suezmax", aframax_dwt="dwt_aframax", other_dwt="dwt_other"),
    ]
    # Each part has a row a day at most, so one grouping brings them together.
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy("day").agg(*(F.max(c).alias(c) for c in rows.columns if c != "day"))


def ewma(daily: DataFrame, key: str, value: str, alpha: float = 0.3) -> DataFrame:
    """Extension: key, day, ewma with y = alpha * x + (1 - alpha) * y of the day before; the first day's y is its x. Null values count as 0.

    One series is a row per day, so a key's series fits a task.
    """
    series = daily.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("day", F.coalesce(F.col(value), F.lit(0)).cast("double").alias("x")))).alias("s"))
    step = lambda acc, p: F.concat(acc, F.array(F.when(F.size(acc) == 0, p["x"]).otherwise(alpha * p["x"] + (1 - alpha) * F.get(acc, F.size(acc) - 1))))
    y = F.aggregate("s", F.array().cast("array<double>"), step)
    rows = series.select(key, F.inline(F.arrays_zip(F.transform("s", lambda p: p["day"]).alias("day"), y.alias("y"))))
    return rows.select(key, "day", F.round("y", 4).alias("ewma"))
