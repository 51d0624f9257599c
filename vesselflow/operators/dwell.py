"""Dwell sessions from enter and exit events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.functions.scalars import seconds_between


def dwell_sessions(events: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Sessions per vessel and area, from events in order of arrival.

    A session runs from an enter to the next exit; more enters in between only count as samples. An exit without an
    enter is a closed session of one second. It starts with its earliest enter. Number of exits before an event = number of its session.
    """
    w = Window.partitionBy("vessel_uid", "area_id").orderBy(order, "ord").rowsBetween(Window.unboundedPreceding, -1)
    leaves = F.col("event").endswith("_exit")
    rows = events.where("vessel_uid IS NOT NULL").withColumn("n", F.coalesce(F.sum(leaves.cast("int")).over(w), F.lit(0)))
    rows = rows.withColumns({"at": F.struct(F.col(order), F.col("ord")), "left_ts": F.when(leaves, F.col("ts"))})
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at")))
    out = rows.groupBy("vessel_uid", "area_id", "n").agg(
        F.min_by("area_kind", "at").alias("area_kind"),
        F.coalesce(F.min(F.when(~leaves, F.col("ts"))), F.min("ts")).alias("start_ts"),
        F.max("left_ts").alias("left_ts"),
        F.count("*").cast("int").alias("samples"),
        F.min_by("lat", "at").alias("first_lat"),
        F.min_by("lon", "at").alias("first_lon"),
        known("lat").alias("last_lat"),
        known("lon").alias("last_lon"),
    )
    end = F.greatest("left_ts", "start_ts")
    out = out.withColumn("end_ts", F.when(F.col("left_ts").isNotNull(), end)).withColumn("is_open", F.col("left_ts").isNull())
    length = F.greatest(F.lit(1).cast("long"), F.round(seconds_between(F.col("start_ts"), F.col("end_ts"))).cast("long"))
    out = out.withColumn("duration_s", F.when(~F.col("is_open"), length)).withColumn("source", F.lit("event"))
    return out.select("vessel_uid", "area_id", "area_kind", "start_ts", "end_ts", "duration_s", "is_open", "samples", "first_lat", "first_lon", "last_lat", "last_lon", "source")
