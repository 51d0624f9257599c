"""Facts day by day: each day's fixes are folded onto the state that the day before has left, not onto all history.

A day's folder holds everything that the day gives (`what`: fix, event, session and the state of all vessels at its end)
and comes by one rename, so facts and state of a day are there together or not at all, and a lost run leaves the days
before as they were. Folding a day reads that day's fixes and one version of the state.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vesselflow.operators import fold
from vesselflow.operators.dedup import NEEDS
from vesselflow.plans import refresh

WHATS = ("fix", "event", "session", "state")


def roles_of(areas: DataFrame) -> dict[str, str]:
    """Flow roles by port: as many rows as there are ports with one."""
    return {r["area_id"]: r["flow_role"] for r in areas.where("flow_role IS NOT NULL").select("area_id", "flow_role").collect()}


def fold_onto(fixes: DataFrame, state: DataFrame | None, roles: dict[str, str], order: str = "arrival_seq") -> DataFrame:
    """What labelled fixes give when they follow the fixes that `state` comes from: rows (what, fix, event, session, state).

    A vessel's state comes before its fixes in one sorted pass, so a vessel of any length needs the memory of its state.
    Vessels without fixes keep theirs. Fixes without vessel_uid are all kept and give nothing else.
    """
    ts = fixes.schema["ts"].dataType.simpleString()
    state_type = T.StructType.fromDDL(fold.state_schema(ts))
    kinds = {
        "fix": fixes.schema,
        "event": T.StructType.fromDDL(fold.EVENT.format(ts=ts)),
        "session": T.StructType.fromDDL(fold.SESSION.format(ts=ts)),
        "state": state_type,
    }
    rows = fixes.select(F.struct(*fixes.columns).alias("fix"), F.col("vessel_uid"), F.col(order).alias("seq"), F.lit(None).cast(state_type).alias("state"))
    if state is not None:
        held = state.select(F.lit(None).cast(fixes.schema).alias("fix"), "vessel_uid", F.lit(None).cast("long").alias("seq"), F.struct(*state_type.names).cast(state_type).alias("state"))
        rows = rows.unionByName(held)
    rows = rows.withColumn("us", F.unix_micros(F.col("fix.ts").cast("timestamp")))
    # Nulls sort first: a state goes before the fixes. Fixes without a vessel are dealt out by their own number.
    dealt = rows.repartition(F.coalesce("vessel_uid", F.xxhash64("seq").cast("string"))).sortWithinPartitions("vessel_uid", "seq")
    arrow = {k: to_arrow_type(t) for k, t in kinds.items()}
    wanted = [c for c in dict.fromkeys(("ts", "vessel_uid", "src", "dwt", *NEEDS[1:])) if c in fixes.columns]

    def table(what: str, array: pa.Array) -> pa.RecordBatch:
        n = len(array)
        return pa.RecordBatch.from_arrays([pa.array([what] * n), *(array if k == what else pa.nulls(n, arrow[k]) for k in kinds)], ["what", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = vessel = None
        for batch in batches:
            out: dict[str, list] = {"fix": [], "event": [], "session": [], "state": []}
            fix = batch.column("fix")
            values = {c: fix.field(c).to_pylist() for c in wanted}
            uids, seqs, us, states = (batch.column(c).to_pylist() for c in ("vessel_uid", "seq", "us", "state"))
            for i, now in enumerate(uids):
                if now is None:
                    out["fix"].append(i)
                    continue
                if now != uid:
                    if vessel:
                        out["state"].append(vessel.dump(uid))
                    uid, vessel = now, fold.Vessel()
                if states[i] is not None:
                    vessel = fold.Vessel.load(states[i])
                    continue
                row = {"src": None, "dwt": None, **{c: v[i] for c, v in values.items()}, "_us": us[i], "arrival_seq": seqs[i]}
                got = vessel.take(row, roles)
                if got:
                    out["fix"].append(i)
                    out["event"] += got[0]
                    out["session"] += got[1]
            if out["fix"]:
                yield table("fix", fix.take(pa.array(out["fix"])).cast(arrow["fix"]))
            for what in ("event", "session", "state"):
                if out[what]:
                    yield table(what, pa.array(out[what], arrow[what]))
        if vessel:
            yield table("state", pa.array([vessel.dump(uid)], arrow["state"]))

    schema = T.StructType([T.StructField("what", T.StringType()), *(T.StructField(k, t) for k, t in kinds.items())])
    return dealt.select("fix", "vessel_uid", "seq", "us", "state").mapInArrow(run, schema)


def days_there(spark: SparkSession, root: str) -> dict[dt.date, str]:
    return {d: p.toString() for d, p in sorted(refresh._days(spark, root)[1].items())}


def _of(spark: SparkSession, root: str, what: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame | None:
    """Rows of one kind of the days from first to last; None where no day has any."""
    some = [p for d, p in days_there(spark, root).items() if (first is None or d >= first) and (last is None or d <= last)]
    fs, _ = refresh._filesystem(spark, root)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    some = [f"{p}/what={what}" for p in some if fs.exists(jpath(f"{p}/what={what}"))]
    return spark.read.option("basePath", root).parquet(*some).select(f"{what}.*") if some else None


def state_before(spark: SparkSession, root: str, day: dt.date) -> DataFrame | None:
    """The state at the end of the last day folded before a day."""
    earlier = [d for d in days_there(spark, root) if d < day]
    return _of(spark, root, "state", earlier[-1], earlier[-1]) if earlier else None


def day_rows(spark: SparkSession, facts: str, first: dt.date, last: dt.date) -> DataFrame:
    """Labelled fixes of some days, of a table with a folder for each day of arrival."""
    return spark.read.parquet(facts).where(F.col("date").between(F.lit(first), F.lit(last))).drop("date")


def fold_day(spark: SparkSession, facts: str, root: str, day: dt.date, roles: dict[str, str], last: dt.date | None = None) -> None:
    """Fold the fixes of a day (or of the days up to `last`) and put the result in its place; a day that is there is replaced.

    Days after a replaced one follow from a state that is no longer there: fold them again.
    """
    out = fold_onto(day_rows(spark, facts, day, last or day), state_before(spark, root, day), roles)
    hidden = f"{root}/_new-{uuid.uuid4().hex}"
    out.write.partitionBy("what").parquet(hidden)
    refresh.replace(spark, hidden, f"{root}/date={day}")


def fold_by_days(spark: SparkSession, facts: str, root: str, roles: dict[str, str], since: dt.date | None = None, every: int = 1) -> list[dt.date]:
    """Fold the days of `facts` that aren't folded yet, in order, `every` days at a time; with `since` those from there on again. Returns the first day of each step."""
    there = days_there(spark, root)
    days = sorted(refresh._days(spark, facts)[1])
    steps = [days[i : i + every] for i in range(0, len(days), every)]
    done = []
    for step in steps:
        if (since and step[-1] >= since) or step[0] not in there:
            fold_day(spark, facts, root, step[0], roles, step[-1])
            done.append(step[0])
    return done


def kept_fixes(spark: SparkSession, root: str) -> DataFrame | None:
    return _of(spark, root, "fix")


def events(spark: SparkSession, root: str) -> DataFrame | None:
    return _of(spark, root, "event")


def state(spark: SparkSession, root: str, at: dt.date | None = None) -> DataFrame | None:
    """The state of all vessels after the last day folded, or after the last one up to a day."""
    days = [d for d in days_there(spark, root) if at is None or d <= at]
    return _of(spark, root, "state", days[-1], days[-1]) if days else None


def open_sessions(state: DataFrame) -> DataFrame:
    """The open sessions of a table of states, in the columns of sessions."""
    ts = state.schema["updated_ts"].dataType.simpleString()
    o = state.select("vessel_uid", F.explode("open").alias("o")).select("vessel_uid", "o.*")
    o = o.withColumns({"end_ts": F.lit(None).cast(ts), "duration_s": F.lit(None).cast("long"), "is_open": F.lit(True), "source": F.lit("event")})
    return o.select(*fold.names(fold.SESSION))


def sessions(spark: SparkSession, root: str, at: dt.date | None = None) -> DataFrame | None:
    """Closed and open sessions as they are at the end of a day (of the last one)."""
    closed, now = _of(spark, root, "session", last=at), state(spark, root, at)
    if now is None:
        return closed
    opened = open_sessions(now)
    return opened if closed is None else closed.unionByName(opened)


def drop_states(spark: SparkSession, root: str, keep: int = 7) -> list[dt.date]:
    """Delete all versions of the state but the last few; facts stay."""
    fs, _ = refresh._filesystem(spark, root)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = [d for d, p in list(days_there(spark, root).items())[:-keep] if fs.delete(jpath(f"{p}/what=state"), True)]
    return gone
