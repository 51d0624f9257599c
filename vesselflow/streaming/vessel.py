"""The stream: vendor documents or labelled fixes in; kept fixes, events, dwell sessions and states out, with one state per vessel.

State is held by `transformWithStateInPandas` in typed columns (RocksDB): the kept fixes that later ones are compared with
are a list, memberships and cargo are values, open sessions are a map by area. A new version of this code reads them by
their schema. They expire when a vessel hasn't been heard of for long. The step is `fold.Vessel`'s, as for days.

Fixes that come later than the watermark allows are kept apart (`late`): they change no state, and what they are is
written and can be counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vesselflow.operators import fold, label, normalize
from vesselflow.operators.dedup import NEEDS, Track, _missing
from vesselflow.plans import invalidation, refresh
from vesselflow.sources import payload

LATENESS = "12 hours"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TS = "timestamp"
#: All outputs' columns: events, sessions, and the state after a vessel's batch.
OUT = (
    "what string, vessel_uid string, arrival_seq long, ord int, ts timestamp, event string, area_id string, area_kind string, gate_end string, lat double, lon double, src string, "
    "dwt int, laden boolean, cargo_confidence string, arrival_likely_laden boolean, port_flow_role string, start_ts timestamp, end_ts timestamp, duration_s long, is_open boolean, samples int, "
    "first_lat double, first_lon double, last_lat double, last_lon double, source string, core_area_id string, approach_area_id string, lane_id string, updated_ts timestamp, cargo_ts timestamp"
)
NAMES = fold.names(OUT)
INPUT = ("ts", "vessel_uid", "lat", "lon", "sog", "cog", "heading", "src", "dwt", "area_id_core", "area_id_approach", "lane_id", "gate_id", "gate_end")
#: Columns of each kind of output; changes are states and open sessions.
EVENT, SESSION = fold.names(fold.EVENT), fold.names(fold.SESSION)
STATE = ("vessel_uid", "core_area_id", "approach_area_id", "lane_id", "gate_end", "updated_ts", "laden", "cargo_confidence", "cargo_ts")
#: pandas types of the output; texts stay Python objects.
_PANDAS = {"string": object, "long": "Int64", "int": "Int32", "double": "float64", "boolean": "boolean", "timestamp": "datetime64[us]"}


class Vessels(StatefulProcessor):
    def __init__(self, roles: dict[str, str], order: Sequence[str], ttl_ms: int) -> None:
        self.roles, self.order, self.ttl_ms = roles, list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", fold.KEPT, self.ttl_ms)
        self.member = handle.getValueState("member", fold.MEMBER.format(ts=TS), self.ttl_ms)
        self.cargo = handle.getValueState("cargo", fold.CARGO.format(ts=TS), self.ttl_ms)
        self.open = handle.getMapState("open", "area_id string", fold.OPEN.format(ts=TS), self.ttl_ms)
        self.seen = handle.getValueState("seen", "n long", self.ttl_ms)

    def _load(self) -> fold.Vessel:
        v = fold.Vessel()
        if self.member.exists():
            v.track = Track([tuple(k) for k in self.kept.get()])
            v.member = dict(zip(v.member, self.member.get(), strict=True))
            v.cargo = dict(zip(v.cargo, self.cargo.get(), strict=True))
            v.open = {area: dict(zip(fold.names(fold.OPEN), s, strict=True)) for (area,), s in self.open.iterator()}
        return v

    def _save(self, v: fold.Vessel, n: int) -> None:
        self.kept.put([tuple(None if _missing(x) else x for x in k) for k in v.track.kept])
        self.member.update(tuple(v.member.values()))
        self.cargo.update(tuple(v.cargo.values()))
        for (area,) in list(self.open.keys()):
            if area not in v.open:
                self.open.removeKey((area,))
        for area, s in v.open.items():
            self.open.updateValue((area,), tuple(s.values()))
        self.seen.update((n,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        limit = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        vessel, n = self._load(), self.seen.get()[0] if self.seen.exists() else 0
        out, last = [], None
        for r in pdf.to_dict("records"):
            fix = {k: None if _missing(v) or v is pd.NaT else v for k, v in r.items()}
            late = r["ts"] < limit
            fix |= {"ts": r["ts"].to_pydatetime(), "_us": r["ts"].value // 1000, "vessel_uid": key[0]}
            fix["arrival_seq"] = fix.get("arrival_seq", n)
            n += 1
            base = {c: fix.get(c) for c in ("vessel_uid", "arrival_seq", "ts", "lat", "lon", "src", "dwt", "gate_end")}
            if late:
                out.append({"what": "late", **base})
                continue
            got = vessel.take({"src": None, "dwt": None, **fix}, self.roles)
            if got is None:
                continue
            last = base
            out.append({"what": "fix", **base})
            out += [{"what": "event", **e} for e in got[0]]
            out += [{"what": "session", **s} for s in got[1]]
        self._save(vessel, n)
        if last:
            cargo = {"laden": vessel.cargo["laden"], "cargo_confidence": vessel.cargo["confidence"], "cargo_ts": vessel.cargo["cargo_ts"]}
            out.append({"what": "state", **last, **vessel.member, **cargo})
            out += [{"what": "open", "vessel_uid": key[0], "area_id": a, **s, "is_open": True, "source": "event"} for a, s in vessel.open.items()]
        if out:
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=_PANDAS[t]) for c, t in (x.split() for x in OUT.split(", "))})

    def close(self) -> None:
        pass


def vessel_stream(labelled: DataFrame, roles: dict[str, str], lateness: str = LATENESS, ttl_days: int = 90, order: Sequence[str] = ("arrival_seq",)) -> DataFrame:
    """Tagged outputs (`what`: fix, event, session, late, state, open) of a stream of labelled fixes (ts: timestamp).

    roles: port by flow role, as many as there are ports. order: columns that say in what order the rows of a batch
    arrive; where arrival_seq isn't among the columns, outputs count their vessel's rows. Fixes without vessel_uid are not
    followed. Fixes older than the newest of earlier batches by more than `lateness` are late. The session is set to
    keep state in RocksDB, as typed state needs it; a vessel's goes ttl_days after its last batch.
    """
    labelled.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    columns = [c for c in dict.fromkeys((*INPUT, *order, "arrival_seq")) if c in labelled.columns]
    timed = labelled.select(*columns).where("vessel_uid IS NOT NULL").withWatermark("ts", lateness)
    # In processing time state can expire, and late rows come to the processor instead of being dropped before it.
    return timed.groupBy("vessel_uid").transformWithStateInPandas(Vessels(roles, order, ttl_days * 86_400_000), OUT, "Append", "ProcessingTime")


def payload_stream(spark: SparkSession, folder: str, areas: DataFrame, gates: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """Labelled fixes of the vendor documents that come into a folder."""
    return label.label(normalize.normalise(payload.explode_rows(payload.read_payloads(spark, folder, stream=True)), boxes), areas, gates)


#: Columns that a stream of documents is ordered by.
ARRIVAL = ("fetch_ts", "path", "place")


def sink(path: str, after: Callable[[DataFrame, int], None] | None = None, compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: fixes, late ones, events and sessions of a batch go to folders of their own under `path`, with the log of the days they touch.

    Each batch writes a partition named by its number, so that a repeated batch replaces what it wrote before. States and
    open sessions go to a log of changes, of which every `compact_every` batches a snapshot is made.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        of = lambda what: batch.where(F.col("what") == what)
        for what in ("fix", "late"):
            of(what).select("vessel_uid", "arrival_seq", "ts", "lat", "lon", "src", "dwt", "gate_end").write.mode("overwrite").parquet(f"{path}/{what}/batch={number}")
        batch.where("what IN ('state', 'open')").write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
        invalidation.append(path, number, of("event").select(*EVENT), of("session").select(*SESSION))
        if number % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, number)
        if after:
            after(batch, number)
        batch.unpersist()

    return write


def start(outputs: DataFrame, path: str, checkpoint: str, every: str | None = None, **kw) -> StreamingQuery:
    """Run the stream into `sink(path, **kw)`: every so often, or once over what is there.

    A run over what is there must not make batches without data: state that can expire in processing time would have it
    make them for ever.
    """
    spark = outputs.sparkSession
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(every is not None).lower())
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return outputs.writeStream.foreachBatch(sink(path, **kw)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _latest(rows: list[DataFrame]) -> DataFrame:
    """States and open sessions of each vessel's last batch with a state."""
    whole = reduce(DataFrame.unionByName, rows)
    last = whole.where("what = 'state'").groupBy("vessel_uid").agg(F.max("batch").alias("_last"))
    return whole.join(last, "vessel_uid").where("batch = _last").drop("_last").select(*NAMES, "batch")


def _snapshot(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """(last batch in it, rows) of the newest snapshot."""
    fs, root = refresh._filesystem(spark, f"{path}/snapshot")
    versions = refresh._versions(spark, f"{path}/snapshot") if fs.exists(root) else []
    return (int(versions[-1].rpartition("-")[2]), refresh.current(spark, f"{path}/snapshot")) if versions else (-1, None)


def changes(spark: SparkSession, path: str) -> dict[int, str]:
    """Folders of changes by batch."""
    fs, root = refresh._filesystem(spark, f"{path}/changes")
    found = {int(n.removeprefix("batch=")): f"{path}/changes/{n}" for n in (s.getPath().getName() for s in (fs.listStatus(root) if fs.exists(root) else ())) if n.startswith("batch=")}
    return dict(sorted(found.items()))


def current(spark: SparkSession, path: str) -> DataFrame:
    """States (`what` = state) and open sessions (open) of all vessels as they are now: the snapshot and the changes after it."""
    upto, rows = _snapshot(spark, path)
    new = [p for n, p in changes(spark, path).items() if n > upto]
    parts = [rows] if rows is not None else []
    if new:
        parts.append(spark.read.schema(f"{OUT}, batch long").option("basePath", f"{path}/changes").parquet(*new))
    return _latest(parts) if parts else spark.createDataFrame([], f"{OUT}, batch long")


def compact(spark: SparkSession, path: str, number: int) -> None:
    """Make a snapshot up to a batch, by one rename, and delete the changes that are in the snapshot before it.

    A snapshot has as many rows as there are vessels and open sessions. Changes stay for one snapshot more, for readers
    that have just listed them.
    """
    before, _ = _snapshot(spark, path)
    if before < number:
        refresh.swap(current(spark, path), f"{path}/snapshot", number)
    fs, _ = refresh._filesystem(spark, path)
    for n, place in changes(spark, path).items():
        if n <= before:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place), True)


def states(spark: SparkSession, path: str) -> DataFrame:
    return current(spark, path).where("what = 'state'").select(*STATE)


def read(spark: SparkSession, path: str, what: str) -> DataFrame:
    """Events or closed sessions with their `date` and `batch`."""
    schema = {"event": fold.EVENT, "session": fold.SESSION}[what].format(ts=TS)
    return spark.read.schema(f"{schema}, date date, batch long").parquet(f"{path}/{what}")


def facts(spark: SparkSession, path: str, kind: str, days: list) -> DataFrame:
    """What marts of some days are made of (invalidation.refresh_pending): events, or sessions with the open ones."""
    rows = invalidation.on_days(read(spark, path, kind), days)
    if kind == "event":
        return rows
    opened = current(spark, path).where("what = 'open'").where(F.to_date("start_ts").isin(days)).select(*SESSION)
    return rows.unionByName(opened)


def refresh_marts(spark: SparkSession, path: str, areas: DataFrame, window=None) -> dict:
    """Bring the marts of the days that the stream has touched up to date."""
    return invalidation.refresh_pending(spark, path, areas, lambda kind, days: facts(spark, path, kind, days), window)


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """batch, n: late fixes by batch."""
    return spark.read.schema("vessel_uid string, batch long").parquet(f"{path}/late").groupBy("batch").agg(F.count("*").alias("n"))
