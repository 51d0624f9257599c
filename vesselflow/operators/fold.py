"""One vessel's state, and the step that follows its fixes one by one: what days and streams carry on from.

Batches over all history express the same by a fold and windows (dedup, events, dwell). Here everything a later fix needs
is held in typed columns: the kept fixes it is compared with, memberships, the cargo belief and the open sessions.
"""

from __future__ import annotations

from collections.abc import Iterator

from vesselflow.operators.dedup import NEEDS, Track, _missing

#: A kept fix that later ones are compared with, and an open session, without the types of their times.
KEPT = "us long, lat double, lon double, sog float, cog float, heading short, area_id_core string, area_id_approach string, lane_id string, gate_id string, gate_end string"
OPEN = "area_kind string, start_ts {ts}, samples int, first_lat double, first_lon double, last_lat double, last_lon double"
MEMBER = "core_area_id string, approach_area_id string, lane_id string, gate_end string, updated_ts {ts}"
CARGO = "laden boolean, confidence string, cargo_ts {ts}"
EVENT = (
    "ts {ts}, vessel_uid string, arrival_seq long, ord int, event string, area_id string, area_kind string, gate_end string, lat double, lon double, src string, dwt int, laden boolean, "
    "cargo_confidence string, arrival_likely_laden boolean, port_flow_role string"
)
SESSION = (
    "vessel_uid string, area_id string, area_kind string, start_ts {ts}, end_ts {ts}, duration_s long, is_open boolean, samples int, first_lat double, first_lon double, last_lat double, "
    "last_lon double, source string"
)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def state_schema(ts: str) -> str:
    """Columns of a vessel's state, in which times are of type `ts`."""
    colons = lambda schema: ", ".join(f"{a}: {b}" for a, b in (c.split() for c in schema.format(ts=ts).split(", ")))
    return f"vessel_uid string, kept array<struct<{colons(KEPT)}>>, {MEMBER.format(ts=ts)}, {CARGO.format(ts=ts)}, open array<struct<area_id: string, {colons(OPEN)}>>"


_KEPT, _OPEN, _MEMBER, _CARGO = names(KEPT), names(OPEN), names(MEMBER), names(CARGO)
LADEN_BY_EXIT, LADEN_BY_ENTRY = {"export": True, "import": False}, {"import": True, "export": False}


class Vessel:
    """State of one vessel. `open` has a list of OPEN's values by area."""

    def __init__(self) -> None:
        self.track = Track()
        self.member: dict = dict.fromkeys(_MEMBER)
        self.cargo: dict = dict.fromkeys(_CARGO)
        self.open: dict[str, dict] = {}

    @classmethod
    def load(cls, row: dict) -> Vessel:
        self = cls()
        self.track = Track([tuple(k[c] for c in _KEPT) for k in row["kept"] or ()])
        self.member = {c: row[c] for c in _MEMBER}
        self.cargo = {c: row[c] for c in _CARGO}
        self.open = {s["area_id"]: {c: s[c] for c in _OPEN} for s in row["open"] or ()}
        return self

    def dump(self, uid: str) -> dict:
        kept = [dict(zip(_KEPT, (None if _missing(v) else v for v in k), strict=True)) for k in self.track.kept]
        return {"vessel_uid": uid, "kept": kept, **self.member, **self.cargo, "open": [{"area_id": a, **s} for a, s in self.open.items()]}

    def take(self, fix: dict, roles: dict[str, str]) -> tuple[list[dict], list[dict]] | None:
        """Events and closed sessions of a fix (NEEDS, ts, vessel_uid, arrival_seq, src, dwt); None where it isn't kept."""
        if not self.track.keeps(tuple(fix[c] for c in NEEDS)):
            return None
        base = {c: fix[c] for c in ("ts", "vessel_uid", "arrival_seq", "lat", "lon", "src", "dwt")}
        events = [{**base, **e} for e in self._events(fix, roles)]
        sessions = [s for e in events if (s := self._session(e)) is not None]
        self.member["updated_ts"], self.member["gate_end"] = fix["ts"], fix["gate_end"]
        return events, sessions

    def _events(self, fix: dict, roles: dict[str, str]) -> Iterator[dict]:
        cargo, was, now = self.cargo, self.member["core_area_id"], fix["area_id_core"]
        by_entry = None
        if was != now:
            if was is not None:
                role = roles.get(was)
                laden = LADEN_BY_EXIT.get(role)
                if laden is not None:
                    cargo |= {"laden": laden, "confidence": "derived_port_exit", "cargo_ts": fix["ts"]}
                confidence = "unknown" if laden is None else "derived_port_exit"
                yield {"ord": 0, "event": "port_exit", "area_id": was, "area_kind": "port", "laden": laden, "cargo_confidence": confidence, "port_flow_role": role}
            if now is not None:
                by_entry = LADEN_BY_ENTRY.get(roles.get(now))
                if by_entry is not None and cargo["confidence"] is None:
                    cargo |= {"laden": by_entry, "confidence": "derived_port_enter", "cargo_ts": fix["ts"]}
                yield {"ord": 1, "event": "port_enter", "area_id": now, "area_kind": "port", "arrival_likely_laden": by_entry, "port_flow_role": roles.get(now)}
            self.member["core_area_id"] = now
        for k, (kind, held, column) in enumerate((("approach", "approach_area_id", "area_id_approach"), ("lane", "lane_id", "lane_id")), 2):
            was, now = self.member[held], fix[column]
            if was != now:
                gate = fix["gate_end"] if kind == "lane" else None
                name, area = (f"{kind}_exit", was) if now is None else (f"{kind}_enter", now)
                yield {"ord": k, "event": name, "area_id": area, "area_kind": kind, "gate_end": gate, "laden": cargo["laden"], "cargo_confidence": cargo["confidence"]}
                self.member[held] = now

    def _session(self, e: dict) -> dict | None:
        """The session that an event ends, if any: an enter opens one or counts in it, an exit ends it, or is one of a second."""
        area, ts = e["area_id"], e["ts"]
        s = self.open.get(area)
        leaves = e["event"].endswith("_exit")
        if s is None:
            s = {"area_kind": e["area_kind"], "start_ts": ts, "samples": 1, "first_lat": e["lat"], "first_lon": e["lon"], "last_lat": e["lat"], "last_lon": e["lon"]}
        else:
            s["samples"] += 1
            for c in ("lat", "lon"):
                s[f"last_{c}"] = s[f"last_{c}"] if e[c] is None else e[c]
            s["start_ts"] = s["start_ts"] if leaves else min(s["start_ts"], ts)
        if not leaves:
            self.open[area] = s
            return None
        self.open.pop(area, None)
        end = max(ts, s["start_ts"])
        seconds = int((end - s["start_ts"]).total_seconds() + 0.5)
        return {"vessel_uid": e["vessel_uid"], "area_id": area, **s, "end_ts": end, "duration_s": max(1, seconds), "is_open": False, "source": "event"}
