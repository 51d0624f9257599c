"""Dropping fixes that say nothing new or can't be true.

A fix is compared with the fixes of its vessel that were kept before it, in order of arrival, so this is a fold and no
window: `Track.keeps` is its step, for batches and streams alike. In a batch, vessels are dealt out and sorted, and each
task runs the fold over its rows as they stream by; a vessel of any length needs the memory of a few fixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vesselflow.functions.geo import local_m_of, sphere_m_of

#: The tolerances.
SAME_M, SAME_KN, SAME_DEG = 25.0, 0.3, 1.0
MAX_KN, MIN_DT_S = 30.0, 1e-9
NEAR_M, FAR_M = 300.0, 2000.0
SLACK_US = 2_000_000

MEMBERSHIP = ("area_id_core", "area_id_approach", "lane_id", "gate_id", "gate_end")
#: Of the vessel's fix kept before.
BEFORE = {"b_core": "area_id_core", "b_approach": "area_id_approach", "b_lane": "lane_id"}
NEEDS = ("_us", "lat", "lon", "sog", "cog", "heading", *MEMBERSHIP)


def _missing(x) -> bool:
    return x is None or x != x


def _close(a, b, limit: float, turn: bool = False) -> bool:
    if _missing(a) or _missing(b):
        return _missing(a) and _missing(b)
    d = abs(np.float32(a) - np.float32(b))
    return a == b or float(min(d, np.float32(360) - d) if turn else d) <= limit


def _knots(metres: float, us: int) -> float:
    return metres / 1852.0 / (us / 3.6e9)


class Track:
    """The kept fixes of one vessel that later ones can still be compared with, by time."""

    def __init__(self, kept: list[tuple] | None = None) -> None:
        self.kept = kept or []

    def keeps(self, fix: tuple) -> bool:
        """fix: values of NEEDS. Whether it is kept; then it is remembered."""
        us, lat, lon = fix[:3]
        kept = self.kept
        if not kept:
            return self._keep(fix)
        if kept[-1][0] - us > SLACK_US:
            return False
        at = sum(k[0] <= us for k in kept)
        if at == 0:
            return self._keep(fix)
        prev = kept[at - 1]
        placed = not (_missing(lat) or _missing(lon))
        both = placed and not (_missing(prev[1]) or _missing(prev[2]))
        if both and lat == prev[1] and lon == prev[2]:
            return False
        same = both and local_m_of(prev[2], prev[1], lon, lat) <= SAME_M
        same = same and _close(fix[3], prev[3], SAME_KN) and _close(fix[4], prev[4], SAME_DEG, True) and _close(fix[5], prev[5], SAME_DEG, True)
        if same and all(a == b or (_missing(a) and _missing(b)) for a, b in zip(fix[6:], prev[6:], strict=True)):
            return False
        if us <= prev[0]:
            return False
        if both and _knots(sphere_m_of(prev[2], prev[1], lon, lat), us - prev[0]) > MAX_KN:
            return False
        following = kept[at] if at < len(kept) else None
        if following and placed and following[0] > us and not _missing(following[1]) and _knots(sphere_m_of(lon, lat, following[2], following[1]), following[0] - us) > MAX_KN:
            return False
        older = [k for k in kept[:at] if k[0] < prev[0]]
        if older and both and not (_missing(older[-1][1]) or _missing(older[-1][2])):
            if sphere_m_of(lon, lat, older[-1][2], older[-1][1]) <= NEAR_M and sphere_m_of(lon, lat, prev[2], prev[1]) >= FAR_M:
                return False
        return self._keep(fix)

    def _keep(self, fix: tuple) -> bool:
        self.kept.append(fix)
        self.kept.sort(key=lambda k: k[0])
        # Two before the time slack, and all within it.
        old = sum(k[0] < self.kept[-1][0] - SLACK_US for k in self.kept)
        del self.kept[: max(0, old - 2)]
        return True


def dedup(fixes: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """The labelled fixes that are kept. Fixes without vessel_uid are all kept."""
    return dedup_with_before(fixes, order).drop(*BEFORE)


def dedup_with_before(fixes: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """As `dedup`, with the memberships of the vessel's fix kept before (BEFORE), so that events need no look back at all fixes."""
    columns = fixes.columns
    timed = fixes.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    # Fixes without a vessel are dealt out by their own number, so that they don't meet in one task.
    dealt = timed.repartition(F.coalesce("vessel_uid", F.xxhash64(order).cast("string"))).sortWithinPartitions("vessel_uid", order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vessel, track, last = None, Track(), (None,) * len(BEFORE)
        at = [NEEDS.index(c) for c in BEFORE.values()]
        for pdf in batches:
            before: list[tuple] = []
            keep = np.zeros(len(pdf), dtype=bool)
            values = [[None if _missing(x) else x for x in pdf[c].tolist()] for c in NEEDS]
            for i, (uid, fix) in enumerate(zip([None if _missing(x) else x for x in pdf["vessel_uid"]], zip(*values, strict=True), strict=True)):
                if uid != vessel:
                    vessel, track, last = uid, Track(), (None,) * len(BEFORE)
                keep[i] = uid is None or track.keeps(fix)
                if keep[i]:
                    before.append(last)
                    last = last if uid is None else tuple(fix[k] for k in at)
            out = pdf.loc[keep, columns]
            yield out.assign(**{c: pd.Series([b[k] for b in before], index=out.index, dtype=object) for k, c in enumerate(BEFORE)})

    schema = T.StructType([*fixes.schema.fields, *(T.StructField(c, T.StringType()) for c in BEFORE)])
    return dealt.mapInPandas(run, schema)
