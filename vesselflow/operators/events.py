"""Enter and exit events from changes of membership, with what is believed of the cargo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.operators.dedup import BEFORE


def _timeline(fixes: DataFrame, areas: DataFrame, order: str) -> DataFrame:
    """Kept fixes that change a membership, with those before each (b_*), the roles of both ports, and the belief after the port events.

    The belief is the last exit from an export (laden) or import port (in ballast), else the first entry into one: that
    is what updating it event by event comes to while ports keep their roles.
    """
    w = Window.partitionBy("vessel_uid").orderBy(order)
    rows = fixes.where("vessel_uid IS NOT NULL")
    if not set(BEFORE) <= set(fixes.columns):
        rows = rows.withColumns({b: F.lag(c).over(w) for b, c in BEFORE.items()})
    # Only changes give events and beliefs; they are few, so what follows shuffles little where the fold has looked back.
    changed = [~F.col(b).eqNullSafe(F.col(c)) for b, c in BEFORE.items()]
    rows = rows.where(changed[0] | changed[1] | changed[2])
    roles = areas.where("flow_role IS NOT NULL").select("area_id", "flow_role")
    rows = rows.join(roles.toDF("b_core", "exit_role"), "b_core", "left").join(roles.toDF("area_id_core", "enter_role"), "area_id_core", "left")
    moved = ~F.col("b_core").eqNullSafe(F.col("area_id_core"))
    rows = rows.withColumn("moved", moved).withColumns(
        {
            "exit_laden": F.when(F.col("moved") & F.col("b_core").isNotNull(), F.when(F.col("exit_role") == "export", True).when(F.col("exit_role") == "import", False)),
            "enter_laden": F.when(F.col("moved") & F.col("area_id_core").isNotNull(), F.when(F.col("enter_role") == "import", True).when(F.col("enter_role") == "export", False)),
        }
    )
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    first = lambda c: F.first(c, ignorenulls=True).over(so_far)
    stamp = lambda c: F.when(F.col(c).isNotNull(), F.col("ts"))
    rows = rows.withColumns({"exit_ts": stamp("exit_laden"), "enter_ts": stamp("enter_laden")})
    return rows.withColumns(
        {
            "laden": F.coalesce(last("exit_laden"), first("enter_laden")),
            "confidence": F.when(last("exit_laden").isNotNull(), "derived_port_exit").when(first("enter_laden").isNotNull(), "derived_port_enter"),
            "cargo_ts": F.coalesce(last("exit_ts"), first("enter_ts")),
        }
    )


def _event(name: str, when: Column, area: Column, kind: str, gate: Column, laden: Column, confidence: Column, likely: Column, role: Column) -> Column:
    text, flag = "string", "boolean"
    return F.when(
        when,
        F.struct(
            F.lit(name).alias("event"),
            area.alias("area_id"),
            F.lit(kind).alias("area_kind"),
            gate.cast(text).alias("gate_end"),
            laden.cast(flag).alias("laden"),
            confidence.cast(text).alias("cargo_confidence"),
            likely.cast(flag).alias("arrival_likely_laden"),
            role.cast(text).alias("port_flow_role"),
        ),
    )


def emit_events(fixes: DataFrame, areas: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Events of the kept fixes: ts, vessel_uid, arrival order, ord (place within the fix), event, area_id, area_kind, gate_end, lat, lon and what is known of ship and cargo.

    A move from one port to another gives exit and enter; from one approach or lane to another only the enter. Fixes
    without vessel_uid give none.
    """
    none, col = F.lit(None), F.col
    exit_conf = F.when(col("exit_laden").isNotNull(), "derived_port_exit").otherwise("unknown")

    def change(name: str, before: str, now: str, kind: str, gate: Column) -> Column:
        """Enter where there is a new area, else exit."""
        moved, entered = ~col(before).eqNullSafe(col(now)), col(now).isNotNull()
        args = (kind, gate, col("laden"), col("confidence"), none, none)
        return F.coalesce(_event(f"{name}_enter", moved & entered, col(now), *args), _event(f"{name}_exit", moved, col(before), *args))

    events = F.array(
        _event("port_exit", col("moved") & col("b_core").isNotNull(), col("b_core"), "port", none, col("exit_laden"), exit_conf, none, col("exit_role")),
        _event("port_enter", col("moved") & col("area_id_core").isNotNull(), col("area_id_core"), "port", none, none, none, col("enter_laden"), col("enter_role")),
        change("approach", "b_approach", "area_id_approach", "approach", none),
        change("lane", "b_lane", "lane_id", "lane", col("gate_end")),
    )
    rows = _timeline(fixes, areas, order).select("ts", "vessel_uid", order, "lat", "lon", "src", "dwt", F.posexplode(events).alias("ord", "e")).where("e IS NOT NULL")
    return rows.select("ts", "vessel_uid", order, "ord", "e.event", "e.area_id", "e.area_kind", "e.gate_end", "lat", "lon", "src", "dwt", "e.laden", "e.cargo_confidence", "e.arrival_likely_laden", "e.port_flow_role")


def vessel_state(fixes: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Last kept membership of each vessel."""
    last = F.max_by(F.struct("area_id_core", "area_id_approach", "lane_id", "gate_end", "ts"), F.col(order)).alias("s")
    rows = fixes.where("vessel_uid IS NOT NULL").groupBy("vessel_uid").agg(last)
    return rows.select("vessel_uid", F.col("s.area_id_core").alias("core_area_id"), F.col("s.area_id_approach").alias("approach_area_id"), "s.lane_id", "s.gate_end", F.col("s.ts").alias("updated_ts"))


def cargo_state(fixes: DataFrame, areas: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Last belief of each vessel that there is one for."""
    last = F.max_by(F.struct("laden", "confidence", "cargo_ts"), F.col(order)).alias("s")
    rows = _timeline(fixes, areas, order).groupBy("vessel_uid").agg(last).where("s.laden IS NOT NULL")
    return rows.select("vessel_uid", "s.laden", "s.confidence", F.col("s.cargo_ts").alias("updated_ts"))
