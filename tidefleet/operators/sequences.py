"""Kinematic deltas and fixed-length sequence windows, without Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.pings import cyclic

MOST_SECONDS, LENGTH = 300, 10
#: What a model sees of each step, in this order.
STEP_FEATURES = ("delta_x", "delta_y", "speed", "acceleration", "delta_heading", "door_up", "door_down", "working", "time_sin", "time_cos")


def delta_features(pings: DataFrame, time: str = "ep", most: int = MOST_SECONDS) -> DataFrame:
    """Differences to the ping before, for pings that follow one within 0 < seconds <= most."""
    w = Window.partitionBy("vehicle").orderBy(time, "event_id")
    dt = F.col(time) - F.lag(time).over(w)
    delta = lambda c: F.col(c) - F.lag(c).over(w)
    sin, cos = cyclic(F.col(time))
    with_deltas = pings.withColumns({"delta_time": dt, "delta_x": delta("x"), "delta_y": delta("y"), "delta_speed": delta("speed"), "delta_heading": delta("heading"), "time_sin": sin, "time_cos": cos})
    kept = with_deltas.filter((F.col("delta_time") > 0) & (F.col("delta_time") <= most))
    known = {"acceleration": F.coalesce(F.col("delta_speed") / F.col("delta_time"), F.lit(0.0)), "delta_heading": F.coalesce("delta_heading", F.lit(0.0))}
    return kept.withColumns(known)


def sequence_windows(features: DataFrame, time: str = "ep", length: int = LENGTH, most: int = MOST_SECONDS) -> DataFrame:
    """One row per window of length successive rows of a vehicle that has a row after it and no longer pause inside.

    Columns: vehicle, first (1-based place of the window), route_id of the
    vehicle's first row, waypoint_count, then f_0 .. f_{length-1} as doubles for
    each step feature f and for delta_time.
    """
    w = Window.partitionBy("vehicle").orderBy(time, "event_id")
    each = F.struct(*(F.col(c).cast("double").alias(c) for c in (*STEP_FEATURES, "delta_time")))
    steps = F.collect_list(each).over(w.rowsBetween(0, length - 1))
    start = F.first("route_id").over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = features.withColumns({"steps": steps, "next": F.lead("event_id", length).over(w), "first": F.row_number().over(w).cast("long"), "start": start})
    whole = rows.filter((F.size("steps") == length) & F.col("next").isNotNull() & (F.array_max(F.transform("steps", lambda s: s["delta_time"])) <= most))
    flat = [F.col("steps")[i][c].alias(f"{c}_{i}") for i in range(length) for c in (*STEP_FEATURES, "delta_time")]
    return whole.select("vehicle", "first", F.col("start").alias("route_id"), F.lit(length).cast("long").alias("waypoint_count"), *flat)
