"""Trips: segmentation at terminals and gaps, then direction and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefleet.functions.geo import haversine_km
from tidefleet.operators.cleaning import one_per_key
from tidefleet.operators.scans import Tracks, lag, total

NEAR_KM, GAP_SECONDS, LEAST_KM, LEAST_OUTSIDE, CIRCULAR_KM, HIGH_KM, MEDIUM_KM = 0.5, 1200, 1.5, 0.5, 1.0, 2.0, 5.0


def segment_trips(pings: DataFrame, ends: DataFrame, gap: int = GAP_SECONDS, near_km: float = NEAR_KM) -> DataFrame:
    """Pings with at_terminal, trip_id (numbered per vehicle) and segment_km; pings of routes without terminals go."""
    unique = one_per_key(pings, ["vehicle", "ep"], F.col("event_id"))
    placed = unique.join(ends, "route_id")
    x, y = F.col("x"), F.col("y")
    close = (haversine_km(y, x, F.col("a_lat"), F.col("a_lng")) <= near_km) | (haversine_km(y, x, F.col("b_lat"), F.col("b_lng")) <= near_km)
    last = ("ep", "x", "y", "at_terminal")
    track = Tracks.of(placed.withColumn("at_terminal", close), ["vehicle"], "ep", "event_id", counted=pings).scan(**{f"last_{c}": lag(c) for c in last})
    new = F.col("last_ep").isNull() | (F.col("ep") - F.col("last_ep") > gap) | (F.col("at_terminal") != F.col("last_at_terminal"))
    km = F.when(F.col("new") == 1, 0.0).otherwise(haversine_km(F.col("last_y"), F.col("last_x"), y, x))
    return track.add(new=F.when(new, 1).otherwise(0)).add(segment_km=km).scan(trip_id=total("new")).plain().drop("new", *(f"last_{c}" for c in last))


def _ends(*columns: str) -> list:
    first = F.struct("ep", "event_id")
    return [f(c, first).alias(f"{side}_{c}") for side, f in (("start", F.min_by), ("end", F.max_by)) for c in columns]


def trip_summary(segments: DataFrame, least_km: float = LEAST_KM, least_outside: float = LEAST_OUTSIDE) -> DataFrame:
    """One row per trip that is long enough and mostly away from terminals, with direction and confidence."""
    per = segments.groupBy("vehicle", "trip_id", "route_id", "route_no", "a_lng", "a_lat", "b_lng", "b_lat").agg(
        F.sum("segment_km").alias("total_km"), F.count("*").alias("pings"), F.round(F.avg(F.when(F.col("at_terminal"), 0.0).otherwise(1.0)), 2).alias("pct_outside"), *_ends("x", "y", "ep", "date")
    )
    kept = per.filter((F.col("total_km") > least_km) & (F.col("pct_outside") > least_outside))
    km = lambda p, t: haversine_km(F.col(f"{p}_y"), F.col(f"{p}_x"), F.col(f"{t}_lat"), F.col(f"{t}_lng"))
    out, back = km("start", "a") + km("end", "b"), km("start", "b") + km("end", "a")
    circular = haversine_km(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")) < CIRCULAR_KM
    error = F.least(out, back)
    return kept.withColumn("out_km", out).withColumn("back_km", back).select(
        "vehicle", "trip_id", "route_id", "route_no", F.col("start_date").alias("date"), "start_ep", "end_ep", F.round((F.col("end_ep") - F.col("start_ep")) / 60.0, 2).alias("minutes"), "total_km", "pings", "pct_outside",
        F.when(circular, "CIRCULAR").when(F.col("out_km") < F.col("back_km"), "OUTBOUND").otherwise("INBOUND").alias("direction"),
        F.when(circular, "HIGH").when(error < HIGH_KM, "HIGH").when(error < MEDIUM_KM, "MEDIUM").otherwise("LOW").alias("confidence"),
    )


def gap_trips(pings: DataFrame, ends: DataFrame, gap: int = 600, least_km: float = 1.0, high_km: float = 5.0, medium_km: float = 15.0) -> DataFrame:
    """Trips cut at gaps only, with direction by whose terminals they match better.

    ends has the terminals of either direction (routes.both_terminals); a route
    without inbound ones has INBOUND trips only. The way to a trip's first ping
    from the ping before it counts for the trip.
    """
    track = Tracks.of(pings, ["vehicle", "route_id"], "ep", "event_id").scan(**{f"last_{c}": lag(c) for c in ("ep", "x", "y")})
    new = F.col("last_ep").isNull() | (F.col("ep") - F.col("last_ep") > gap)
    km = F.coalesce(haversine_km(F.col("last_y"), F.col("last_x"), F.col("y"), F.col("x")), F.lit(0.0))
    numbered = track.add(segment_km=km, new=F.when(new, 1).otherwise(0)).scan(trip_id=total("new")).plain()
    per = numbered.groupBy("vehicle", "route_id", "trip_id").agg(F.sum("segment_km").alias("total_km"), F.count("*").alias("pings"), *_ends("x", "y", "ep")).filter(F.col("total_km") > least_km)
    placed = per.join(ends, "route_id", "left")
    end = lambda p, t: haversine_km(F.col(f"{p}_y"), F.col(f"{p}_x"), F.col(f"{t}_lat"), F.col(f"{t}_lng"))
    out, back = end("start", "out_start") + end("end", "out_end"), end("start", "in_start") + end("end", "in_end")
    error = F.least(out, back)
    return placed.select(
        "vehicle", "route_id", "trip_id", "start_ep", "end_ep", "total_km", "pings", F.when(out < back, "OUTBOUND").otherwise("INBOUND").alias("direction"),
        F.when(error < high_km, "HIGH").when(error < medium_km, "MEDIUM").otherwise("LOW").alias("confidence"),
    )
