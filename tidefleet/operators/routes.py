"""Routes: terminals, bridges to stops, correction of vehicles' routes, detection from stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.geo import cell, haversine_km, neighbour_cells
from tidefleet.operators.scans import Tracks, last

NEAR_TERMINAL_KM = 0.6


def terminals(paths: DataFrame) -> DataFrame:
    """First and last point of each route's lowest variant; paths has route_id, route_var_id, path of [lng, lat]."""
    first = paths.groupBy("route_id").agg(F.min_by("path", "route_var_id").alias("path"))
    end = lambda i, j: F.try_element_at(F.try_element_at("path", F.lit(i)), F.lit(j))
    return first.select("route_id", end(1, 1).alias("a_lng"), end(1, 2).alias("a_lat"), end(-1, 1).alias("b_lng"), end(-1, 2).alias("b_lat"))


def both_terminals(paths: DataFrame) -> DataFrame:
    """(route_id, out_start_lng .. in_end_lat): ends of each route's outbound path, and of its inbound one where it has any; of several the lowest variant. Routes without an outbound path go."""
    way = lambda outbound: F.min_by(F.when(F.col("outbound") == outbound, F.col("path")), F.when(F.col("outbound") == outbound, F.col("route_var_id")))
    ways = paths.groupBy("route_id").agg(way(True).alias("out"), way(False).alias("in"), F.max(F.col("outbound").cast("int")).alias("any"))
    at = lambda p, i, j: F.try_element_at(F.try_element_at(F.col(p), F.lit(i)), F.lit(j))
    ends = [at(p, i, j).alias(f"{p}_{side}_{c}") for p in ("out", "in") for side, i in (("start", 1), ("end", -1)) for c, j in (("lng", 1), ("lat", 2))]
    return ways.filter("any = 1").select("route_id", *ends)


def bridge(stops: DataFrame) -> DataFrame:
    """(route_id, stop_id), each once, from stops with a comma-separated list of routes."""
    each = stops.select("stop_id", F.explode(F.split("routes", ",")).alias("r"))
    return each.select(F.trim("r").cast("int").alias("route_id"), "stop_id").distinct()


def route_candidates(pings: DataFrame, ends: DataFrame, km: float = NEAR_TERMINAL_KM) -> DataFrame:
    """(vehicle, route_id, candidate, a_km, b_km, route_km): routes whose both terminals a vehicle came near.

    A rounded place is held against the routes whose terminals lie in the cells
    around it, by an equi-join on grid cells at least as wide as km; the least
    distances are kept per vehicle and end before they are joined.
    """
    cells = pings.select("vehicle", "route_id", F.round("x", 3).alias("cx"), F.round("y", 3).alias("cy")).distinct()
    dim = ends.select(F.col("route_id").alias("candidate"), "a_lng", "a_lat", "b_lng", "b_lat", haversine_km(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")).alias("route_km"))
    size = 2 * km / 111.0  # degrees, for a degree of longitude of half a degree of latitude's length at least: up to 60 degrees north or south
    around = cells.withColumn("c", F.explode(neighbour_cells(cell(F.col("cx"), size), cell(F.col("cy"), size)))).select("vehicle", "route_id", F.col("cx").alias("x"), F.col("cy").alias("y"), "c.cx", "c.cy")
    sides = dim.select("candidate", "route_km", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_lng").alias("lng"), F.col(f"{s}_lat").alias("lat")) for s in "ab"))).alias("t"))
    sides = sides.select("candidate", "route_km", "t.*", cell(F.col("t.lng"), size).alias("cx"), cell(F.col("t.lat"), size).alias("cy"))
    met = around.join(sides, ["cx", "cy"]).withColumn("km", haversine_km(F.col("y"), F.col("x"), F.col("lat"), F.col("lng"))).filter(F.col("km") <= km)
    least = lambda side: F.min(F.when(F.col("side") == side, F.col("km"))).alias(f"{side}_km")
    near = met.groupBy("vehicle", "route_id", "candidate").agg(least("a"), least("b"), F.first("route_km").alias("route_km"))
    return near.filter("a_km is not null and b_km is not null")


def corrected_routes(candidates: DataFrame) -> DataFrame:
    """(vehicle, corrected): the vehicle's own route if it is a candidate, else the longest."""
    w = Window.partitionBy("vehicle").orderBy(F.desc(F.when(F.col("route_id") == F.col("candidate"), 1).otherwise(0)), F.desc("route_km"), "candidate")
    return candidates.withColumn("rank", F.row_number().over(w)).filter("rank = 1").select("vehicle", F.col("candidate").alias("corrected"))


def correct_routes(pings: DataFrame, corrections: DataFrame) -> DataFrame:
    return pings.join(corrections, "vehicle", "left").withColumn("route_id", F.coalesce("corrected", "route_id")).drop("corrected")


def detect_routes(pings: DataFrame, mapping: DataFrame, stops: DataFrame, digits: int = 4, tolerance: float = 1e-4) -> DataFrame:
    """Pings of mapped vehicles whose detected route is the mapped one.

    A ping that lies on a stop of some route, by rounded coordinates and a
    tolerance, shows that route (the nearest, then the lowest); a ping on no stop
    has the last route that its vehicle showed on that day.
    """
    unique = mapping.groupBy("vehicle").agg(F.min("route_id").alias("mapped"))
    known = pings.join(unique.select("vehicle"), "vehicle", "left_semi")
    at = bridge(stops).join(stops.select("stop_id", "stop_lng", "stop_lat"), "stop_id")
    at = at.select(F.col("route_id").alias("seen"), "stop_lng", "stop_lat", F.round("stop_lng", digits).alias("rx"), F.round("stop_lat", digits).alias("ry"))
    met = known.withColumn("rx", F.round("x", digits)).withColumn("ry", F.round("y", digits)).join(at, ["rx", "ry"], "left")
    dx, dy = F.abs(F.col("x") - F.col("stop_lng")), F.abs(F.col("y") - F.col("stop_lat"))
    met = met.filter(F.col("seen").isNull() | ((dx < tolerance) & (dy < tolerance))).withColumn("off", F.coalesce(dx + dy, F.lit(999.0)))
    nearest = Window.partitionBy("vehicle", "event_id").orderBy("off", "seen")
    met = met.withColumn("rank", F.row_number().over(nearest)).filter("rank = 1")
    filled = Tracks.of(met, ["vehicle", "date"], "ep", "event_id", counted=known).scan(detected=last("seen")).plain()
    return filled.join(unique, "vehicle").filter(F.col("detected") == F.col("mapped")).drop("rx", "ry", "stop_lng", "stop_lat", "rank", "seen", "mapped")


def vocabulary(rows: DataFrame) -> DataFrame:
    """(route_key, index): each route as text with its place among the routes in numeric order. One row per route."""
    return rows.select("route_id").filter("route_id is not null").distinct().select(F.col("route_id").cast("string").alias("route_key"), (F.row_number().over(Window.orderBy("route_id")) - 1).cast("long").alias("index"))
