"""Vehicles by day, their latest state, and fleet snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.pings import flag, ratio


def daily_stats(pings: DataFrame) -> DataFrame:
    """One row per local day and vehicle; a stop is a ping at rest after one in motion on that day."""
    w = Window.partitionBy("date", "vehicle").orderBy("ep", "event_id")
    marked = pings.withColumn("before", F.lag("speed").over(w)).withColumn("stops", flag((F.col("speed") == 0) & (F.col("before") > 0)))
    last = F.struct("ep", "event_id")
    per = marked.groupBy("date", "vehicle").agg(
        F.min("ep").alias("first_ep"), F.max("ep").alias("last_ep"), F.count("*").alias("pings"), F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"),
        F.sum("stops").alias("stops"), F.count_distinct("hour").alias("active_hours"), F.sum(flag(F.col("speed") > 0)).alias("moving"), F.sum(flag(F.col("ignition"))).alias("ignition_on"), F.sum(flag(F.col("aircon"))).alias("aircon_on"),
        F.sum(flag(F.col("sos"))).alias("sos"), F.max_by("route_id", last).alias("route_id"), F.max_by("route_no", last).alias("route_no"),
    )
    return per.withColumns({f"{c}_ratio": ratio(F.col(c), F.col("pings")) for c in ("moving", "ignition_on", "aircon_on")})


def latest_status(pings: DataFrame) -> DataFrame:
    """The newest ping of each vehicle, whatever its day."""
    w = Window.partitionBy("vehicle").orderBy(F.desc("ep"), F.desc("event_id"))
    newest = pings.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")
    return newest.withColumn("is_moving", flag(F.col("speed") > 0)).withColumn("is_stopped", flag(F.col("speed") == 0))


def fleet_snapshot(latest: DataFrame, digits: int = 2) -> DataFrame:
    """KPIs per route and, as route ALL, of the whole fleet; only vehicles with the ignition on count, but for sos."""
    on = F.col("ignition")
    named = latest.withColumn("route", F.coalesce("route_no", F.lit("UNKNOWN")))
    sums = named.rollup("route").agg(
        F.grouping("route").alias("whole"), F.count("*").alias("vehicles"), F.sum(flag(on)).alias("active"), F.coalesce(F.round(F.avg(F.when(on, F.col("speed"))), digits), F.lit(0.0)).alias("avg_speed"),
        F.sum(flag(on & (F.col("speed") == 0))).alias("idle"), F.sum(flag(on & F.col("aircon"))).alias("aircon"), F.sum(flag(F.col("sos"))).alias("sos"),
    )
    return sums.select(F.when(F.col("whole") == 1, "ALL").otherwise(F.col("route")).alias("route"), "vehicles", "active", "avg_speed", "idle", "aircon", "sos")


#: Sketches of 2^14 registers count different vehicles with a relative standard error of 0.65 %; small counts come out exact.
SKETCH_BITS = 14
MEASURES = ("avg_speed", "messages", "vehicles", "moving", "stopped", "sos", "ignition_on")
_COUNTS = ("messages", "moving", "stopped", "sos", "ignition_on")


def panes(pings: DataFrame, time: str = "timestamp", width: str = "1 minute", bits: int = SKETCH_BITS) -> DataFrame:
    """(pane, route_no, speed_sum, speeds, vehicles, _COUNTS): what windows of any width are put together from, a row for each route and pane of time.

    Every ping counts in one pane only, so nothing is multiplied before the
    shuffle; vehicles is a sketch that can be merged. The same on a stream (after
    a watermark) and on a table; stored, it answers widths that are asked for later.
    """
    found = pings.groupBy(F.window(time, width).alias("w"), "route_no").agg(*_measured(), F.hll_sketch_agg("vehicle", bits).alias("vehicles"))
    return found.select(F.col("w.start").alias("pane"), "route_no", "speed_sum", "speeds", "vehicles", *_COUNTS)


def vehicle_panes(pings: DataFrame, time: str = "timestamp", width: str = "1 minute") -> DataFrame:
    """(pane, route_no, vehicle, speed_sum, speeds, _COUNTS): panes of each vehicle, for windows whose vehicles are to be counted exactly; at most a row for each ping."""
    found = pings.groupBy(F.window(time, width).alias("w"), "route_no", "vehicle").agg(*_measured())
    return found.select(F.col("w.start").alias("pane"), "route_no", "vehicle", "speed_sum", "speeds", *_COUNTS)


def _measured() -> list[Column]:
    return [
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speeds"), F.count("*").alias("messages"), F.sum(flag(F.col("speed") > 0)).alias("moving"),
        F.sum(flag(F.col("speed") == 0)).alias("stopped"), F.sum(flag(F.col("sos"))).alias("sos"), F.sum(flag(F.col("ignition"))).alias("ignition_on"),
    ]


def merged_panes(partials: DataFrame, width: str, slide: str) -> DataFrame:
    """Panes of a width that begin every slide, from narrower ones: the width a multiple of the slide, the slide one of the panes'."""
    step, size = F.expr(f"INTERVAL {slide}"), F.expr(f"INTERVAL {width}")
    newest = F.window("pane", slide)["start"]
    begins = partials.withColumn("pane", F.explode(F.sequence(newest - size + step, newest, step)))
    return begins.groupBy("pane", "route_no").agg(F.sum("speed_sum").alias("speed_sum"), F.sum("speeds").alias("speeds"), F.hll_union_agg("vehicles").alias("vehicles"), *(F.sum(c).alias(c) for c in _COUNTS))


def merged_vehicle_panes(partials: DataFrame, width: str, slide: str) -> DataFrame:
    """merged_panes() of vehicle_panes(), with the exact number of different vehicles.

    A vehicle counts in the windows that begin since its pane before this one
    ended: in those that hold both, that one has counted it. So panes are summed up by
    route, time and since before they are put into windows.
    """
    step, size = F.expr(f"INTERVAL {slide}"), F.expr(f"INTERVAL {width}")
    newest, oldest = F.col("newest"), F.col("newest") - size + step
    before = F.lag("newest").over(Window.partitionBy("route_no", "vehicle").orderBy("newest"))
    since = F.when(F.col("vehicle").isNotNull(), F.greatest(oldest, before + step))
    marked = partials.withColumn("newest", F.window("pane", slide)["start"]).withColumn("since", since)
    sums = [F.sum(c).alias(c) for c in ("speed_sum", "speeds", *_COUNTS)]
    begins = marked.groupBy("route_no", "newest", "since").agg(*sums, F.count("vehicle").alias("vehicles")).withColumn("pane", F.explode(F.sequence(oldest, newest, step)))
    return begins.groupBy("pane", "route_no").agg(*sums, F.sum(F.when(F.col("pane") >= F.col("since"), F.col("vehicles")).otherwise(0)).alias("vehicles"))


def pane_kpis(partials: DataFrame, width: str) -> DataFrame:
    """(window_start, window_end, route_no, MEASURES) of panes of a width, whose vehicles are sketches or numbers."""
    vehicles = F.hll_sketch_estimate("vehicles") if dict(partials.dtypes)["vehicles"] == "binary" else F.col("vehicles")
    mean = F.when(F.col("speeds") > 0, F.col("speed_sum") / F.col("speeds"))
    return partials.select(F.col("pane").alias("window_start"), (F.col("pane") + F.expr(f"INTERVAL {width}")).alias("window_end"), "route_no", mean.alias("avg_speed"), "messages", vehicles.alias("vehicles"), *_COUNTS[1:])


def window_kpis(pings: DataFrame, time: str = "timestamp", width: str = "5 minutes", slide: str | None = "1 minute", exact: bool = False) -> DataFrame:
    """KPIs per sliding (slide None: tumbling) window and route, by panes of the slide's width; vehicles by sketches or, for tables, exactly. Sliding ones are for tables; a stream stores its panes and is asked through those."""
    if exact:
        return pane_kpis(merged_vehicle_panes(vehicle_panes(pings, time, slide or width), width, slide or width), width)
    return pane_kpis(panes(pings, time, width) if slide is None else merged_panes(panes(pings, time, slide), width, slide), width)
