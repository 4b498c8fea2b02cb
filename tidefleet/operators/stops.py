"""Long stops, terminals as places where many of them are, and the best pair of those per route."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.geo import EARTH_KM, cell, haversine_km, neighbour_cells
from tidefleet.operators.scans import Tracks, lag, total
from tidefleet.session import work_dir

GAP_SECONDS, LONG_SECONDS, RADIUS_KM, CELL_DEGREES, CANDIDATES = 300, 600, 0.25, 0.0025, 8


def stop_sessions(pings: DataFrame, gap: int = GAP_SECONDS, least: int = LONG_SECONDS) -> DataFrame:
    """(route_id, vehicle, session_id, stop_lng, stop_lat, pings, start_ep, end_ep, seconds): stops of at least so many seconds.

    A ping stands still if its speed is zero or unknown; a session starts where
    the one before was moving, is missing, or lies further back than gap.
    """
    still = F.coalesce(F.col("speed") == 0, F.lit(True))
    marked = Tracks.of(pings.withColumn("still", still), ["route_id", "vehicle"], "ep", "event_id", counted=pings).scan(before=lag("ep"), was_still=lag("still"))
    starts = F.col("still") & (F.col("before").isNull() | ~F.col("was_still") | (F.col("ep") - F.col("before") > gap))
    numbered = marked.add(starts=F.when(starts, 1).otherwise(0)).scan(session_id=total("starts")).plain()
    grouped = numbered.filter("still").groupBy("route_id", "vehicle", "session_id").agg(
        F.avg("x").alias("stop_lng"), F.avg("y").alias("stop_lat"), F.count("*").alias("pings"), F.min("ep").alias("start_ep"), F.max("ep").alias("end_ep")
    )
    return grouped.withColumn("seconds", F.col("end_ep") - F.col("start_ep")).filter(F.col("seconds") >= least)


def radius_join(left: DataFrame, right: DataFrame, km: float = RADIUS_KM, size: float = CELL_DEGREES) -> DataFrame:
    """Pairs of rows of one route within a distance, by an equi-join on neighbouring grid cells.

    Both sides have route_id, id, lng, lat; the cell must be at least as wide as
    the radius, so that 3 x 3 cells cover it.
    """
    a = left.select("route_id", F.col("id").alias("a_id"), F.col("lng").alias("a_lng"), F.col("lat").alias("a_lat"), F.explode(neighbour_cells(cell(F.col("lng"), size), cell(F.col("lat"), size))).alias("c"))
    a = a.select("route_id", "a_id", "a_lng", "a_lat", "c.cx", "c.cy")
    b = right.select("route_id", F.col("id").alias("b_id"), F.col("lng").alias("b_lng"), F.col("lat").alias("b_lat"), cell(F.col("lng"), size).alias("cx"), cell(F.col("lat"), size).alias("cy"))
    near = haversine_km(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")) <= km
    return a.join(b, ["route_id", "cx", "cy"]).filter(near).drop("cx", "cy")


#: Where a cell has more places than HOT_CELL, cells are split into 2 x 2, so many times at most (to a quarter of a metre); cells of FEW places at most are compared place by place.
HOT_CELL, SPLITS, FEW = 200, 10, 10


def around(stops: DataFrame, km: float = RADIUS_KM, size: float = CELL_DEGREES, hot: int = HOT_CELL, first: int | None = None) -> DataFrame:
    """(route_id, a_id, density, lng, lat): for each stop how many of its route lie within a distance, itself included, and their centre.

    With first, only stops that can be among so many of their route with most
    around them need be there: all of those are, with all that rank alike.

    Where no grid cell holds more than hot stops, all pairs of neighbouring cells
    are compared. Else stops of one place count once, with their number, and
    pairs of cells are looked at from coarse to fine: cells that lie within the
    distance as a whole count as sums, those beyond it not at all, and only what
    is left, a ring, is split further; pairs of small cells are compared place by
    place. What is sure and what is left bound a cell's densities: with first, a
    cell is left alone once so many stops are sure to have more around them than
    its own can have. Work grows with places and cells, not with pairs of stops.
    """
    spark, root = stops.sparkSession, work_dir(stops.sparkSession)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    stops = kept(stops.select("route_id", "id", "lng", "lat"), "stops")
    most = stops.groupBy("route_id", cell(F.col("lng"), size), cell(F.col("lat"), size)).count().agg(F.max("count")).collect()[0][0]
    if (most or 0) <= hot:
        return radius_join(stops, stops, km, size).groupBy("route_id", "a_id").agg(F.count("*").alias("density"), F.avg("b_lng").alias("lng"), F.avg("b_lat").alias("lat"))

    fine = size / 2**SPLITS
    finest = F.floor(F.col("lng") / fine).alias("fx"), F.floor(F.col("lat") / fine).alias("fy")
    places = kept(stops.groupBy("route_id", "lng", "lat").agg(F.count("*").alias("n")).select("*", *finest), "places")
    at = lambda level, side="": (F.shiftright("fx", SPLITS - level).alias(f"{side}cx"), F.shiftright("fy", SPLITS - level).alias(f"{side}cy"))
    A, B, UP = ["route_id", "a_cx", "a_cy"], ["route_id", "b_cx", "b_cy"], ["route_id", "a_up_cx", "a_up_cy"]
    up = lambda side: [F.shiftright(f"{side}_{c}", 1).alias(f"{side}_up_{c}") for c in ("cx", "cy")]
    above = {f"{s}_{c}": f"{s}_up_{c}" for s in "ab" for c in ("cx", "cy")}

    def cells(level: int, side: str) -> DataFrame:
        """Cells of a level with their places, sums and extent."""
        found = places.select("*", *at(level)).groupBy("route_id", "cx", "cy").agg(
            F.count("*").alias("m"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("lng")).alias("sx"), F.sum(F.col("n") * F.col("lat")).alias("sy"), *(f(c).alias(f"{a}_{c}") for c in ("lng", "lat") for f, a in ((F.min, "low"), (F.max, "high")))
        )
        return found.select("route_id", *(F.col(c).alias(f"{side}_{c}") for c in found.columns if c != "route_id"))

    levels, least, split, bounds = [], None, None, None
    small = min(hot, FEW)
    for level in range(SPLITS + 1):
        a, b = cells(level, "a"), cells(level, "b")
        if level == 0:
            beside = a.withColumn("c", F.explode(neighbour_cells(F.col("a_cx"), F.col("a_cy")))).withColumns({"cx": F.col("c.cx"), "cy": F.col("c.cy")}).drop("c")
            pairs = beside.join(b.withColumns({"cx": F.col("b_cx"), "cy": F.col("b_cy")}), ["route_id", "cx", "cy"]).drop("cx", "cy")
        else:  # the children of what was left
            left = split.select(*A, "b_cx", "b_cy").withColumnsRenamed(above)
            pairs = left.join(a.select("*", *up("a")), UP).join(b.select("*", *up("b")), ["route_id", "b_up_cx", "b_up_cy"])
        few = (F.col("a_m") <= small) & (F.col("b_m") <= small) if level < SPLITS else F.lit(True)
        kind = F.when(F.col("far") <= km, "sure").when(few, "each").otherwise("split")
        near = pairs.withColumns({"near": _extent(True), "far": _extent(False)}).filter(F.col("near") <= km)
        pairs = kept(near.select(*A, "a_n", "b_cx", "b_cy", "b_n", "b_sx", "b_sy", kind.alias("kind")), f"pairs-{level}")
        of = lambda k, c: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col(c))), F.lit(0))
        sums = pairs.groupBy(*A).agg(F.first("a_n").alias("a_n"), of("sure", "b_n").alias("n"), of("sure", "b_sx").alias("sx"), of("sure", "b_sy").alias("sy"), of("each", "b_n").alias("open"), of("split", "b_n").alias("rest"))
        split = pairs.filter("kind = 'split'")
        if first:
            if bounds is not None:
                before = bounds.select(*(F.col(c).alias(above.get(c, c)) for c in A), F.col("low").alias("low_up"), F.col("open").alias("open_up"))
                sums = sums.select("*", *up("a")).join(before, UP).drop(*UP[1:])
            else:
                sums = sums.withColumns({"low_up": F.lit(0), "open_up": F.lit(0)})
            sums = kept(sums.withColumn("low", F.col("n") + F.col("low_up")), f"sums-{level}")
            bounds = sums.select(*A, "a_n", "low", (F.col("open") + F.col("open_up")).alias("open"), "rest")
            known = _reached(bounds, first)
            least = kept(known if least is None else known.unionAll(least).groupBy("route_id").agg(F.max("least").alias("least")), f"least-{level}")
            can = bounds.join(least, "route_id", "left").filter(F.col("least").isNull() | (F.col("low") + F.col("open") + F.col("rest") >= F.col("least")))
            split = split.join(can.select(*A), A, "left_semi")
        levels.append((level, pairs, sums))
        if split.isEmpty():
            break
    mine = lambda rows, level: rows.select("route_id", "lng", "lat", *at(level, "a_"))
    found = [mine(places, level).join(sums, A).select("route_id", "lng", "lat", "n", "sx", "sy", "open") for level, _, sums in levels]
    found = reduce(DataFrame.unionAll, found).groupBy("route_id", "lng", "lat").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "open")))
    asked = places
    if first:  # what was left alone has too little here, too
        found = found.join(least, "route_id", "left").filter(F.col("least").isNull() | (F.col("n") + F.col("open") >= F.col("least"))).drop("least")
        found = kept(found.select("*", *finest), "found")
        asked = found
    parts = [found.select("route_id", "lng", "lat", "n", "sx", "sy")]
    for level, pairs, _ in levels:
        theirs = places.select("route_id", F.col("lng").alias("b_lng"), F.col("lat").alias("b_lat"), "n", *at(level, "b_"))
        each = pairs.filter("kind = 'each'").select(*A, "b_cx", "b_cy").join(mine(asked, level), A).join(theirs, B)
        met = each.filter(haversine_km(F.col("lat"), F.col("lng"), F.col("b_lat"), F.col("b_lng")) <= km)
        parts.append(met.select("route_id", "lng", "lat", "n", (F.col("n") * F.col("b_lng")).alias("sx"), (F.col("n") * F.col("b_lat")).alias("sy")))
    sums = reduce(DataFrame.unionAll, parts).groupBy("route_id", "lng", "lat").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy")))
    own = stops.select("route_id", F.col("id").alias("a_id"), "lng", "lat")
    return own.join(sums, ["route_id", "lng", "lat"]).select("route_id", "a_id", F.col("n").alias("density"), (F.col("sx") / F.col("n")).alias("lng"), (F.col("sy") / F.col("n")).alias("lat"))


def _reached(bounds: DataFrame, first: int) -> DataFrame:
    """(route_id, least): of each route with that many stops in bounds, what at least first of them are sure to have around them."""
    best = Window.partitionBy("route_id").orderBy(F.desc("low"))
    top = bounds.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= first)  # each has a stop or more
    held = F.sum("a_n").over(Window.partitionBy("route_id").orderBy("nth"))
    return top.withColumn("held", held).filter(F.col("held") >= first).groupBy("route_id").agg(F.max("low").alias("least"))


def _extent(least: bool) -> Column:
    """Kilometres that places of two cells are apart at least or at most, with a thousandth to spare: for what is small a plane will do."""
    apart = lambda c: F.greatest(F.col(f"a_low_{c}") - F.col(f"b_high_{c}"), F.col(f"b_low_{c}") - F.col(f"a_high_{c}"), F.lit(0.0)) if least else F.greatest(F.col(f"a_high_{c}") - F.col(f"b_low_{c}"), F.col(f"b_high_{c}") - F.col(f"a_low_{c}"))
    north, south = F.greatest("a_high_lat", "b_high_lat"), F.least("a_low_lat", "b_low_lat")
    width = F.least(F.cos(F.radians(north)), F.cos(F.radians(south))) if least else F.when((north > 0) & (south < 0), 1.0).otherwise(F.greatest(F.cos(F.radians(north)), F.cos(F.radians(south))))
    return EARTH_KM * F.radians(F.sqrt(apart("lat") ** 2 + (apart("lng") * width) ** 2)) * (0.999 if least else 1.001)


def terminal_candidates(sessions: DataFrame, km: float = RADIUS_KM, size: float = CELL_DEGREES, most: int = CANDIDATES) -> DataFrame:
    """(route_id, anchor, lng, lat, density, rank): the stops with most stops around, their centres and counts."""
    order = Window.partitionBy("route_id").orderBy("vehicle", "session_id")
    stops = sessions.select("route_id", F.row_number().over(order).cast("long").alias("id"), F.col("stop_lng").alias("lng"), F.col("stop_lat").alias("lat"))
    dense = around(stops, km, size, first=most)
    best = Window.partitionBy("route_id").orderBy(F.desc("density"), "a_id")
    return dense.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= most).select("route_id", F.col("a_id").alias("anchor"), "lng", "lat", "density", "rank")


def terminal_pair(candidates: DataFrame) -> DataFrame:
    """The two candidates of each route that lie furthest apart; of equals, the denser, then the first."""
    a = candidates.select("route_id", *(F.col(c).alias(f"a_{c}") for c in ("anchor", "lng", "lat", "density")))
    b = candidates.select("route_id", *(F.col(c).alias(f"b_{c}") for c in ("anchor", "lng", "lat", "density")))
    pairs = a.join(b, "route_id").filter("a_anchor < b_anchor").withColumn("km", haversine_km(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")))
    best = Window.partitionBy("route_id").orderBy(F.desc("km"), F.desc(F.col("a_density") + F.col("b_density")), "a_anchor", "b_anchor")
    return pairs.withColumn("rank", F.row_number().over(best)).filter("rank = 1").drop("rank").withColumn("method", F.lit("density-neighborhood"))
