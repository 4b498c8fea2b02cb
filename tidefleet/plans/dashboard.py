"""The dashboards' queries, over pings with speed features (G) and trips (T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefleet.operators import cleaning, status
from tidefleet.operators.quantiles import quantiles
from tidefleet.plans import bindings as b
from tidefleet.plans.bindings import WAYPOINTS_SQL
from tidefleet.plans.domain import TRIPS_SQL, trip_rows

Q: dict = {}
SQL: dict[str, str] = {}
G_SQL = WAYPOINTS_SQL + """, g AS (SELECT *, CASE WHEN speed = 0 THEN 'stopped' WHEN speed < 20 THEN 'slow' WHEN speed < 60 THEN 'normal' ELSE 'fast' END AS speed_level, CASE WHEN dayofweek(date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type FROM wp)"""
T_SQL = TRIPS_SQL + """, t AS (SELECT *, CAST(hour(make_timestamp(start_ep * 1000000) + INTERVAL 7 HOUR) AS BIGINT) AS hour_vn, TRUE AS is_completed, CASE WHEN minutes > 0 THEN 60 * total_km / minutes ELSE 0 END AS avg_speed FROM tp)"""


def G(s: SparkSession, d: str, routes: list[str] | None = None, days: tuple[str, str] | None = None) -> DataFrame:  # noqa: N802
    return filtered(cleaning.speed_features(b.waypoints(s, d)), routes, None, days)


def T(s: SparkSession, d: str, routes: list[str] | None = None, directions: list[str] | None = None, days: tuple[str, str] | None = None) -> DataFrame:  # noqa: N802
    local_hour = F.floor((F.col("start_ep") + 7 * 3600) % 86400 / 3600).cast("long")
    speed = F.when(F.col("minutes") > 0, 60 * F.col("total_km") / F.col("minutes")).otherwise(0.0)
    rows = trip_rows(s, d).withColumns({"hour_vn": local_hour, "is_completed": F.lit(True), "avg_speed": speed})
    return filtered(rows, routes, directions, days)


def filtered(rows: DataFrame, routes: list[str] | None = None, directions: list[str] | None = None, days: tuple[str, str] | None = None) -> DataFrame:
    """The dashboards' common filters; None filters nothing."""
    for column, values in (("route_no", routes), ("direction", directions)):
        if values is not None:
            rows = rows.filter(F.col(column).isin(values))
    return rows if days is None else rows.filter(F.col("date").between(*(F.lit(x).cast("date") for x in days)))


def _add(name: str, source: str, columns: list[str | tuple[str, str]], by: tuple[str, ...] = (), where: str | tuple[str, str] | None = None) -> None:
    """A grouped query by some keys of G or T; a pair says the same for Spark and for the other engine where they differ."""
    mine, theirs = ([c if isinstance(c, str) else c[i] for c in columns] for i in (0, 1))
    conditions = (where, where) if where is None or isinstance(where, str) else where

    def run(s: SparkSession, d: str) -> DataFrame:
        rows = (G if source == "g" else T)(s, d)
        rows = rows.filter(conditions[0]) if conditions[0] else rows
        return rows.groupBy(*by).agg(*map(F.expr, mine))

    run.__name__ = name
    Q[name] = run
    filter_ = f" WHERE {conditions[1]}" if conditions[1] else ""
    SQL[name] = f"WITH {G_SQL if source == 'g' else T_SQL} SELECT {', '.join([*by, *theirs])} FROM {source}{filter_}{f' GROUP BY {", ".join(by)}' if by else ''}"


_add("kpi_active_buses", "t", ["COUNT(DISTINCT vehicle) AS buses"])
_add("kpi_active_routes", "t", ["COUNT(DISTINCT route_no) AS routes"])
_add("kpi_total_trips", "t", ["COUNT(trip_id) AS trips"])
_add("kpi_total_distance", "t", ["ROUND(SUM(total_km), 3) AS km"])
_add("kpi_avg_duration", "t", ["ROUND(AVG(minutes), 4) AS minutes"])
_add("kpi_avg_speed", "g", ["ROUND(AVG(speed), 4) AS speed"], where="speed > 0")
_add("avg_speed_by_route", "g", ["ROUND(AVG(speed), 4) AS speed"], ("route_no",), "speed > 0")
_add("speed_by_hour_daytype", "g", ["ROUND(AVG(speed), 4) AS speed"], ("hour", "day_type"), "speed > 0")
_add("speed_level_share", "g", ["COUNT(*) AS n"], ("speed_level",))
_add("direction_share", "t", ["COUNT(*) AS n"], ("direction",))
_add("trips_by_route", "t", ["COUNT(*) AS n"], ("route_no",))
_add("trips_by_hour", "t", ["COUNT(*) AS n"], ("hour_vn",))
_add("active_bus_by_hour", "g", ["COUNT(DISTINCT CASE WHEN speed IS NOT NULL THEN vehicle END) AS buses", "ROUND(AVG(CASE WHEN speed > 0 THEN speed END), 4) AS moving_speed"], ("hour",), "hour BETWEEN 4 AND 21")
_add("bus_table", "g", ["ROUND(AVG(speed), 4) AS avg_speed", "MAX(speed) AS max_speed", "COUNT(*) AS n"], ("route_no", "vehicle"))
_add("completed_by_route", "t", ["COUNT(*) AS n"], ("route_no",), "is_completed")
_add("completion_ratio", "t", ["ROUND(CAST(COUNT(CASE WHEN is_completed THEN 1 END) AS DOUBLE) / NULLIF(COUNT(*), 0), 6) AS ratio"], ("route_no",))
_add("hourly_direction", "t", ["COUNT(*) AS n"], ("date", "hour_vn", "direction"))
_add("direction_by_route", "t", ["COUNT(*) AS n"], ("direction", "route_no"))
_add("overview_table", "t", ["COUNT(*) AS n", "ROUND(AVG(avg_speed), 4) AS avg_speed"], ("route_no", "vehicle"))
# route numbers as lines have them: some are numbers, such as 163, some aren't, such as 163V
_NUMBER = "CASE WHEN route_id % 3 > 0 THEN CAST(100 + route_id AS STRING) ELSE CONCAT(CAST(100 + route_id AS STRING), 'V') END"
_add("max_route_number", "g", [f"MAX(TRY_CAST({_NUMBER} AS DOUBLE)) AS number", f"COUNT(CASE WHEN TRY_CAST({_NUMBER} AS DOUBLE) IS NULL THEN 1 END) AS unparsed"])


def position_scatter(s: SparkSession, d: str) -> DataFrame:
    g = G(s, d).groupBy(F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "speed_level").agg(F.max("speed").alias("radius"))
    return g.orderBy(F.desc("radius"), "x", "y", "speed_level").limit(15000)


def trip_table(s: SparkSession, d: str) -> DataFrame:
    keys = ("date", "vehicle", "trip_id", "route_no", "direction", "confidence", "minutes", "total_km", "is_completed")
    return T(s, d).select(*keys).distinct().orderBy("date", "vehicle", "trip_id").limit(5000)


#: Trips of the generated pings take days; an hour counts for a minute in what is meant for minutes.
HOURS_AS_MINUTES = 60.0


def boxplot(trips: DataFrame, keys: tuple[str, ...], value: str = "minutes", low: float | None = 1, high: float | None = 300) -> DataFrame:
    """Quartiles by some keys of hourly mean durations, and Tukey's whiskers: the outermost values within 1.5 quartile ranges. Durations beyond the limits don't count."""
    rows = trips if low is None else trips.filter(F.col(value).between(low, high))
    hourly = rows.groupBy((F.floor(F.col("start_ep") / 3600) * 3600).alias("hour"), *keys).agg(F.avg(value).alias("v"))
    q = quantiles(hourly, list(keys), "v", [0.25, 0.5, 0.75]).select(*keys, *(F.col("q")[i].alias(f"q{i + 1}") for i in range(3)))
    far = 1.5 * (F.col("q3") - F.col("q1"))
    inside = hourly.join(q, list(keys)).filter((F.col("v") >= F.col("q1") - far) & (F.col("v") <= F.col("q3") + far))
    whiskers = inside.groupBy(*keys, "q1", "q2", "q3").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return whiskers.select(*keys, *(F.round(c, 4).alias(c) for c in ("q1", "q2", "q3", "low", "high")))


def duration_boxplot(s: SparkSession, d: str) -> DataFrame:
    return boxplot(T(s, d).withColumn("minutes", F.col("minutes") / HOURS_AS_MINUTES), ("route_no",))


def duration_boxplot_by_direction(s: SparkSession, d: str) -> DataFrame:
    return boxplot(T(s, d), ("route_no", "direction"), low=None)


def live_positions(s: SparkSession, d: str) -> DataFrame:
    """Of the newest 3000 pings those with the ignition on and of some routes; the last of each vehicle."""
    on = newest_pings(s, d, "route_no", "ignition", "x", "y", "speed", "heading", "aircon").filter("ignition").filter("route_no rlike '[02468]$'")
    return on.groupBy("vehicle").agg(F.max(F.struct("ep", "event_id", "route_no", "x", "y", "speed", "heading", "aircon")).alias("p")).select("vehicle", "p.*")


def newest_pings(s: SparkSession, d: str, *more: str) -> DataFrame:
    return b.waypoints(s, d).select("event_id", "vehicle", "ep", *more).orderBy(F.desc("ep"), F.desc("event_id")).limit(3000)


#: What a user may pick on the dashboards.
PICKED = {"routes": ["NATION_1", "NATION_7", "NATION_12", "NATION_20"], "directions": ["OUTBOUND"], "days": ("2024-01-05", "2024-01-20")}


def filtered_trips(s: SparkSession, d: str) -> DataFrame:
    """Trips, kilometres and minutes of picked routes, directions and days."""
    return T(s, d, **PICKED).groupBy("route_no", "direction", "date").agg(F.count("*").alias("n"), F.round(F.sum("total_km"), 3).alias("km"), F.round(F.avg("minutes"), 4).alias("minutes"))


def filtered_speeds(s: SparkSession, d: str) -> DataFrame:
    """Speed levels of picked routes and days; a pick of no route has no rows."""
    levels = G(s, d, routes=PICKED["routes"], days=PICKED["days"]).unionAll(G(s, d, routes=[]))
    return levels.groupBy("route_no", "speed_level").agg(F.count("*").alias("n"), F.round(F.avg("speed"), 4).alias("speed"))


def route_hours_of_day(s: SparkSession, d: str) -> DataFrame:
    """Pings by route and hour of the newest day."""
    w = b.waypoints(s, d).select("route_id", "hour", "date")
    last = w.agg(F.max("date").alias("last"))
    return w.join(F.broadcast(last), F.col("date") == F.col("last")).groupBy("route_id", "hour").agg(F.count("*").alias("n"))


def last_seen_three_days(s: SparkSession, d: str) -> DataFrame:
    """When each vehicle of the newest days was seen last."""
    w = b.waypoints(s, d).select("vehicle", "ep", "date")
    last = w.agg(F.max("date").alias("last"))
    return w.join(F.broadcast(last), F.col("date") >= F.date_sub("last", 3)).groupBy("vehicle").agg(F.max("ep").alias("ep"))


def newest_3000(s: SparkSession, d: str) -> DataFrame:
    return newest_pings(s, d, "x", "y")


def routes_active(s: SparkSession, d: str) -> DataFrame:
    """Routes with a vehicle whose ignition is on."""
    latest = status.latest_status(b.waypoints(s, d))
    return latest.filter("ignition").groupBy("route_no").agg(F.count("*").alias("vehicles"))


def kpi_snapshot_last(s: SparkSession, d: str) -> DataFrame:
    """The newest five-minute KPIs of each route."""
    k = status.window_kpis(b.waypoints(s, d), slide=None, exact=True)
    return k.groupBy("route_no").agg(F.max("window_start").alias("window_start"), F.max_by("messages", "window_start").alias("messages"), F.max_by("vehicles", "window_start").alias("vehicles"))


Q |= {
    f.__name__: f
    for f in (position_scatter, trip_table, duration_boxplot, duration_boxplot_by_direction, newest_3000, live_positions, filtered_trips, filtered_speeds, route_hours_of_day, last_seen_three_days, routes_active, kpi_snapshot_last)
}


def _boxplot_sql(keys: str, value: str, where: str) -> str:
    same = " AND ".join(f"h.{k} = q.{k}" for k in keys.split(", "))
    picked = ", ".join(f"q.{k}" for k in keys.split(", "))
    return f"""WITH {T_SQL}, h AS (SELECT floor(start_ep / 3600) AS hour, {keys}, AVG({value}) AS v FROM t WHERE {where} GROUP BY ALL), q AS (SELECT {keys}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM h GROUP BY ALL)
 SELECT {picked}, ROUND(q1, 4) AS q1, ROUND(q2, 4) AS q2, ROUND(q3, 4) AS q3, ROUND(MIN(v), 4) AS low, ROUND(MAX(v), 4) AS high FROM h JOIN q ON {same} WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) GROUP BY {picked}, q1, q2, q3"""


_ROUTES = ", ".join(f"'{r}'" for r in PICKED["routes"])
_DAYS = " AND ".join(f"DATE '{x}'" for x in PICKED["days"])
SQL |= {
    "position_scatter": f"WITH {G_SQL} SELECT ROUND(x, 3) AS x, ROUND(y, 3) AS y, speed_level, MAX(speed) AS radius FROM g GROUP BY 1, 2, 3 ORDER BY radius DESC, x, y, speed_level LIMIT 15000",
    "trip_table": f"WITH {T_SQL} SELECT DISTINCT date, vehicle, trip_id, route_no, direction, confidence, minutes, total_km, is_completed FROM t ORDER BY date, vehicle, trip_id LIMIT 5000",
    "duration_boxplot": _boxplot_sql("route_no", f"minutes / {HOURS_AS_MINUTES}::DOUBLE", f"minutes / {HOURS_AS_MINUTES}::DOUBLE BETWEEN 1 AND 300"),
    "duration_boxplot_by_direction": _boxplot_sql("route_no, direction", "minutes", "TRUE"),
    "live_positions": f"""WITH {WAYPOINTS_SQL}, n AS (SELECT * FROM wp ORDER BY ep DESC, event_id DESC LIMIT 3000) SELECT vehicle, ep, event_id, route_no, x, y, speed, heading, aircon FROM n WHERE ignition AND regexp_matches(route_no, '[02468]$')
 QUALIFY row_number() OVER (PARTITION BY vehicle ORDER BY ep DESC, event_id DESC) = 1""",
    "filtered_trips": f"WITH {T_SQL} SELECT route_no, direction, date, COUNT(*) AS n, ROUND(SUM(total_km), 3) AS km, ROUND(AVG(minutes), 4) AS minutes FROM t WHERE route_no IN ({_ROUTES}) AND direction = 'OUTBOUND' AND date BETWEEN {_DAYS} GROUP BY 1, 2, 3",
    "filtered_speeds": f"WITH {G_SQL} SELECT route_no, speed_level, COUNT(*) AS n, ROUND(AVG(speed), 4) AS speed FROM g WHERE route_no IN ({_ROUTES}) AND date BETWEEN {_DAYS} GROUP BY 1, 2",
    "route_hours_of_day": f"WITH {WAYPOINTS_SQL} SELECT route_id, hour, COUNT(*) AS n FROM wp WHERE date = (SELECT MAX(date) FROM wp) GROUP BY 1, 2",
    "last_seen_three_days": f"WITH {WAYPOINTS_SQL} SELECT vehicle, MAX(ep) AS ep FROM wp WHERE date >= (SELECT MAX(date) FROM wp) - 3 GROUP BY 1",
    "newest_3000": f"WITH {WAYPOINTS_SQL} SELECT event_id, vehicle, ep, x, y FROM wp ORDER BY ep DESC, event_id DESC LIMIT 3000",
    "routes_active": f"WITH {WAYPOINTS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY ep DESC, event_id DESC) AS rn FROM wp) SELECT route_no, COUNT(*) AS vehicles FROM l WHERE rn = 1 AND ignition GROUP BY 1",
    "kpi_snapshot_last": f"""WITH {WAYPOINTS_SQL}, k AS (SELECT route_no, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start, COUNT(*) AS messages, COUNT(DISTINCT vehicle) AS vehicles FROM wp GROUP BY 1, 2)
 SELECT route_no, MAX(window_start) AS window_start, arg_max(messages, window_start) AS messages, arg_max(vehicles, window_start) AS vehicles FROM k GROUP BY 1""",
}
