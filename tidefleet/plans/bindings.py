"""Pings, mappings, routes and stops made from the generated tables, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefleet.functions.pings import epoch_seconds, local_time

#: Events are sparse (hours apart); what needs neighbouring pings takes gaps of two days.
GAP_SECONDS = 172_800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicle, route_id: the route of each vehicle. Vehicles of routes above 22 have none."""
    c = table(spark, sf_dir, "customer")
    return c.filter("c_nationkey <= 22").select(F.col("c_custkey").cast("string").alias("vehicle"), F.col("c_nationkey").alias("route_id"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route_id, route_no, terminals A and B, and path: an array of [lng, lat]."""
    k = F.col("n_nationkey").cast("double") * 0.004
    a_lng, b_lng = k + 106.60, k + 106.65
    points = [F.array(a_lng, F.lit(10.70)), F.array(k + 106.625, F.lit(10.725)), F.array(b_lng, F.lit(10.75))]
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("route_id"), F.col("n_name").alias("route_no"), a_lng.alias("a_lng"), F.lit(10.70).alias("a_lat"), b_lng.alias("b_lng"), F.lit(10.75).alias("b_lat"), F.array(*points).alias("path")
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop_id, stop_lng, stop_lat, routes: five stops a route, served by it and, at every other stop, by the next one too."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("route_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    k, i = F.col("route_id").cast("double"), F.col("i").cast("double")
    near = F.when(F.col("i") % 2 == 0, F.concat_ws(", ", F.col("route_id").cast("string"), ((F.col("route_id") + 1) % 25).cast("string"))).otherwise(F.col("route_id").cast("string"))
    return n.select((F.col("route_id") * 5 + F.col("i")).cast("long").alias("stop_id"), (k * 0.004 + 106.60 + i * 0.0125).alias("stop_lng"), (i * 0.0125 + 10.70).alias("stop_lat"), near.alias("routes"))


def waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of every event: the vehicle runs between its route's terminals, seen at the event's time."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("route_id"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("route_id"), F.col("n_name").alias("route_no"))
    p = e.join(c, e.user_id == c.c_custkey).join(n, "route_id").withColumn("ep", epoch_seconds(F.col("ts")))
    along = F.abs((F.col("ep") + F.col("user_id") * 3571) % 172800 / F.lit(86400.0) - F.lit(1.0))
    jitter = ((F.col("event_id") * 7919) % 1000 - 500).cast("double") * F.lit(1e-6)
    k = F.col("route_id").cast("double") * 0.004
    local = local_time(F.col("ts"))
    every = lambda n: F.col("event_id") % n == 0
    return p.select(
        "event_id", F.col("user_id").cast("string").alias("vehicle"), "route_id", "route_no", F.col("ts").alias("timestamp"), "ep",
        (k + 106.60 + along * 0.05 + jitter).alias("x"), (along * 0.05 + 10.70 - jitter).alias("y"),
        F.when(F.col("event_type").isin("error", "signup"), 0.0).otherwise(F.col("value")).alias("speed"), ((F.col("event_id") * 53) % 360).cast("double").alias("heading"),
        (F.col("event_type") == "error").alias("sos"), (F.col("event_type") != "signup").alias("ignition"), every(2).alias("aircon"), every(3).alias("door_up"), every(5).alias("door_down"), (~every(7)).alias("working"),
        local.cast("date").alias("date"), F.hour(local).cast("long").alias("hour"), "props",
    )


def dense_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pings ten seconds apart per vehicle, with a minute's gap after every seventeen."""
    w = Window.partitionBy("vehicle").orderBy("ep", "event_id")
    seq = F.row_number().over(w).cast("long")
    return waypoints(spark, sf_dir).withColumn("seq", seq).withColumn("ept", F.col("seq") * 10 + F.floor(F.col("seq") / 17).cast("long") * 60)


MAPPING_SQL = "mp AS (SELECT CAST(c_custkey AS VARCHAR) AS vehicle, c_nationkey AS route_id FROM customer WHERE c_nationkey <= 22)"
ROUTES_SQL = """rt AS (SELECT n_nationkey AS route_id, n_name AS route_no, CAST(n_nationkey AS DOUBLE) * CAST(0.004 AS DOUBLE) + CAST(106.60 AS DOUBLE) AS a_lng, CAST(10.70 AS DOUBLE) AS a_lat,
  CAST(n_nationkey AS DOUBLE) * CAST(0.004 AS DOUBLE) + CAST(106.65 AS DOUBLE) AS b_lng, CAST(10.75 AS DOUBLE) AS b_lat FROM nation)"""
STOPS_SQL = """st AS (SELECT CAST(n_nationkey * 5 + i AS BIGINT) AS stop_id, CAST(n_nationkey AS DOUBLE) * CAST(0.004 AS DOUBLE) + CAST(106.60 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.0125 AS DOUBLE) AS stop_lng,
  CAST(i AS DOUBLE) * CAST(0.0125 AS DOUBLE) + CAST(10.70 AS DOUBLE) AS stop_lat,
  CASE WHEN i % 2 = 0 THEN CAST(n_nationkey AS VARCHAR) || ', ' || CAST((n_nationkey + 1) % 25 AS VARCHAR) ELSE CAST(n_nationkey AS VARCHAR) END AS routes
  FROM nation, range(5) AS r(i))"""
WAYPOINTS_SQL = """w0 AS (SELECT e.*, c.c_nationkey AS route_id, n.n_name AS route_no, CAST(floor(epoch(e.ts)) AS BIGINT) AS ep
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey),
w1 AS (SELECT *, abs(CAST((ep + user_id * 3571) % 172800 AS DOUBLE) / CAST(86400 AS DOUBLE) - CAST(1 AS DOUBLE)) AS fr, CAST((event_id * 7919) % 1000 - 500 AS DOUBLE) * CAST(0.000001 AS DOUBLE) AS jit,
  CAST(route_id AS DOUBLE) * CAST(0.004 AS DOUBLE) AS k FROM w0),
wp AS (SELECT event_id, CAST(user_id AS VARCHAR) AS vehicle, route_id, route_no, ts AS "timestamp", ep, k + CAST(106.60 AS DOUBLE) + fr * CAST(0.05 AS DOUBLE) + jit AS x, fr * CAST(0.05 AS DOUBLE) + CAST(10.70 AS DOUBLE) - jit AS y,
  CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE value END AS speed, CAST((event_id * 53) % 360 AS DOUBLE) AS heading, event_type = 'error' AS sos, event_type <> 'signup' AS ignition,
  event_id % 2 = 0 AS aircon, event_id % 3 = 0 AS door_up, event_id % 5 = 0 AS door_down, event_id % 7 <> 0 AS working, CAST(ts + INTERVAL 7 HOUR AS DATE) AS date, CAST(hour(ts + INTERVAL 7 HOUR) AS BIGINT) AS hour, props FROM w1)"""
DENSE_SQL = WAYPOINTS_SQL + """,
d0 AS (SELECT *, CAST(row_number() OVER (PARTITION BY vehicle ORDER BY ep, event_id) AS BIGINT) AS seq FROM wp),
dw AS (SELECT *, seq * 10 + CAST(floor(seq / 17) AS BIGINT) * 60 AS ept FROM d0)"""


def haversine_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)"
    return f"(CAST(12742 AS DOUBLE) * asin(sqrt(least(CAST(1 AS DOUBLE), {a}))))"
