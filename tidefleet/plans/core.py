"""Scans, filters, joins, aggregates and windows over pings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefleet.functions.geo import haversine_km
from tidefleet.functions.pings import flag, ratio
from tidefleet.operators import cleaning, joins, routes, status
from tidefleet.operators.quantiles import quantiles
from tidefleet.operators.scans import Tracks, lag, last, total
from tidefleet.plans import bindings as b
from tidefleet.plans.bindings import DENSE_SQL, MAPPING_SQL, ROUTES_SQL, STOPS_SQL, WAYPOINTS_SQL, haversine_sql

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it must agree with."""

    def register(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def wp(s: SparkSession, d: str) -> DataFrame:
    return b.waypoints(s, d)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01' AND l_discount > 0.05")
def scan_filter_project(s: SparkSession, d: str) -> DataFrame:
    rows = b.table(s, d, "lineitem").filter("l_shipdate >= timestamp_ntz'1995-01-01' and l_shipdate < timestamp_ntz'1996-01-01' and l_discount > 0.05D")
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'click'")
def json_props_parse(s: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint").alias("p")
    return b.table(s, d, "events").filter("event_type = 'click'").select("event_id", parsed).select("event_id", "p.*")


@query(f"WITH {WAYPOINTS_SQL} SELECT event_id, vehicle, x, y FROM wp WHERE x BETWEEN 106.62 AND 106.68 AND y BETWEEN 10.71 AND 10.74")
def bbox_scan(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).filter(F.col("x").between(106.62, 106.68) & F.col("y").between(10.71, 10.74)).select("event_id", "vehicle", "x", "y")


@query(f"""WITH {MAPPING_SQL}, {WAYPOINTS_SQL} SELECT m.route_id, CAST(w."timestamp" AS DATE) AS day, COUNT(*) AS n FROM wp w JOIN mp m ON w.vehicle = m.vehicle
  WHERE w."timestamp" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1, 2""")
def timerange_join_count(s: SparkSession, d: str) -> DataFrame:
    in_time = wp(s, d).filter("timestamp between timestamp_ntz'2024-01-05' and timestamp_ntz'2024-01-20'").select("vehicle", F.to_date("timestamp").alias("day"))
    return in_time.join(b.mapping(s, d), "vehicle").groupBy("route_id", "day").agg(F.count("*").alias("n"))


@query(f"WITH {WAYPOINTS_SQL} SELECT route_no, date, COUNT(*) AS n FROM wp GROUP BY 1, 2 ORDER BY n DESC, route_no, date LIMIT 20")
def route_daily_top20(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).groupBy("route_no", "date").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "route_no", "date").limit(20)


@query(f"WITH {WAYPOINTS_SQL} SELECT event_id, vehicle, speed FROM wp ORDER BY speed DESC, event_id LIMIT 5")
def top5_fastest(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).select("event_id", "vehicle", "speed").orderBy(F.desc("speed"), "event_id").limit(5)


@query(f"WITH {WAYPOINTS_SQL} SELECT event_id, vehicle FROM wp WHERE vehicle IS NOT NULL AND x <> 0 AND y <> 0 AND event_id % 11 <> 0 AND speed <= 80")
def valid_gps_filter(s: SparkSession, d: str) -> DataFrame:
    broken = wp(s, d).withColumn("x", F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(F.col("x")))
    return cleaning.valid_gps(broken, 80.0).select("event_id", "vehicle")


@query(f"""WITH {WAYPOINTS_SQL} SELECT event_id, CASE WHEN speed = 0 THEN 'stopped' WHEN speed < 20 THEN 'slow' WHEN speed < 60 THEN 'normal' ELSE 'fast' END AS speed_level, CAST(speed > 0 AS BIGINT) AS is_moving,
  CAST(speed = 0 AS BIGINT) AS is_stopped, CASE WHEN dayofweek(date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type, CAST(hour IN (7, 8, 17, 18) AS BIGINT) AS is_peak_hour FROM wp""")
def speed_features(s: SparkSession, d: str) -> DataFrame:
    f = cleaning.speed_features(wp(s, d))
    return f.select("event_id", "speed_level", *(F.col(c).cast("long").alias(c) for c in ("is_moving", "is_stopped")), "day_type", F.col("is_peak_hour").cast("long").alias("is_peak_hour"))


@query(f"WITH {WAYPOINTS_SQL} SELECT event_id, date, hour FROM wp")
def local_time_cols(s: SparkSession, d: str) -> DataFrame:
    return cleaning.local_columns(wp(s, d)).select("event_id", "date", "hour")


@query(f"WITH {MAPPING_SQL}, {WAYPOINTS_SQL} SELECT w.event_id, w.vehicle, m.route_id FROM wp w LEFT JOIN mp m ON w.vehicle = m.vehicle")
def enrich_left_mapping(s: SparkSession, d: str) -> DataFrame:
    return cleaning.enrich(wp(s, d).drop("route_id", "route_no"), b.mapping(s, d)).select("event_id", "vehicle", "route_id")


@query(f"WITH {MAPPING_SQL}, {WAYPOINTS_SQL} SELECT w.event_id, w.vehicle, m.route_id FROM wp w JOIN mp m ON w.vehicle = m.vehicle")
def enrich_inner_mapping(s: SparkSession, d: str) -> DataFrame:
    return cleaning.enrich(wp(s, d).drop("route_id", "route_no"), b.mapping(s, d), "inner").select("event_id", "vehicle", "route_id")


@query(f"WITH {MAPPING_SQL}, {WAYPOINTS_SQL} SELECT event_id FROM wp WHERE vehicle IN (SELECT vehicle FROM mp)")
def semi_mapped_vehicles(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).join(b.mapping(s, d), "vehicle", "left_semi").select("event_id")


@query(f"WITH {MAPPING_SQL}, {WAYPOINTS_SQL} SELECT event_id FROM wp WHERE vehicle NOT IN (SELECT vehicle FROM mp)")
def anti_unmapped(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).join(b.mapping(s, d), "vehicle", "left_anti").select("event_id")


@query(f"WITH {WAYPOINTS_SQL}, di AS (SELECT s_nationkey AS route_id, s_suppkey % 7 AS k, COUNT(*) AS suppliers FROM supplier GROUP BY 1, 2) SELECT w.event_id, di.suppliers FROM wp w LEFT JOIN di ON w.route_id = di.route_id AND w.event_id % 7 = di.k")
def composite_dim_join(s: SparkSession, d: str) -> DataFrame:
    dim = b.table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("route_id"), (F.col("s_suppkey") % 7).alias("k")).agg(F.count("*").alias("suppliers"))
    return wp(s, d).withColumn("k", F.col("event_id") % 7).join(dim, ["route_id", "k"], "left").select("event_id", "suppliers")


@query("""SELECT r_name, n_name, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2""")
def star_join_chain(s: SparkSession, d: str) -> DataFrame:
    t = lambda n: b.table(s, d, n)
    per = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"))
    named = per.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.groupBy("r_name", "n_name").agg(F.sum("orders").alias("orders"), F.round(F.sum("total"), 2).alias("total"))


@query("""SELECT a.s_nationkey AS route_id, a.s_suppkey AS l, b.s_suppkey AS r FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey""")
def route_pair_triangular(s: SparkSession, d: str) -> DataFrame:
    t = b.table(s, d, "supplier").select(F.col("s_nationkey").alias("route_id"), F.col("s_suppkey").alias("id"))
    return joins.triangular(t, "route_id", "id")


@query(f"""WITH {ROUTES_SQL}, {WAYPOINTS_SQL}, c AS (SELECT DISTINCT vehicle, route_id, round(x, 3) AS cx, round(y, 3) AS cy FROM wp),
 m AS (SELECT c.vehicle, c.route_id, r.route_id AS candidate, MIN({haversine_sql('cy', 'cx', 'r.a_lat', 'r.a_lng')}) AS a_km, MIN({haversine_sql('cy', 'cx', 'r.b_lat', 'r.b_lng')}) AS b_km FROM c, rt r GROUP BY 1, 2, 3)
 SELECT vehicle, route_id, candidate, round(a_km, 6) AS a_km, round(b_km, 6) AS b_km FROM m WHERE a_km <= 0.6 AND b_km <= 0.6""")
def crossjoin_terminal_min(s: SparkSession, d: str) -> DataFrame:
    found = routes.route_candidates(wp(s, d), b.routes(s, d))
    return found.select("vehicle", "route_id", "candidate", F.round("a_km", 6).alias("a_km"), F.round("b_km", 6).alias("b_km"))


@query(f"WITH {STOPS_SQL} SELECT DISTINCT CAST(trim(r) AS INTEGER) AS route_id, stop_id FROM (SELECT stop_id, unnest(string_split(routes, ',')) AS r FROM st)")
def bridge_route_stops(s: SparkSession, d: str) -> DataFrame:
    return routes.bridge(b.stops(s, d))


@query(f"""WITH {WAYPOINTS_SQL}, p AS (SELECT event_id, ep, route_id, vehicle FROM wp WHERE event_id % 2 = 0), t AS (SELECT event_id, ep, route_id, speed FROM wp WHERE event_id % 2 = 1)
 SELECT p.event_id, t.event_id AS seen FROM p ASOF LEFT JOIN (SELECT route_id, ep, max(event_id) AS event_id FROM t GROUP BY 1, 2) t ON p.route_id = t.route_id AND p.ep >= t.ep""")
def last_known_before(s: SparkSession, d: str) -> DataFrame:
    w = wp(s, d)
    seen = w.filter("event_id % 2 = 1").groupBy("route_id", "ep").agg(F.max("event_id").alias("seen"))
    return joins.last_known_before(w.filter("event_id % 2 = 0").select("event_id", "route_id", "ep"), seen, ["route_id"], "ep", ["seen"]).select("event_id", "seen")


@query(f"""WITH {WAYPOINTS_SQL}, f AS (SELECT *, lag(speed) OVER (PARTITION BY date, vehicle ORDER BY ep, event_id) AS before FROM wp)
 SELECT date, vehicle, MIN(ep) AS first_ep, MAX(ep) AS last_ep, COUNT(*) AS pings, ROUND(AVG(speed), 6) AS avg_speed, MAX(speed) AS max_speed, CAST(SUM(CASE WHEN speed = 0 AND before > 0 THEN 1 ELSE 0 END) AS BIGINT) AS stops,
 COUNT(DISTINCT hour) AS active_hours, ROUND(CAST(SUM(CAST(speed > 0 AS INT)) AS DOUBLE) / COUNT(*), 6) AS moving_ratio, ROUND(CAST(SUM(CAST(aircon AS INT)) AS DOUBLE) / COUNT(*), 6) AS aircon_on_ratio,
 CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos, arg_max(route_no, struct_pack(a := ep, b := event_id)) AS route_no FROM f GROUP BY 1, 2""")
def vehicle_daily_stats(s: SparkSession, d: str) -> DataFrame:
    f = status.daily_stats(wp(s, d))
    rounded = [F.round(c, 6).alias(c) for c in ("avg_speed", "moving_ratio", "aircon_on_ratio")]
    return f.select("date", "vehicle", "first_ep", "last_ep", "pings", rounded[0], "max_speed", "stops", "active_hours", *rounded[1:], "sos", "route_no")


@query(f"""WITH {WAYPOINTS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY ep DESC, event_id DESC) AS rn FROM wp)
 SELECT CASE WHEN grouping(route_no) = 1 THEN 'ALL' ELSE route_no END AS route, COUNT(*) AS vehicles, CAST(SUM(CAST(ignition AS INT)) AS BIGINT) AS active, COALESCE(ROUND(AVG(CASE WHEN ignition THEN speed END), 6), 0) AS avg_speed,
 CAST(SUM(CAST(ignition AND speed = 0 AS INT)) AS BIGINT) AS idle, CAST(SUM(CAST(ignition AND aircon AS INT)) AS BIGINT) AS aircon, CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos FROM l WHERE rn = 1 GROUP BY ROLLUP (route_no)""")
def fleet_snapshot_rollup(s: SparkSession, d: str) -> DataFrame:
    return status.fleet_snapshot(status.latest_status(wp(s, d)), digits=6)


@query(f"""WITH {WAYPOINTS_SQL} SELECT route_no, hour, CAST(SUM(CAST(speed > 0 AS INT)) AS BIGINT) AS moving, CAST(SUM(CAST(speed = 0 AS INT)) AS BIGINT) AS stopped, CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos,
 CAST(SUM(CAST(ignition AS INT)) AS BIGINT) AS ignition_on FROM wp GROUP BY 1, 2""")
def conditional_counts(s: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.sum(flag(c))
    return wp(s, d).groupBy("route_no", "hour").agg(n(F.col("speed") > 0).alias("moving"), n(F.col("speed") == 0).alias("stopped"), n(F.col("sos")).alias("sos"), n(F.col("ignition")).alias("ignition_on"))


@query(f"WITH {WAYPOINTS_SQL} SELECT route_no, COUNT(DISTINCT vehicle) AS vehicles, TRUE AS close FROM wp GROUP BY 1")
def approx_active_vehicles(s: SparkSession, d: str) -> DataFrame:
    """Whether the sketch's count, of 1 % standard deviation, lies within 5 % of the exact one. Vehicles are made different first: beside an exact count Spark would keep a sketch for each vehicle."""
    seen = wp(s, d).select("route_no", "vehicle").distinct().groupBy("route_no").agg(F.approx_count_distinct("vehicle", 0.01).alias("about"), F.count("vehicle").alias("vehicles"))
    return seen.select("route_no", "vehicles", (F.abs(F.col("about") - F.col("vehicles")) <= F.greatest(F.lit(1.0), 0.05 * F.col("vehicles"))).alias("close"))


@query(f"WITH {WAYPOINTS_SQL} SELECT route_no, ROUND(AVG(speed), 4) AS avg_speed, MAX(speed) AS max_speed, ROUND(stddev_samp(speed), 4) AS std_speed, COUNT(DISTINCT vehicle) AS vehicles FROM wp GROUP BY 1")
def speed_stats_by_route(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).groupBy("route_no").agg(F.round(F.avg("speed"), 4).alias("avg_speed"), F.max("speed").alias("max_speed"), F.round(F.stddev_samp("speed"), 4).alias("std_speed"), F.count_distinct("vehicle").alias("vehicles"))


@query(f"WITH {WAYPOINTS_SQL}, v AS (SELECT vehicle, SUM(speed) AS total, COUNT(*) AS n FROM wp GROUP BY 1) SELECT ROUND(AVG(total), 4) AS avg_total, ROUND(AVG(n), 6) AS avg_pings, COUNT(*) AS vehicles FROM v")
def two_level_agg(s: SparkSession, d: str) -> DataFrame:
    per = wp(s, d).groupBy("vehicle").agg(F.sum("speed").alias("total"), F.count("*").alias("n"))
    return per.agg(F.round(F.avg("total"), 4).alias("avg_total"), F.round(F.avg("n"), 6).alias("avg_pings"), F.count("*").alias("vehicles"))


@query("SELECT event_type, ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.95), 6) AS p95, ROUND(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
def latency_percentiles(s: SparkSession, d: str) -> DataFrame:
    return quantiles(b.table(s, d, "events"), ["event_type"], "value", [0.5, 0.95, 0.99]).withColumnRenamed("q", "p").select("event_type", *(F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p50", "p95", "p99"))))


@query(f"WITH {WAYPOINTS_SQL} SELECT hour(\"timestamp\") AS utc_hour, hour AS local_hour, COUNT(*) AS n FROM wp GROUP BY 1, 2")
def hour_histogram(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).groupBy(F.hour("timestamp").cast("long").alias("utc_hour"), F.col("hour").alias("local_hour")).agg(F.count("*").alias("n"))


@query(f"""WITH {WAYPOINTS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY ep DESC, event_id DESC) AS rn FROM wp)
 SELECT vehicle, event_id, route_no, ep, x, y, speed, CAST(speed > 0 AS INT) AS is_moving, CAST(speed = 0 AS INT) AS is_stopped FROM l WHERE rn = 1""")
def latest_status(s: SparkSession, d: str) -> DataFrame:
    return status.latest_status(wp(s, d)).select("vehicle", "event_id", "route_no", "ep", "x", "y", "speed", "is_moving", "is_stopped")


@query("SELECT s_nationkey AS route_id, arg_min(s_name, s_suppkey) AS first_name FROM supplier GROUP BY 1")
def first_variant(s: SparkSession, d: str) -> DataFrame:
    return b.table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("route_id")).agg(F.min_by("s_name", "s_suppkey").alias("first_name"))


@query(f"""WITH {WAYPOINTS_SQL} SELECT event_id, ep - lag(ep) OVER w AS dt, ROUND(speed - lag(speed) OVER w, 6) AS ds FROM wp WINDOW w AS (PARTITION BY vehicle ORDER BY ep, event_id)""")
def lag_deltas(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("vehicle").orderBy("ep", "event_id")
    return wp(s, d).select("event_id", (F.col("ep") - F.lag("ep").over(w)).alias("dt"), F.round(F.col("speed") - F.lag("speed").over(w), 6).alias("ds"))


@query(f"""WITH {WAYPOINTS_SQL}, g AS (SELECT event_id, vehicle, ep, CASE WHEN lag(ep) OVER w IS NULL OR ep - lag(ep) OVER w > 43200 THEN 1 ELSE 0 END AS n FROM wp WINDOW w AS (PARTITION BY vehicle ORDER BY ep, event_id))
 SELECT event_id, CAST(SUM(n) OVER (PARTITION BY vehicle ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM g""")
def running_sum_sessions(s: SparkSession, d: str) -> DataFrame:
    track = Tracks.of(wp(s, d), ["vehicle"], "ep", "event_id").scan(before=lag("ep"))
    return track.add(new=flag(F.col("before").isNull() | (F.col("ep") - F.col("before") > 43200))).scan(session_id=total("new")).rows.select("event_id", "session_id")


@query(f"""WITH {WAYPOINTS_SQL}, s AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN route_no END AS seen FROM wp)
 SELECT event_id, last_value(seen IGNORE NULLS) OVER (PARTITION BY vehicle, date ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM s""")
def ffill_route(s: SparkSession, d: str) -> DataFrame:
    seen = F.when(F.col("event_id") % 4 == 0, F.col("route_no"))
    return Tracks.of(wp(s, d), ["vehicle", "date"], "ep", "event_id").add(seen=seen).scan(filled=last("seen")).rows.select("event_id", "filled")


@query(f"""WITH {WAYPOINTS_SQL}, r AS (SELECT route_no, event_id, speed, CAST(row_number() OVER (PARTITION BY route_no ORDER BY speed DESC, event_id) AS BIGINT) AS rank FROM wp) SELECT * FROM r WHERE rank <= 8""")
def topk_per_group(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("route_no").orderBy(F.desc("speed"), "event_id")
    return wp(s, d).select("route_no", "event_id", "speed", F.row_number().over(w).cast("long").alias("rank")).filter("rank <= 8")


@query(f"""WITH {ROUTES_SQL}, {WAYPOINTS_SQL}, c AS (SELECT DISTINCT vehicle, route_id, round(x, 3) AS cx, round(y, 3) AS cy FROM wp),
 m AS (SELECT c.vehicle, c.route_id, r.route_id AS candidate, MIN({haversine_sql('cy', 'cx', 'r.a_lat', 'r.a_lng')}) AS a_km, MIN({haversine_sql('cy', 'cx', 'r.b_lat', 'r.b_lng')}) AS b_km, MIN({haversine_sql('r.a_lat', 'r.a_lng', 'r.b_lat', 'r.b_lng')}) AS route_km FROM c, rt r GROUP BY 1, 2, 3),
 k AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY CASE WHEN route_id = candidate THEN 1 ELSE 0 END DESC, route_km DESC, candidate) AS rn FROM m WHERE a_km <= 0.6 AND b_km <= 0.6)
 SELECT vehicle, candidate AS corrected FROM k WHERE rn = 1""")
def priority_rank(s: SparkSession, d: str) -> DataFrame:
    return routes.corrected_routes(routes.route_candidates(wp(s, d), b.routes(s, d)))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM k WHERE rn = 1""")
def dedup_latest(s: SparkSession, d: str) -> DataFrame:
    return cleaning.one_per_key(b.table(s, d, "lineitem"), ["l_orderkey"], F.desc("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""WITH {WAYPOINTS_SQL}, e AS (SELECT w.*, unnest(range(5)) AS i FROM wp w)
 SELECT epoch_ms(CAST((CAST(floor(ep / 60) AS BIGINT) - i) * 60000 AS BIGINT)) AS window_start, route_no, ROUND(AVG(speed), 6) AS avg_speed, COUNT(*) AS messages, COUNT(DISTINCT vehicle) AS vehicles,
 CAST(SUM(CAST(speed > 0 AS INT)) AS BIGINT) AS moving, CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos FROM e GROUP BY 1, 2""")
def sliding_window_kpis(s: SparkSession, d: str) -> DataFrame:
    return status.window_kpis(wp(s, d), exact=True).select("window_start", "route_no", F.round("avg_speed", 6).alias("avg_speed"), "messages", "vehicles", "moving", "sos")


@query(f"""WITH {DENSE_SQL}, r AS (SELECT *, CAST(speed <= 2 AS INT) AS rest FROM dw), c AS (SELECT *, CASE WHEN lag(rest) OVER w IS DISTINCT FROM rest THEN 1 ELSE 0 END AS ch FROM r WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id)),
 n AS (SELECT *, SUM(ch) OVER (PARTITION BY vehicle ORDER BY ept, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
 g AS (SELECT vehicle, run, COUNT(*) AS n, var_samp(x) AS vx, var_samp(y) AS vy FROM n WHERE rest = 1 GROUP BY 1, 2 HAVING COUNT(*) >= 5)
 SELECT vehicle, ROUND(AVG(greatest(vx, 1e-12)), 9) AS var_x, ROUND(AVG(greatest(vy, 1e-12)), 9) AS var_y, COUNT(*) AS runs FROM g GROUP BY 1""")
def kalman_calibration(s: SparkSession, d: str) -> DataFrame:
    from tidefleet.operators.kalman import calibrate

    return calibrate(b.dense_waypoints(s, d), "ept").select("vehicle", F.round("var_x", 9).alias("var_x"), F.round("var_y", 9).alias("var_y"), "runs")


@query(f"""WITH {ROUTES_SQL} SELECT route_id, round({haversine_sql('a_lat', 'a_lng', 'b_lat', 'b_lng')}, 6) AS km FROM rt""")
def route_lengths(s: SparkSession, d: str) -> DataFrame:
    r = routes.terminals(b.routes(s, d).select("route_id", F.lit(1).alias("route_var_id"), "path"))
    return r.select("route_id", F.round(haversine_km(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")), 6).alias("km"))


@query(f"WITH {WAYPOINTS_SQL} SELECT vehicle, ROUND(CASE WHEN COUNT(*) > 0 THEN CAST(SUM(CAST(aircon AS INT)) AS DOUBLE) / COUNT(*) ELSE 0 END, 6) AS aircon_share FROM wp GROUP BY 1")
def guarded_ratio(s: SparkSession, d: str) -> DataFrame:
    return wp(s, d).groupBy("vehicle").agg(F.round(ratio(F.sum(flag(F.col("aircon"))), F.count("*")), 6).alias("aircon_share"))
