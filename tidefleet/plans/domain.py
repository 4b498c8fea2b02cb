"""Stops, terminals, trips, features, smoothing and array work over pings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefleet.operators import cleaning, kalman, routes, sequences, stops, trips
from tidefleet.plans import bindings as b
from tidefleet.plans.bindings import DENSE_SQL, GAP_SECONDS, MAPPING_SQL, ROUTES_SQL, STOPS_SQL, WAYPOINTS_SQL, haversine_sql
from tidefleet.sources import readers

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


SESSIONS_SQL = WAYPOINTS_SQL + f""",
s1 AS (SELECT *, COALESCE(speed = 0, TRUE) AS still FROM wp),
s2 AS (SELECT *, CASE WHEN still AND (lag(ep) OVER w IS NULL OR NOT lag(still) OVER w OR ep - lag(ep) OVER w > {GAP_SECONDS}) THEN 1 ELSE 0 END AS st FROM s1 WINDOW w AS (PARTITION BY route_id, vehicle ORDER BY ep, event_id)),
s3 AS (SELECT *, CAST(SUM(st) OVER (PARTITION BY route_id, vehicle ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM s2),
ss AS (SELECT route_id, vehicle, session_id, AVG(x) AS stop_lng, AVG(y) AS stop_lat, COUNT(*) AS pings, MIN(ep) AS start_ep, MAX(ep) AS end_ep, MAX(ep) - MIN(ep) AS seconds FROM s3 WHERE still GROUP BY 1, 2, 3 HAVING MAX(ep) - MIN(ep) >= 600)"""
CANDIDATES_SQL = SESSIONS_SQL + f""",
c1 AS (SELECT route_id, CAST(row_number() OVER (PARTITION BY route_id ORDER BY vehicle, session_id) AS BIGINT) AS id, stop_lng AS lng, stop_lat AS lat FROM ss),
c2 AS (SELECT a.route_id, a.id AS anchor, COUNT(*) AS density, AVG(b.lng) AS lng, AVG(b.lat) AS lat FROM c1 a JOIN c1 b ON a.route_id = b.route_id AND {haversine_sql('a.lat', 'a.lng', 'b.lat', 'b.lng')} <= 0.25 GROUP BY 1, 2),
ca AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY route_id ORDER BY density DESC, anchor) AS BIGINT) AS rank FROM c2) WHERE rank <= 8)"""
SEGMENTS_SQL = f"""{ROUTES_SQL}, {WAYPOINTS_SQL},
t0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle, ep ORDER BY event_id) AS rn FROM wp) WHERE rn = 1),
t1 AS (SELECT t0.*, r.a_lng, r.a_lat, r.b_lng, r.b_lat, ({haversine_sql('y', 'x', 'r.a_lat', 'r.a_lng')} <= 0.5 OR {haversine_sql('y', 'x', 'r.b_lat', 'r.b_lng')} <= 0.5) AS at_terminal FROM t0 JOIN rt r ON t0.route_id = r.route_id),
t2 AS (SELECT *, lag(ep) OVER w AS le, lag(x) OVER w AS lx, lag(y) OVER w AS ly, lag(at_terminal) OVER w AS lt FROM t1 WINDOW w AS (PARTITION BY vehicle ORDER BY ep, event_id)),
t3 AS (SELECT *, CASE WHEN le IS NULL OR ep - le > {GAP_SECONDS} OR at_terminal <> lt THEN 1 ELSE 0 END AS nw FROM t2),
tr AS (SELECT *, CASE WHEN nw = 1 THEN 0 ELSE {haversine_sql('ly', 'lx', 'y', 'x')} END AS segment_km, CAST(SUM(nw) OVER (PARTITION BY vehicle ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip_id FROM t3)"""
_FIRST = "struct_pack(a := ep, b := event_id)"
TRIPS_SQL = SEGMENTS_SQL + f""",
u1 AS (SELECT vehicle, trip_id, route_id, route_no, a_lng, a_lat, b_lng, b_lat, SUM(segment_km) AS total_km, COUNT(*) AS pings, ROUND(AVG(CASE WHEN at_terminal THEN CAST(0 AS DOUBLE) ELSE 1 END), 2) AS pct_outside,
  arg_min(x, {_FIRST}) AS sx, arg_min(y, {_FIRST}) AS sy, arg_max(x, {_FIRST}) AS ex, arg_max(y, {_FIRST}) AS ey, MIN(ep) AS start_ep, MAX(ep) AS end_ep, arg_min(date, {_FIRST}) AS date FROM tr GROUP BY ALL),
u2 AS (SELECT *, {haversine_sql('sy', 'sx', 'a_lat', 'a_lng')} + {haversine_sql('ey', 'ex', 'b_lat', 'b_lng')} AS o, {haversine_sql('sy', 'sx', 'b_lat', 'b_lng')} + {haversine_sql('ey', 'ex', 'a_lat', 'a_lng')} AS i FROM u1 WHERE total_km > 1.5 AND pct_outside > 0.5),
tp AS (SELECT vehicle, trip_id, route_id, route_no, date, start_ep, end_ep, ROUND((end_ep - start_ep) / CAST(60 AS DOUBLE), 2) AS minutes, ROUND(total_km, 6) AS total_km, pings, pct_outside,
  CASE WHEN {haversine_sql('a_lat', 'a_lng', 'b_lat', 'b_lng')} < 1 THEN 'CIRCULAR' WHEN o < i THEN 'OUTBOUND' ELSE 'INBOUND' END AS direction,
  CASE WHEN {haversine_sql('a_lat', 'a_lng', 'b_lat', 'b_lng')} < 1 OR least(o, i) < 2 THEN 'HIGH' WHEN least(o, i) < 5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM u2)"""


def sessions(s: SparkSession, d: str) -> DataFrame:
    return stops.stop_sessions(b.waypoints(s, d), gap=GAP_SECONDS)


def segments(s: SparkSession, d: str) -> DataFrame:
    return trips.segment_trips(b.waypoints(s, d), b.routes(s, d).drop("route_no", "path"), gap=GAP_SECONDS)


def trip_rows(s: SparkSession, d: str) -> DataFrame:
    """The trip table that dashboards read."""
    return trips.trip_summary(segments(s, d)).withColumn("total_km", F.round("total_km", 6))


@query(f"WITH {SESSIONS_SQL} SELECT route_id, vehicle, session_id, ROUND(stop_lng, 6) AS stop_lng, ROUND(stop_lat, 6) AS stop_lat, pings, start_ep, end_ep, seconds FROM ss")
def stop_sessions(s: SparkSession, d: str) -> DataFrame:
    return sessions(s, d).withColumn("stop_lng", F.round("stop_lng", 6)).withColumn("stop_lat", F.round("stop_lat", 6))


@query(f"WITH {CANDIDATES_SQL} SELECT route_id, anchor, ROUND(lng, 6) AS lng, ROUND(lat, 6) AS lat, density, rank FROM ca")
def terminal_candidates(s: SparkSession, d: str) -> DataFrame:
    return stops.terminal_candidates(sessions(s, d)).withColumn("lng", F.round("lng", 6)).withColumn("lat", F.round("lat", 6))


@query(f"""WITH {CANDIDATES_SQL}, p AS (SELECT a.route_id, a.anchor AS a_anchor, b.anchor AS b_anchor, {haversine_sql('a.lat', 'a.lng', 'b.lat', 'b.lng')} AS km, a.density + b.density AS dens FROM ca a JOIN ca b ON a.route_id = b.route_id AND a.anchor < b.anchor)
 SELECT route_id, a_anchor, b_anchor, ROUND(km, 6) AS km, 'density-neighborhood' AS method FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY km DESC, dens DESC, a_anchor, b_anchor) AS rn FROM p) WHERE rn = 1""")
def terminal_pair(s: SparkSession, d: str) -> DataFrame:
    pair = stops.terminal_pair(stops.terminal_candidates(sessions(s, d)))
    return pair.select("route_id", "a_anchor", "b_anchor", F.round("km", 6).alias("km"), "method")


@query(f"""WITH {ROUTES_SQL}, {WAYPOINTS_SQL}, c AS (SELECT DISTINCT vehicle, route_id, round(x, 3) AS cx, round(y, 3) AS cy FROM wp),
 m AS (SELECT c.vehicle, c.route_id, r.route_id AS candidate, MIN({haversine_sql('cy', 'cx', 'r.a_lat', 'r.a_lng')}) AS a_km, MIN({haversine_sql('cy', 'cx', 'r.b_lat', 'r.b_lng')}) AS b_km, MIN({haversine_sql('r.a_lat', 'r.a_lng', 'r.b_lat', 'r.b_lng')}) AS route_km FROM c, rt r GROUP BY 1, 2, 3),
 k AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY CASE WHEN route_id = candidate THEN 1 ELSE 0 END DESC, route_km DESC, candidate) AS rn FROM m WHERE a_km <= 0.6 AND b_km <= 0.6)
 SELECT w.event_id, w.vehicle, COALESCE(k.candidate, w.route_id) AS route_id FROM wp w LEFT JOIN k ON w.vehicle = k.vehicle AND k.rn = 1""")
def route_correction(s: SparkSession, d: str) -> DataFrame:
    w = b.waypoints(s, d)
    return routes.correct_routes(w, routes.corrected_routes(routes.route_candidates(w, b.routes(s, d)))).select("event_id", "vehicle", "route_id")


SNAPPED_SQL = f"""{MAPPING_SQL}, {STOPS_SQL}, {WAYPOINTS_SQL},
sn AS (SELECT w.event_id, w.vehicle, w.date, w.ep, CASE WHEN w.event_id % 3 = 0 THEN CAST(w.route_id AS DOUBLE) * CAST(0.004 AS DOUBLE) + CAST(106.60 AS DOUBLE) + CAST(w.event_id % 5 AS DOUBLE) * CAST(0.0125 AS DOUBLE) ELSE w.x + CAST(1 AS DOUBLE) END AS x,
  CASE WHEN w.event_id % 3 = 0 THEN CAST(w.event_id % 5 AS DOUBLE) * CAST(0.0125 AS DOUBLE) + CAST(10.70 AS DOUBLE) ELSE w.y END AS y FROM wp w)"""


def _snapped(s: SparkSession, d: str) -> DataFrame:
    """Pings of which a third lie on a stop of their route and the others on none."""
    i, k = (F.col("event_id") % 5).cast("double"), F.col("route_id").cast("double")
    on = F.col("event_id") % 3 == 0
    w = b.waypoints(s, d)
    return w.withColumn("x", F.when(on, k * 0.004 + 106.60 + i * 0.0125).otherwise(F.col("x") + 1.0)).withColumn("y", F.when(on, i * 0.0125 + 10.70).otherwise(F.col("y")))


@query(f"""WITH {SNAPPED_SQL}, br AS (SELECT DISTINCT CAST(trim(r) AS INTEGER) AS seen, stop_lng, stop_lat FROM (SELECT stop_lng, stop_lat, unnest(string_split(routes, ',')) AS r FROM st)),
 j AS (SELECT sn.*, br.seen, CASE WHEN br.seen IS NULL THEN 999 ELSE abs(sn.x - stop_lng) + abs(sn.y - stop_lat) END AS off, stop_lng, stop_lat FROM sn JOIN mp ON sn.vehicle = mp.vehicle LEFT JOIN br ON round(sn.x, 4) = round(stop_lng, 4) AND round(sn.y, 4) = round(stop_lat, 4)),
 n AS (SELECT *, row_number() OVER (PARTITION BY vehicle, event_id ORDER BY off, seen NULLS FIRST) AS rn FROM j WHERE seen IS NULL OR (abs(x - stop_lng) < 1e-4 AND abs(y - stop_lat) < 1e-4)),
 f AS (SELECT event_id, vehicle, last_value(seen IGNORE NULLS) OVER (PARTITION BY vehicle, date ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS detected FROM n WHERE rn = 1)
 SELECT f.event_id, f.vehicle, f.detected FROM f JOIN mp ON f.vehicle = mp.vehicle AND f.detected = mp.route_id""")
def route_detection_ffill(s: SparkSession, d: str) -> DataFrame:
    return routes.detect_routes(_snapped(s, d), b.mapping(s, d), b.stops(s, d)).select("event_id", "vehicle", "detected")


@query(f"WITH {SEGMENTS_SQL} SELECT event_id, vehicle, trip_id, at_terminal, ROUND(segment_km, 6) AS segment_km FROM tr")
def trip_segments(s: SparkSession, d: str) -> DataFrame:
    return segments(s, d).select("event_id", "vehicle", "trip_id", "at_terminal", F.round("segment_km", 6).alias("segment_km"))


@query(f"WITH {TRIPS_SQL} SELECT * FROM tp")
def trip_summary(s: SparkSession, d: str) -> DataFrame:
    return trip_rows(s, d)


def _variants(s: SparkSession, d: str) -> DataFrame:
    """Paths of both directions; every fifth route has no way back."""
    r = b.routes(s, d)
    out = r.select("route_id", F.lit(1).alias("route_var_id"), F.lit(True).alias("outbound"), "path")
    back = r.filter("route_id % 5 <> 0").select("route_id", F.lit(2).alias("route_var_id"), F.lit(False).alias("outbound"), F.reverse("path").alias("path"))
    return out.unionAll(back)


BOTH_SQL = """bt AS (SELECT route_id, a_lng AS out_start_lng, a_lat AS out_start_lat, b_lng AS out_end_lng, b_lat AS out_end_lat, CASE WHEN route_id % 5 <> 0 THEN b_lng END AS in_start_lng, CASE WHEN route_id % 5 <> 0 THEN b_lat END AS in_start_lat,
 CASE WHEN route_id % 5 <> 0 THEN a_lng END AS in_end_lng, CASE WHEN route_id % 5 <> 0 THEN a_lat END AS in_end_lat FROM rt)"""


@query(f"WITH {ROUTES_SQL}, {BOTH_SQL} SELECT * FROM bt")
def both_terminals(s: SparkSession, d: str) -> DataFrame:
    return routes.both_terminals(_variants(s, d))


@query(f"""WITH {ROUTES_SQL}, {BOTH_SQL}, {WAYPOINTS_SQL}, g1 AS (SELECT *, lag(ep) OVER w AS le, lag(x) OVER w AS lx, lag(y) OVER w AS ly FROM wp WINDOW w AS (PARTITION BY vehicle, route_id ORDER BY ep, event_id)),
 g2 AS (SELECT *, CASE WHEN le IS NULL OR ep - le > {GAP_SECONDS // 4} THEN 1 ELSE 0 END AS nw FROM g1),
 g3 AS (SELECT *, CASE WHEN lx IS NULL THEN 0 ELSE {haversine_sql('ly', 'lx', 'y', 'x')} END AS km, CAST(SUM(nw) OVER (PARTITION BY vehicle, route_id ORDER BY ep, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip_id FROM g2),
 g4 AS (SELECT vehicle, route_id, trip_id, SUM(km) AS total_km, COUNT(*) AS pings, MIN(ep) AS start_ep, MAX(ep) AS end_ep, arg_min(x, {_FIRST}) AS sx, arg_min(y, {_FIRST}) AS sy, arg_max(x, {_FIRST}) AS ex, arg_max(y, {_FIRST}) AS ey FROM g3 GROUP BY 1, 2, 3 HAVING SUM(km) > 1),
 g5 AS (SELECT g4.*, {haversine_sql('sy', 'sx', 'out_start_lat', 'out_start_lng')} + {haversine_sql('ey', 'ex', 'out_end_lat', 'out_end_lng')} AS o, in_start_lng IS NULL AS one,
  {haversine_sql('sy', 'sx', 'in_start_lat', 'in_start_lng')} + {haversine_sql('ey', 'ex', 'in_end_lat', 'in_end_lng')} AS i FROM g4 LEFT JOIN bt ON g4.route_id = bt.route_id),
 g6 AS (SELECT *, CASE WHEN one THEN o ELSE least(o, i) END AS off FROM g5)
 SELECT vehicle, route_id, trip_id, start_ep, end_ep, ROUND(total_km, 6) AS total_km, pings, CASE WHEN NOT one AND o < i THEN 'OUTBOUND' ELSE 'INBOUND' END AS direction, CASE WHEN off < 5 THEN 'HIGH' WHEN off < 15 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM g6""")
def gap_trips(s: SparkSession, d: str) -> DataFrame:
    return trips.gap_trips(b.waypoints(s, d), routes.both_terminals(_variants(s, d)), gap=GAP_SECONDS // 4).withColumn("total_km", F.round("total_km", 6))


#: Vehicles with an even id are mapped to the route after their own.
OVERRIDE_SQL = DENSE_SQL + """,
mo AS (SELECT CAST(c_custkey AS VARCHAR) AS vehicle, (c_nationkey + 1) % 25 AS mapped FROM customer WHERE c_custkey % 2 = 0),
od AS (SELECT dw.* EXCLUDE (route_id), COALESCE(mapped, route_id) AS route_id FROM dw LEFT JOIN mo ON dw.vehicle = mo.vehicle)"""
FEATURES_SQL = OVERRIDE_SQL + """,
f1 AS (SELECT *, ept - lag(ept) OVER w AS delta_time, x - lag(x) OVER w AS delta_x, y - lag(y) OVER w AS delta_y, speed - lag(speed) OVER w AS delta_speed, heading - lag(heading) OVER w AS delta_heading,
  sin(2 * pi() * (ept % 86400) / 86400) AS time_sin, cos(2 * pi() * (ept % 86400) / 86400) AS time_cos FROM od WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id)),
ft AS (SELECT *, delta_speed / delta_time AS acceleration FROM f1 WHERE delta_time > 0 AND delta_time <= 300)"""
_R6 = ("delta_x", "delta_y", "delta_heading", "acceleration", "time_sin", "time_cos")


def _overridden(s: SparkSession, d: str) -> DataFrame:
    mapped = b.table(s, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("vehicle"), ((F.col("c_nationkey") + 1) % 25).alias("route_id"))
    return cleaning.override_routes(b.dense_waypoints(s, d), mapped)


@query(f"WITH {OVERRIDE_SQL} SELECT event_id, vehicle, route_id FROM od")
def mapping_override(s: SparkSession, d: str) -> DataFrame:
    return _overridden(s, d).select("event_id", "vehicle", "route_id")


@query(f"WITH {FEATURES_SQL} SELECT event_id, vehicle, route_id, speed, delta_time, {', '.join(f'ROUND({c}, 6) AS {c}' for c in _R6)} FROM ft")
def kinematic_features(s: SparkSession, d: str) -> DataFrame:
    return sequences.delta_features(_overridden(s, d), "ept").select("event_id", "vehicle", "route_id", "speed", "delta_time", *(F.round(c, 6).alias(c) for c in _R6))


_STEPS = (*sequences.STEP_FEATURES, "delta_time")
_SEQ = [f"{c}_{i}" for i in range(10) for c in _STEPS]


@query(f"""WITH {FEATURES_SQL}, n AS (SELECT vehicle, route_id, {', '.join(f'ROUND(CAST({c} AS DOUBLE), 6) AS {c}' for c in _STEPS)}, CAST(row_number() OVER w AS BIGINT) AS first, first_value(route_id) OVER w AS start FROM ft WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id))
 SELECT a.vehicle, a.first, a.start AS route_id, CAST(10 AS BIGINT) AS waypoint_count, {', '.join(f'n{i}.{c} AS {c}_{i}' for i in range(10) for c in _STEPS)}
 FROM n a {' '.join(f'JOIN n n{i} ON n{i}.vehicle = a.vehicle AND n{i}.first = a.first + {i}' for i in range(10))} JOIN n z ON z.vehicle = a.vehicle AND z.first = a.first + 10""")
def sequence_windows(s: SparkSession, d: str) -> DataFrame:
    w = sequences.sequence_windows(sequences.delta_features(_overridden(s, d), "ept"), "ept")
    return w.select("vehicle", "first", "route_id", "waypoint_count", *(F.round(c, 6).alias(c) for c in _SEQ))


@query(f"WITH {WAYPOINTS_SQL} SELECT CAST(route_id AS VARCHAR) AS route_key, CAST(row_number() OVER (ORDER BY route_id) - 1 AS BIGINT) AS index FROM (SELECT DISTINCT route_id FROM wp)")
def route_vocab(s: SparkSession, d: str) -> DataFrame:
    return routes.vocabulary(b.waypoints(s, d))


#: The filter step by step as a recursive query; x and y share one covariance.
KALMAN_SQL = f"""WITH RECURSIVE {DENSE_SQL},
kf AS (SELECT vehicle, seq, event_id, ept, x, y, CAST(0 AS DOUBLE) AS vx, CAST(0 AS DOUBLE) AS vy, CAST(0.1 AS DOUBLE) AS p, CAST(0 AS DOUBLE) AS c, CAST(1 AS DOUBLE) AS q FROM dw WHERE seq = 1
 UNION ALL
 SELECT vehicle, seq, event_id, ept, px + g * (mx - px), py + g * (my - py), pvx + h * (mx - px), pvy + h * (my - py), (1 - g) * pp, (1 - g) * pc, pq - h * pc FROM (
  SELECT *, pp / (pp + CAST(1e-6 AS DOUBLE)) AS g, pc / (pp + CAST(1e-6 AS DOUBLE)) AS h FROM (
   SELECT vehicle, seq, event_id, ept, mx, my, CASE WHEN rest THEN sx ELSE sx + dt * svx END AS px, CASE WHEN rest THEN sy ELSE sy + dt * svy END AS py, CASE WHEN rest THEN 0 ELSE svx END AS pvx, CASE WHEN rest THEN 0 ELSE svy END AS pvy,
    CASE WHEN rest THEN sp + CAST(1e-12 AS DOUBLE) ELSE sp + 2 * dt * sc + dt * dt * sq + CAST(1e-11 AS DOUBLE) * pow(dt, 4) / 4 END AS pp,
    CASE WHEN rest THEN 0 ELSE sc + dt * sq + CAST(1e-11 AS DOUBLE) * pow(dt, 3) / 2 END AS pc, CASE WHEN rest THEN 0 ELSE sq + CAST(1e-11 AS DOUBLE) * dt * dt END AS pq FROM (
    SELECT vehicle, seq, event_id, ept, mx, my, rest, CASE WHEN r THEN 1 ELSE step END AS dt, CASE WHEN r THEN mx ELSE kx END AS sx, CASE WHEN r THEN my ELSE ky END AS sy,
     CASE WHEN r THEN 0 ELSE vx END AS svx, CASE WHEN r THEN 0 ELSE vy END AS svy, CASE WHEN r THEN CAST(0.1 AS DOUBLE) ELSE p END AS sp, CASE WHEN r THEN 0 ELSE c END AS sc, CASE WHEN r THEN 1 ELSE q END AS sq FROM (
     SELECT d.vehicle, d.seq, d.event_id, d.ept, d.x AS mx, d.y AS my, d.speed <= 2 AS rest, d.ept - k.ept AS step, d.ept - k.ept > 15 OR d.ept - k.ept <= 0 AS r, k.x AS kx, k.y AS ky, k.vx, k.vy, k.p, k.c, k.q
      FROM kf k JOIN dw d ON d.vehicle = k.vehicle AND d.seq = k.seq + 1)))))"""


@query(f"{KALMAN_SQL} SELECT event_id, vehicle, ROUND(x, 6) AS x, ROUND(y, 6) AS y FROM kf")
def kalman_smooth(s: SparkSession, d: str) -> DataFrame:
    return kalman.smooth(b.dense_waypoints(s, d).drop("props"), "ept").select("event_id", "vehicle", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_EVAL = ("mean_shift_m", "std_shift_m", "raw_km", "filtered_km", "raw_acceleration", "filtered_acceleration", "path_reduction")


@query(f"""{KALMAN_SQL}, e1 AS (SELECT d.vehicle, d.event_id, d.ept, d.x, d.y, k.x AS fx, k.y AS fy FROM dw d JOIN kf k ON d.event_id = k.event_id),
e2 AS (SELECT *, ept - lag(ept) OVER w AS dt, lag(x) OVER w AS lx, lag(y) OVER w AS ly, lag(fx) OVER w AS lfx, lag(fy) OVER w AS lfy FROM e1 WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id)),
e3 AS (SELECT *, 1000 * {haversine_sql('y', 'x', 'fy', 'fx')} AS shift, 1000 * {haversine_sql('ly', 'lx', 'y', 'x')} AS raw_m, 1000 * {haversine_sql('lfy', 'lfx', 'fy', 'fx')} AS fil_m FROM e2 WHERE dt >= 5),
e4 AS (SELECT *, (raw_m / dt - lag(raw_m / dt) OVER w) / dt AS raw_a, (fil_m / dt - lag(fil_m / dt) OVER w) / dt AS fil_a FROM e3 WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id)),
e5 AS (SELECT AVG(raw_m) / 1000 AS raw_km, AVG(fil_m) / 1000 AS filtered_km FROM (SELECT SUM(raw_m) AS raw_m, SUM(fil_m) AS fil_m FROM e4 GROUP BY vehicle))
SELECT COUNT(*) AS steps, ROUND(AVG(shift), 5) AS mean_shift_m, ROUND(stddev_samp(shift), 5) AS std_shift_m, ROUND(any_value(raw_km), 5) AS raw_km, ROUND(any_value(filtered_km), 5) AS filtered_km, ROUND(stddev_samp(raw_a), 5) AS raw_acceleration,
 ROUND(stddev_samp(fil_a), 5) AS filtered_acceleration, ROUND(any_value((1 - filtered_km / raw_km) * 100), 5) AS path_reduction FROM e4, e5""")
def kalman_eval(s: SparkSession, d: str) -> DataFrame:
    raw = b.dense_waypoints(s, d).drop("props")
    return kalman.evaluate(raw, kalman.smooth(raw, "ept"), "ept").select("steps", *(F.round(c, 5).alias(c) for c in _EVAL))


_GRID = ("mean_shift_m", "std_shift_m", "path_reduction", "acceleration_std")
GRID_SQL = f"""WITH RECURSIVE {DENSE_SQL}, dg AS (SELECT * FROM dw WHERE vehicle IN (SELECT vehicle FROM dw GROUP BY 1 HAVING COUNT(*) >= 5)),
pr AS (SELECT r, a FROM (SELECT unnest([{', '.join(f'CAST({r} AS DOUBLE)' for r in kalman.MEASUREMENTS)}]) AS r), (SELECT unnest([{', '.join(f'CAST({a} AS DOUBLE)' for a in kalman.ACCELERATIONS)}]) AS a)),
kg AS (SELECT vehicle, seq, ept, r, a, x AS rx, y AS ry, speed AS raw, x, y, CAST(0 AS DOUBLE) AS vx, CAST(0 AS DOUBLE) AS vy, CAST(0.1 AS DOUBLE) AS p, CAST(0 AS DOUBLE) AS c, CAST(1 AS DOUBLE) AS q FROM dg, pr WHERE seq = 1
 UNION ALL
 SELECT vehicle, seq, ept, r, a, mx, my, raw, px + g * (mx - px), py + g * (my - py), svx + h * (mx - px), svy + h * (my - py), (1 - g) * pp, (1 - g) * pc, pq - h * pc FROM (
  SELECT *, pp / (pp + r) AS g, pc / (pp + r) AS h FROM (
   SELECT *, sx + dt * svx AS px, sy + dt * svy AS py, sp + 2 * dt * sc + dt * dt * sq + a * pow(dt, 4) / 4 AS pp, sc + dt * sq + a * pow(dt, 3) / 2 AS pc, sq + a * dt * dt AS pq FROM (
    SELECT vehicle, seq, ept, r, a, mx, my, raw, CASE WHEN anew THEN 1 ELSE step END AS dt, CASE WHEN anew THEN mx ELSE kx END AS sx, CASE WHEN anew THEN my ELSE ky END AS sy, CASE WHEN anew THEN 0 ELSE vx END AS svx, CASE WHEN anew THEN 0 ELSE vy END AS svy,
     CASE WHEN anew THEN CAST(0.1 AS DOUBLE) ELSE p END AS sp, CASE WHEN anew THEN 0 ELSE c END AS sc, CASE WHEN anew THEN 1 ELSE q END AS sq FROM (
     SELECT d.vehicle, d.seq, d.ept, k.r, k.a, d.x AS mx, d.y AS my, d.speed AS raw, d.ept - k.ept AS step, d.ept - k.ept > 15 OR d.ept - k.ept <= 0 AS anew, k.x AS kx, k.y AS ky, k.vx, k.vy, k.p, k.c, k.q FROM kg k JOIN dg d ON d.vehicle = k.vehicle AND d.seq = k.seq + 1))))),
kh AS (SELECT *, CAST(3.6 AS DOUBLE) * CAST(111320 AS DOUBLE) * sqrt(vy * vy + pow(vx * cos(radians(y)), 2)) AS kmh FROM kg),
ki AS (SELECT *, CASE WHEN seq = 1 OR kmh > 120 THEN raw WHEN kmh < CAST(0.1 AS DOUBLE) AND raw < 1 THEN 0 ELSE kmh END AS fs FROM kh),
kj AS (SELECT *, lag(rx) OVER w AS lrx, lag(ry) OVER w AS lry, lag(x) OVER w AS lx, lag(y) OVER w AS ly, lag(fs) OVER w AS lfs, ept - lag(ept) OVER w AS dt FROM ki WINDOW w AS (PARTITION BY r, a, vehicle ORDER BY seq)),
kk AS (SELECT r, a, 1000 * {haversine_sql('ry', 'rx', 'y', 'x')} AS shift, CASE WHEN dt IS NOT NULL THEN 1000 * {haversine_sql('lry', 'lrx', 'ry', 'rx')} END AS rm, CASE WHEN dt IS NOT NULL THEN 1000 * {haversine_sql('ly', 'lx', 'y', 'x')} END AS fm, CASE WHEN dt > 0 THEN (fs - lfs) / CAST(3.6 AS DOUBLE) / dt END AS acc FROM kj)"""


@query(f"""{GRID_SQL} SELECT r AS measurement, a AS acceleration, ROUND(AVG(shift), 5) AS mean_shift_m, ROUND(stddev_samp(shift), 5) AS std_shift_m, ROUND(100 * (AVG(rm) - AVG(fm)) / AVG(rm), 5) AS path_reduction, ROUND(stddev_samp(acc), 5) AS acceleration_std FROM kk GROUP BY 1, 2""")
def kalman_grid_search(s: SparkSession, d: str) -> DataFrame:
    found = kalman.grid_search(b.dense_waypoints(s, d).drop("props"), time="ept")
    return found.select("measurement", "acceleration", *(F.round(c, 5).alias(c) for c in _GRID))


@query("""SELECT n_nationkey AS route_id, i AS place, lng, lat FROM (SELECT n_nationkey, unnest([0, 1, 2]) AS i, CAST(n_nationkey AS DOUBLE) * CAST(0.004 AS DOUBLE) AS k FROM nation WHERE n_nationkey % 5 <> 0), LATERAL
 (SELECT k + CAST(106.60 AS DOUBLE) + CAST(0.025 AS DOUBLE) * i AS lng, CAST(10.70 AS DOUBLE) + CAST(0.025 AS DOUBLE) * i AS lat)""")
def path_zip_transform(s: SparkSession, d: str) -> DataFrame:
    k, i = F.col("n_nationkey").cast("double") * 0.004, F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))
    empty = F.col("n_nationkey") % 5 == 0
    none = F.array().cast("array<double>")
    raw = b.table(s, d, "nation").select(
        F.col("n_nationkey").alias("RouteId"), F.lit(1).alias("RouteVarId"), F.lit(True).alias("Outbound"),
        F.when(empty, none).otherwise(F.transform(i, lambda v: F.lit(10.70) + F.lit(0.025) * v)).alias("lat"), F.when(empty, none).otherwise(F.transform(i, lambda v: k + 106.60 + F.lit(0.025) * v)).alias("lng"),
    )
    each = readers.route_paths(raw).select("route_id", F.posexplode("path").alias("place", "p"))
    return each.select("route_id", "place", F.get("p", F.lit(0)).alias("lng"), F.get("p", F.lit(1)).alias("lat"))


@query(f"WITH {ROUTES_SQL} SELECT route_id, a_lng, a_lat, b_lng, b_lat FROM rt")
def path_endpoints(s: SparkSession, d: str) -> DataFrame:
    return routes.terminals(b.routes(s, d).select("route_id", F.lit(1).alias("route_var_id"), "path"))


@query(f"""WITH {ROUTES_SQL}, p AS (SELECT route_id, unnest(CASE WHEN route_id = 1 THEN [[a_lng, a_lat], [106.61, 10.705], [106.62, 10.71], [a_lng + 0.025, 10.725], [b_lng, b_lat]] ELSE [[a_lng, a_lat], [a_lng + 0.025, 10.725], [b_lng, b_lat]] END) AS pt,
 unnest(range(CASE WHEN route_id = 1 THEN 5 ELSE 3 END)) AS place FROM rt) SELECT route_id, CAST(place AS INTEGER) AS place, ROUND(CAST(pt[1] AS DOUBLE), 9) AS lng, ROUND(CAST(pt[2] AS DOUBLE), 9) AS lat FROM p""")
def path_patch_slice_concat(s: SparkSession, d: str) -> DataFrame:
    patched = readers.patch_path(b.routes(s, d), 1, [[106.61, 10.705], [106.62, 10.71]], 1)
    each = patched.select("route_id", F.posexplode("path").alias("place", "pt"))
    return each.select("route_id", "place", F.round(F.col("pt")[0], 9).alias("lng"), F.round(F.col("pt")[1], 9).alias("lat"))


@query("""SELECT n_nationkey AS route_id, v AS route_var_id, CASE WHEN v = 1 THEN 'Outbound' ELSE 'Inbound' END AS direction FROM nation, (SELECT unnest([1, 2]) AS v)""")
def explode_variants(s: SparkSession, d: str) -> DataFrame:
    v = lambda i: F.struct(F.lit(i).alias("RouteVarId"), F.lit("v").alias("RouteVarName"), F.lit(i == 1).alias("Outbound"), F.lit(1.0).alias("Distance"), F.lit(10).alias("RunningTime"), F.lit("A").alias("StartStop"), F.lit("B").alias("EndStop"))
    info = b.table(s, d, "nation").select(F.col("n_nationkey").alias("RouteId"), F.col("n_name").alias("RouteNo"), F.array(v(1), v(2)).alias("Vars"))
    return readers.route_variants(info).select("route_id", "route_var_id", "direction")
