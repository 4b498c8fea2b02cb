"""Streams that serve, late data, the silver chain, table layouts and catalog tables, as bounded queries."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidefleet.operators import cleaning, kalman, status
from tidefleet.plans import bindings as b
from tidefleet.plans.bindings import DENSE_SQL, MAPPING_SQL, WAYPOINTS_SQL
from tidefleet.plans.domain import KALMAN_SQL
from tidefleet.plans.pipelines import _pings, _small_files, ran
from tidefleet.session import work_dir
from tidefleet.sources import catalog, layout, readers, writers
from tidefleet.sources.published import Published
from tidefleet.streaming import pipelines as p

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


#: How long a vehicle counts as seen: pings of the generated tables lie hours apart.
STALE_SECONDS = 86_400


@query(f"""WITH {WAYPOINTS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY ep DESC, event_id DESC) AS rn FROM wp), f AS (SELECT * FROM l WHERE rn = 1 AND ep >= (SELECT max(ep) FROM wp) - {STALE_SECONDS})
 SELECT CASE WHEN grouping(route_no) = 1 THEN 'ALL' ELSE route_no END AS route, COUNT(*) AS vehicles, CAST(SUM(CAST(ignition AS INT)) AS BIGINT) AS active, COALESCE(ROUND(AVG(CASE WHEN ignition THEN speed END), 6), 0) AS avg_speed,
 CAST(SUM(CAST(ignition AND speed = 0 AS INT)) AS BIGINT) AS idle, CAST(SUM(CAST(ignition AND aircon AS INT)) AS BIGINT) AS aircon, CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos, (SELECT COUNT(*) FROM wp) AS logged FROM f GROUP BY ROLLUP (route_no)""")
def fleet_snapshot_stream(s: SparkSession, d: str) -> DataFrame:
    """One stream feeds the log, the latest pings and, after each batch, the fleet's KPIs; vehicles unseen for a day leave."""
    root = work_dir(s)
    path, schema, files = _pings(s, d, 3, root)
    ran(readers.table_stream(s, path, schema, files), p.serving(f"{root}/log", f"{root}/latest", f"{root}/kpis", seconds=STALE_SECONDS, digits=6), f"{root}/state")
    logged = Published(s, f"{root}/log").read().agg(F.count("*").alias("logged"))
    return Published(s, f"{root}/kpis").read().crossJoin(F.broadcast(logged))  # one row


@query(f"""WITH {WAYPOINTS_SQL}, m AS (SELECT max(ep) FILTER (event_id % 10 <> 0) AS last FROM wp), k AS (SELECT *, CAST(floor(ep / 3600) AS BIGINT) * 3600 AS window_ep FROM wp)
 SELECT window_ep, COUNT(*) AS messages FROM k, m WHERE event_id % 10 <> 0 OR window_ep + 3600 > last - 86400 GROUP BY 1""")
def stream_late_rows(s: SparkSession, d: str) -> DataFrame:
    """Every tenth ping comes after all others: those of windows that the watermark of a day has passed are left out."""
    root = work_dir(s)
    w = b.waypoints(s, d).select("event_id", F.timestamp_seconds("ep").alias("timestamp"))
    files = readers.replay(w.filter("event_id % 10 <> 0"), f"{root}/in", 2, "timestamp")
    for late in (False, True):  # a run's end moves the watermark past all it has read; within a run it is a batch behind
        if late:
            w.filter("event_id % 10 = 0").repartition(files).write.mode("append").parquet(f"{root}/in")
        stream = readers.table_stream(s, f"{root}/in", w.schema, files).withWatermark("timestamp", "1 day")
        counts = stream.groupBy(F.window("timestamp", "1 hour").alias("w")).agg(F.count("*").alias("messages"))
        counts = counts.select(F.unix_timestamp("w.start").alias("window_ep"), "messages", F.to_date("w.start").alias("day"))
        ran(counts, p.last_wins(f"{root}/out", ["window_ep"], "day"), f"{root}/state", "update")
    return Published(s, f"{root}/out").read().select("window_ep", "messages")


@query(f"""WITH {WAYPOINTS_SQL} SELECT event_id, vehicle, date, speed FROM wp WHERE speed > 0""")
def stream_file_sink(s: SparkSession, d: str) -> DataFrame:
    """Rows straight into files by date; two runs of one checkpoint write each row once."""
    root = work_dir(s)
    path, schema, files = _pings(s, d, 2, root)
    for _ in range(2):
        q = p.to_files(readers.table_stream(s, path, schema, files).filter("speed > 0").select("event_id", "vehicle", "date", "speed"), f"{root}/out", f"{root}/state", "date")
        q.awaitTermination()
    return s.read.parquet(f"{root}/out")


@query(f"WITH {WAYPOINTS_SQL} SELECT MIN(ep) AS least, MAX(ep) AS greatest, ROUND(AVG(ep), 3) AS mean, COUNT(*) AS rows FROM wp")
def observe_metrics(s: SparkSession, d: str) -> DataFrame:
    """Measured while the rows are written, without a pass of their own."""
    w, seen = b.waypoints(s, d), Observation("latency")
    w.observe(seen, F.min("ep").alias("least"), F.max("ep").alias("greatest"), F.avg("ep").alias("mean"), F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    m = seen.get
    return s.createDataFrame([(m["least"], m["greatest"], round(m["mean"], 3), m["rows"])], "least long, greatest long, mean double, rows long")


#: Envelopes come twice, some without a place, some of vehicles without a route.
_BROKEN = "event_id % 13 = 0"
#: The re-timed pings begin in 2024.
_START = 1_704_067_200
SILVER_SQL = KALMAN_SQL.replace("WITH RECURSIVE ", "", 1)


def _raw(s: SparkSession, d: str) -> DataFrame:
    w = b.dense_waypoints(s, d).drop("props", "route_id", "route_no", "date", "hour").withColumn("ept", F.col("ept") + _START)
    broken = w.withColumn("vehicle", F.when(F.expr(_BROKEN), F.lit(None).cast("string")).otherwise(F.col("vehicle")))
    return broken.withColumn("timestamp", F.timestamp_seconds("ept").cast("timestamp_ntz")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


def _silver_sql(join: str) -> str:
    """The smoother over what is left of the pings: re-numbered, else the recursion would stop at what went."""
    source = DENSE_SQL.replace("dw AS (", "d1 AS (") + f""", {MAPPING_SQL}, d2 AS (SELECT d1.* EXCLUDE (seq, route_id, ept), ept + {_START} AS ept, m.route_id FROM d1 {join} JOIN mp m ON d1.vehicle = m.vehicle WHERE NOT ({_BROKEN})),
 dw AS (SELECT *, CAST(row_number() OVER (PARTITION BY vehicle ORDER BY ept, event_id) AS BIGINT) AS seq FROM d2)"""
    return f"""WITH RECURSIVE {SILVER_SQL.replace(DENSE_SQL, source)} SELECT k.event_id, k.vehicle, d.route_id, ROUND(k.x, 6) AS x, ROUND(k.y, 6) AS y, CAST(make_timestamp(k.ept * 1000000) + INTERVAL 7 HOUR AS DATE) AS date,
 CAST(hour(make_timestamp(k.ept * 1000000) + INTERVAL 7 HOUR) AS BIGINT) AS hour FROM kf k JOIN dw d ON k.event_id = d.event_id"""


_SILVER = ("event_id", "vehicle", "route_id")


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(*_SILVER, F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "date", "hour")


@query(_silver_sql("LEFT"))
def silver_batch(s: SparkSession, d: str) -> DataFrame:
    """The whole chain as one job: routes, validity, one ping per vehicle and time, smoothing, local dates, sorted files by date."""
    root = work_dir(s)
    rows = cleaning.to_silver(_raw(s, d), b.mapping(s, d), F.col("event_id"), smooth_by="ept")
    writers.append(rows, f"{root}/silver", "date")
    return _rounded(s.read.parquet(f"{root}/silver"))


@query(_silver_sql("INNER"))
def silver_backfill(s: SparkSession, d: str) -> DataFrame:
    """Days that are there are replaced, vehicles without a route left out; a second run changes nothing."""
    root = work_dir(s)
    rows = cleaning.to_silver(_raw(s, d), b.mapping(s, d), F.col("event_id"), "inner", smooth_by="ept")
    writers.append(rows.limit(50).withColumn("x", F.lit(0.0)), f"{root}/silver", "date")  # an earlier, wrong load
    for _ in range(2):
        writers.overwrite_partitions(rows, f"{root}/silver", "date")
    return _rounded(s.read.parquet(f"{root}/silver"))


@query(_silver_sql("LEFT"))
def stream_silver_chain(s: SparkSession, d: str) -> DataFrame:
    """The same chain on a stream: watermark, one ping per vehicle and time, routes, validity, smoothing with state, local dates, sorted batches."""
    root = work_dir(s)
    w = _raw(s, d).withColumn("timestamp", F.timestamp_seconds("ept"))
    middle = _START + 460
    files = readers.replay_parts([w.filter(F.col("ept") <= middle), w.filter(F.col("ept") > middle)], f"{root}/in", "ept")
    rows = p.silver(readers.table_stream(s, f"{root}/in", w.schema, files), b.mapping(s, d), "1 day", smooth_by="ept")
    ran(rows, lambda batch, n: writers.overwrite(cleaning.silver_order(batch), f"{root}/out/batch={n}"), f"{root}/state")
    return _rounded(s.read.parquet(f"{root}/out"))


_CALIBRATED = f"""WITH {DENSE_SQL}, r AS (SELECT *, CAST(speed <= 2 AS INT) AS rest FROM dw), c AS (SELECT *, CASE WHEN lag(rest) OVER w IS DISTINCT FROM rest THEN 1 ELSE 0 END AS ch FROM r WINDOW w AS (PARTITION BY vehicle ORDER BY ept, event_id)),
 n AS (SELECT *, SUM(ch) OVER (PARTITION BY vehicle ORDER BY ept, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c), g AS (SELECT vehicle, run, var_samp(x) AS vx, var_samp(y) AS vy FROM n WHERE rest = 1 GROUP BY 1, 2 HAVING COUNT(*) >= 3),
 v AS (SELECT vehicle, AVG(greatest(vx, 1e-12)) AS var_x, AVG(greatest(vy, 1e-12)) AS var_y FROM g GROUP BY 1), k AS (SELECT * FROM v WHERE var_x > 1e-10 OR var_y > 1e-10)"""


@query(f"{_CALIBRATED} SELECT vehicle, ROUND(var_x, 9) AS var_x, ROUND(var_y, 9) AS var_y FROM k UNION ALL SELECT 'global', ROUND(COALESCE(AVG(var_x), 1e-9), 9), ROUND(COALESCE(AVG(var_y), 1e-9), 9) FROM k")
def calibration_table(s: SparkSession, d: str) -> DataFrame:
    """Measurement noise by vehicle, written as a small table with a fallback for all others, and read back."""
    root = work_dir(s)
    writers.overwrite(kalman.calibration_table(kalman.calibrate(b.dense_waypoints(s, d), "ept", 3)), f"{root}/noise")
    return s.read.parquet(f"{root}/noise").select("vehicle", F.round("var_x", 9).alias("var_x"), F.round("var_y", 9).alias("var_y"))


@query("SELECT route_id, route_var_id, stop_id, code, stop_name, routes, lng, lat FROM (SELECT n_nationkey AS route_id, v AS route_var_id, n_nationkey * 10 + i AS stop_id, 'C' || i AS code, n_name AS stop_name, CAST(n_nationkey AS VARCHAR) AS routes, CAST(106 AS DOUBLE) AS lng, CAST(10 AS DOUBLE) AS lat FROM nation, (SELECT unnest([1, 2]) AS v), (SELECT unnest([0, 1]) AS i))")
def stop_dimension(s: SparkSession, d: str) -> DataFrame:
    """Stops come twice, the later ones with another code; the dimension is merged twice."""
    n = b.table(s, d, "nation").withColumn("v", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    text = lambda c: F.lit(None).cast("string").alias(c)
    raw = n.select(
        F.col("n_nationkey").alias("RouteId"), F.col("v").alias("RouteVarId"), (F.col("n_nationkey") * 10 + F.col("i")).alias("StopId"), F.concat(F.lit("C"), F.col("i").cast("string")).alias("Code"), F.col("n_name").alias("Name"), *map(text, ("StopType", "Zone", "Ward", "AddressNo", "Street")),
        F.lit(106.0).alias("Lng"), F.lit(10.0).alias("Lat"), F.col("n_nationkey").cast("string").alias("Routes"), F.lit(True).alias("Outbound"),
    )
    stops = Published(s, f"{work_dir(s)}/stops", "route_id")
    for _ in range(2):
        stops.upsert(readers.stop_dimension(raw.unionAll(raw.withColumn("Code", F.lit("D")))), ["route_id", "route_var_id", "stop_id"])
    return stops.read().select("route_id", "route_var_id", "stop_id", "code", "stop_name", "routes", "lng", "lat")


@query("""SELECT n_nationkey AS route_id, v AS route_var_id, CAST(CASE WHEN n_nationkey = 1 THEN 106.6983 WHEN v = 1 THEN 106.1 ELSE 106.3 END AS DOUBLE) AS end_lng, CAST(CASE WHEN n_nationkey = 1 THEN 10.7716 WHEN v = 1 THEN 10.1 ELSE 10.3 END AS DOUBLE) AS end_lat, 3 AS points FROM nation, (SELECT unnest([1, 2]) AS v)""")
def path_dimension(s: SparkSession, d: str) -> DataFrame:
    """The end of each path that one route's missing terminal replaces: the first point outwards, the last one homewards."""
    n = b.table(s, d, "nation").withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    raw = n.select(F.col("n_nationkey").alias("RouteId"), F.col("n_name").alias("RouteNo"), F.col("v").alias("RouteVarId"), F.lit("v").alias("RouteVarName"), (F.col("v") == 1).alias("Outbound"), F.array(*map(F.lit, (10.1, 10.2, 10.3))).alias("lat"), F.array(*map(F.lit, (106.1, 106.2, 106.3))).alias("lng"))
    paths = Published(s, f"{work_dir(s)}/paths", "route_id")
    for _ in range(2):
        paths.upsert(readers.path_dimension(raw.unionAll(raw)), ["route_id", "route_var_id", "outbound"])
    end = F.when(F.col("outbound"), F.element_at("path", 1)).otherwise(F.element_at("path", -1))
    return paths.read().select("route_id", "route_var_id", end[0].alias("end_lng"), end[1].alias("end_lat"), F.size("path").alias("points"))


@query(f"WITH {WAYPOINTS_SQL} SELECT event_id, vehicle, x, y FROM wp WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12' AND x BETWEEN 106.62 AND 106.68 AND y BETWEEN 10.71 AND 10.74 ORDER BY speed DESC, event_id LIMIT 200")
def stored_bbox_range(s: SparkSession, d: str) -> DataFrame:
    """A box and some days of a stored table: days are folders, coordinates are skipped by the files' minima and maxima."""
    root = work_dir(s)
    rows = b.waypoints(s, d).select("event_id", "vehicle", "x", "y", "speed", "date")
    layout.z_order(rows, "x", "y", 4).write.partitionBy("date").parquet(f"{root}/t")
    box = s.read.parquet(f"{root}/t").filter("date between date'2024-01-08' and date'2024-01-12'").filter(F.col("x").between(106.62, 106.68) & F.col("y").between(10.71, 10.74))
    return box.orderBy(F.desc("speed"), "event_id").limit(200).select("event_id", "vehicle", "x", "y")


@query(f"""WITH {WAYPOINTS_SQL} SELECT CAST("timestamp" AS DATE) AS day, COUNT(*) AS n FROM wp WHERE "timestamp" >= TIMESTAMP '2024-01-05 06:00:00' AND "timestamp" < TIMESTAMP '2024-01-09 18:00:00' GROUP BY 1""")
def hidden_day_partition(s: SparkSession, d: str) -> DataFrame:
    """Days are derived from times when the table is written and when it is read."""
    root = work_dir(s)
    writers.append(layout.by_day(b.waypoints(s, d).select("event_id", "timestamp")), f"{root}/t", "day")
    return layout.in_range(s.read.parquet(f"{root}/t"), "2024-01-05 06:00:00", "2024-01-09 18:00:00").groupBy("day").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 3 AS removed FROM lineitem")
def orphan_removal_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Files that no version knows go, the table's own stay."""
    root = work_dir(s)
    _small_files(s, d, root)
    known = s.createDataFrame([(f,) for f, _, _ in layout.data_files(s, f"{root}/t")], "file_path string")
    s.read.parquet(f"{root}/t").limit(90).repartition(3).write.mode("append").parquet(f"{root}/t")  # what a failed writer left
    gone = layout.remove_orphans(s, f"{root}/t", known, int(time.time() * 1000) + 60_000)
    return s.read.parquet(f"{root}/t").withColumn("removed", F.lit(len(gone)))


@query("SELECT event_type, event_id, value FROM events WHERE value > 20 UNION ALL SELECT 'none', -1, 0")
def catalog_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """A table from a schema, one from a query over a view, both dropped in the end with their files."""
    root, name = work_dir(s), f"fleet_{uuid.uuid4().hex[:12]}"
    catalog.create_namespace(s, name)
    catalog.register_view(b.table(s, d, "events").select("event_id", "value", "event_type"), f"{name}_events")
    catalog.create_as_select(s, f"{name}.picked", f"SELECT * FROM {name}_events WHERE value > 20", f"{root}/picked", ("event_type",))
    for _ in range(2):  # the second time it is there
        catalog.create_table(s, f"{name}.all_rows", "event_id BIGINT, value DOUBLE, event_type STRING", f"{root}/all", ("event_type",), {"owner.note": "rows of both"})
    s.sql(f"INSERT INTO {name}.all_rows SELECT event_id, value, event_type FROM {name}.picked")
    s.sql(f"INSERT INTO {name}.all_rows VALUES (-1, 0.0, 'none')")
    s.table(f"{name}.all_rows").write.parquet(f"{root}/out")
    for t in ("picked", "all_rows"):
        catalog.drop_table(s, f"{name}.{t}", f"{root}/{'picked' if t == 'picked' else 'all'}")
    s.sql(f"DROP NAMESPACE {name}")
    s.catalog.dropTempView(f"{name}_events")
    return s.read.parquet(f"{root}/out").select("event_type", "event_id", "value")


@query(f"""WITH {WAYPOINTS_SQL}, e AS (SELECT w.*, unnest(range(5)) AS i FROM wp w), k AS (SELECT (CAST(floor(ep / 60) AS BIGINT) - i) * 60 AS window_ep, route_no, ROUND(AVG(speed), 6) AS avg_speed, COUNT(*) AS messages, COUNT(DISTINCT vehicle) AS vehicles, CAST(SUM(CAST(speed > 0 AS INT)) AS BIGINT) AS moving,
 CAST(SUM(CAST(speed = 0 AS INT)) AS BIGINT) AS stopped, CAST(SUM(CAST(sos AS INT)) AS BIGINT) AS sos, CAST(SUM(CAST(ignition AS INT)) AS BIGINT) AS ignition_on FROM e GROUP BY 1, 2) SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY route_no ORDER BY window_ep DESC) = 1""")
def rolling_kpis_last(s: SparkSession, d: str) -> DataFrame:
    """The newest rolling window of each route, put together from stored panes, all measures."""
    root = work_dir(s)
    writers.append(status.vehicle_panes(b.waypoints(s, d)).withColumn("day", F.to_date("pane")), f"{root}/panes", "day")
    kpis = status.pane_kpis(status.merged_vehicle_panes(s.read.parquet(f"{root}/panes"), "5 minutes", "1 minute"), "5 minutes")
    measures = status.MEASURES
    last = kpis.groupBy("route_no").agg(F.max(F.struct("window_start", *measures)).alias("k")).select("route_no", "k.*")
    return last.select(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("window_start")).alias("window_ep"), "route_no", F.round("avg_speed", 6).alias("avg_speed"), *measures[1:])
