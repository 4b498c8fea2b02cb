"""Running values and smoothing where one key holds half of all rows, against windows and the filter in one task."""

from statistics import median

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidefleet.operators import kalman, kalman_elements, routes, scans, stops, trips
from tidefleet.operators.scans import Tracks, lag, last, total
from tidefleet.plans import bindings as b

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(scans, "LEAST_ROWS", 1)


def differ(a, c):
    c = c.select(*a.columns)
    return a.exceptAll(c).count() + c.exceptAll(a).count()


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Half the rows of one key, a quarter of the null key, ties in time, nulls in times and values."""
    path = f"file://{tmp_path_factory.mktemp('scans')}/t"
    spark.range(40_000).selectExpr("id", "CASE WHEN id % 4 < 2 THEN 'hot' WHEN id % 4 = 3 THEN 'v' || id % 977 END AS k", "CASE WHEN id % 501 <> 0 THEN id * 7919 % 10007 END AS t", "CASE WHEN id % 5 = 0 THEN id END AS v", "CAST(id % 7 = 0 AS INT) AS f").write.parquet(path)
    return spark.read.parquet(path)


def test_scans_equal_windows(uneven):
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    expected = uneven.withColumns({"before": F.lag("v").over(w), "sum": F.sum("v").over(upto), "filled": F.last("v", True).over(upto)})
    expected = expected.withColumn("known", F.coalesce(F.col("before").isNotNull().cast("int"), F.lit(0))).withColumn("n", F.sum("known").over(upto))
    for parts in (3, 64):
        track = Tracks.of(uneven, ["k"], "t", "id", parts=parts)
        assert track.hot
        found = track.scan(before=lag("v"), sum=total("v"), filled=last("v")).add(known=F.coalesce(F.col("before").isNotNull().cast("int"), F.lit(0))).scan(n=total("known"))
        assert differ(found.plain(), expected) == 0


def test_blocks_are_few_and_even(spark, uneven):
    found = scans.blocks(uneven, ["k"], "t", 64).collect()
    assert {r.k for r in found} == {"hot", None} and len(found) <= 128
    assert scans.blocks(uneven.filter("k <> 'hot'"), ["k"], "t", 64) is None and scans.blocks(uneven.limit(0), ["k"], "t", 64) is None
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = Tracks.of(uneven, ["k"], "t", "id", parts=64).scan(n=total("f")).rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == 4 and max(r["count"] for r in rows) <= 2 * median(r["count"] for r in rows)


def test_one_time_of_a_hot_key_is_one_block(spark):
    rows = spark.range(1000).selectExpr("id", "'a' AS k", "7 AS t", "1 AS f")
    found = Tracks.of(rows, ["k"], "t", "id", parts=8).scan(n=total("f")).plain().orderBy("id").collect()
    assert [r.n for r in found] == list(range(1, 1001))


@pytest.fixture(scope="module")
def pings(spark, tmp_path_factory):
    """The small tables' pings, half of them of one vehicle."""
    path = f"file://{tmp_path_factory.mktemp('pings')}/t"
    w = b.dense_waypoints(spark, SF).withColumn("ep", F.col("event_id") * 10 + F.floor(F.col("event_id") / 17) * 4000)
    w = w.withColumn("vehicle", F.when(F.col("event_id") % 2 == 0, "1").otherwise(F.col("vehicle"))).withColumn("route_id", F.when(F.col("event_id") % 2 == 0, 3).otherwise(F.col("route_id")))
    w.withColumn("speed", F.when(F.floor(F.col("event_id") / 40) % 2 == 0, 0.0).otherwise(F.col("speed"))).drop("props").write.parquet(path)
    return spark.read.parquet(path)


OPERATORS = {
    "sessions": lambda s, w: stops.stop_sessions(w, gap=5000, least=20),
    "segments": lambda s, w: trips.segment_trips(w, b.routes(s, SF).drop("route_no", "path")),
    "gap_trips": lambda s, w: trips.gap_trips(w, routes.both_terminals(b.routes(s, SF).select("route_id", F.lit(1).alias("route_var_id"), F.lit(True).alias("outbound"), "path")), least_km=0),
    "detected": lambda s, w: routes.detect_routes(w, w.select("vehicle", F.lit(3).alias("route_id")).distinct(), b.stops(s, SF), digits=2, tolerance=0.01),
    "calibrated": lambda s, w: kalman.calibrate(w).withColumn("var_x", F.round("var_x", 12)).withColumn("var_y", F.round("var_y", 12)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_are_the_same_in_blocks(spark, pings, monkeypatch, name):
    found = []
    for parts in (1, 40):
        monkeypatch.setattr(scans, "parts_of", lambda rows, n=parts: n)
        rows = OPERATORS[name](spark, pings).withColumns({c: F.round(c, 9) for c in ("stop_lng", "stop_lat", "total_km", "segment_km") if c in OPERATORS[name](spark, pings).columns})
        found.append(sorted(map(str, rows.collect())))
    assert found[0] == found[1] and len(found[0]) > 3


def track(n, seed, steps=(5, 10, 14, 40, 0)):
    r = np.random.default_rng(seed)
    return np.cumsum(r.choice(steps, n)).astype(float), 106.6 + np.cumsum(r.normal(0, 1e-4, n)), 10.7 + np.cumsum(r.normal(0, 1e-4, n)), r.random(n) < 0.3


def test_runs_side_by_side_equal_one_after_another():
    parts = [track(n, n) for n in (1, 2, 300, 17, 90)]
    new = np.concatenate([np.arange(len(p[0])) == 0 for p in parts])
    state, x, y = kalman.run_all(None, *(np.concatenate(c) for c in zip(*parts, strict=True)), new)
    alone = [kalman.run(None, *p) for p in parts]
    assert np.array_equal(x, np.concatenate([a[1] for a in alone])) and np.array_equal(y, np.concatenate([a[2] for a in alone])) and state == alone[-1][0]
    for cut in (1, 40, 123):
        p = parts[2]
        middle, *_ = kalman.run(None, *(c[:cut] for c in p))
        end, x, _ = kalman.run_all(middle, *(c[cut:] for c in p), np.zeros(300 - cut, bool))
        assert np.array_equal(x, alone[2][1][cut:]) and end == alone[2][0]


def test_elements_lead_where_steps_lead():
    ep, x, y, rest = track(400, 5, (5, 10, 14))
    x, y = x - x[0], y - y[0]
    begin, *_ = kalman.run(None, ep[:3], x[:3], y[:3], rest[:3])
    end, *_ = kalman.run(None, ep, x, y, rest)
    each = kalman_elements.steps(np.diff(ep)[2:], x[3:], y[3:], rest[3:], kalman.MEASUREMENT, kalman.ACCELERATION, kalman.DRIFT)
    pieces = kalman_elements.joined([kalman_elements.folded(each.take(slice(a, a + 60))) for a in range(0, 397, 60)])
    for whole in (kalman_elements.folded(each), kalman_elements.folded(pieces)):
        m, p = kalman_elements.applied(whole, *kalman._matrices(begin))
        assert np.allclose([*m.ravel(), *p.ravel()], [end.x, end.y, end.vx, end.vy, end.place, end.cross, end.cross, end.speed], rtol=1e-9, atol=1e-13)


@pytest.mark.parametrize("pause", [0, 100])
def test_one_vehicle_in_many_tasks(spark, tmp_path, pause):
    """A run without an end and one of many pauses; a sixth of the rows are of other vehicles or of none."""
    n = 60_000
    rows = spark.range(n).selectExpr("id AS event_id", "CASE WHEN id % 6 > 0 THEN 'hot' WHEN id % 12 > 0 THEN 'v' || id % 203 END AS vehicle", f"id + floor(id / 700) * {pause} AS ep", "106.6 + sin(id / 900D) / 20 + (id * 7919 % 1000) * 1e-6 AS x", "10.7 + (id * 104729 % 1000) * 1e-6 AS y", "CASE WHEN id % 40 < 6 THEN 0D ELSE 30D END AS speed")
    rows.write.parquet(f"file://{tmp_path}/t")
    rows = spark.read.parquet(f"file://{tmp_path}/t")
    assert scans.blocks(rows, ["vehicle"], "ep", 16).filter("vehicle = 'hot'").count() > 10
    found = {r.event_id: (r.x, r.y) for r in kalman.smooth(rows, parts=16).collect()}
    expected = {r.event_id: (r.x, r.y) for r in kalman.smooth(rows, parts=1).collect()}
    assert found.keys() == expected.keys() and len(found) == n - n // 12
    assert max(max(abs(a[0] - c[0]), abs(a[1] - c[1])) for a, c in zip(map(found.get, sorted(found)), map(expected.get, sorted(found)), strict=True)) < 1e-10
