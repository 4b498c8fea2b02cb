"""Operators against brute force, and properties that hold whatever the data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefleet.functions.geo import haversine_km, morton
from tidefleet.operators import cleaning, kalman, sequences, stops, trips
from tidefleet.plans import bindings as b

SF = "/root/testdata/sf0.001"


def km(lat1, lng1, lat2, lng2):
    p, q = math.radians(lat2 - lat1), math.radians(lng2 - lng1)
    a = math.sin(p / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(q / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, a)))


def test_haversine(spark):
    rows = [(10.7, 106.6, 10.75, 106.65), (0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").select("*", haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("km"))
    for r in df.collect():
        assert r.km is None if r.a is None else abs(r.km - km(r.a, r.b, r.c, r.d)) < 1e-9


def test_morton_interleaves_bits(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x in (0, 1, 2, 65535) for y in (0, 1, 3)], "x double, y double")
    for r in df.select("x", "y", morton(F.col("x"), F.col("y"), (0, 65535), (0, 65535)).alias("z")).collect():
        assert r.z == sum((int(r.x) >> i & 1) << 2 * i | (int(r.y) >> i & 1) << 2 * i + 1 for i in range(16))


def test_radius_join_finds_every_pair(spark):
    r = np.random.default_rng(1)
    points = [(int(i % 2), int(i), float(106.6 + x), float(10.7 + y)) for i, (x, y) in enumerate(r.uniform(-0.01, 0.01, (120, 2)))]
    df = spark.createDataFrame(points, "route_id int, id long, lng double, lat double")
    found = {(p.a_id, p.b_id) for p in stops.radius_join(df, df).collect()}
    assert found == {(p[1], q[1]) for p in points for q in points if p[0] == q[0] and km(p[3], p[2], q[3], q[2]) <= stops.RADIUS_KM}


def test_stops_around_a_depot(spark):
    """A third of all stops within some metres, as many on one place, others in a ring at about the distance: counts and centres as of all pairs."""
    r = np.random.default_rng(3)
    depot, ring = r.normal(0, 5e-5, (300, 2)), r.uniform(0, 2 * np.pi, 200)
    at = np.concatenate([depot, np.zeros((150, 2)), np.stack([np.cos(ring), np.sin(ring)], 1) * 0.00225 * r.uniform(0.97, 1.05, (200, 1)), r.uniform(-0.01, 0.01, (250, 2))])
    points = [(int(i % 5 == 0), int(i), float(106.6 + x), float(10.7 + y)) for i, (x, y) in enumerate(at)] + [(0, 9999, None, None)]
    df = spark.createDataFrame(points, "route_id int, id long, lng double, lat double")
    plain = {p.a_id: p for p in stops.around(df, hot=10_000).collect()}
    for hot in (2, 40):
        found = {p.a_id: p for p in stops.around(df, hot=hot).collect()}
        assert found.keys() == plain.keys() and len(found) == 900
        for i, p in plain.items():
            f = found[i]
            assert f.density == p.density and abs(f.lng - p.lng) < 1e-9 and abs(f.lat - p.lat) < 1e-9, (i, f, p)


def test_candidates_of_full_cells_without_all_pairs(spark, monkeypatch):
    """Cells of some hundred stops aren't compared pair by pair, and cells that can't hold a candidate are left alone: candidates are as of all pairs, with equals, places of several stops and a route of few."""
    r = np.random.default_rng(4)
    at = [(0, i, 106.6 + x, 10.7 + y) for i, (x, y) in enumerate(zip(r.triangular(-0.006, 0, 0.006, 900), r.uniform(0.0002, 0.0012, 900)))]
    at += [(0, 900 + i, 106.6004, 10.7007) for i in range(12)] + [(1, i, 106.6 + i * 0.0005, 10.7) for i in range(5)]
    monkeypatch.setattr(stops, "radius_join", lambda *_: pytest.fail("all pairs of neighbouring cells"))
    df = spark.createDataFrame([(k, "v", i, float(x), float(y)) for k, i, x, y in at], "route_id int, vehicle string, session_id long, stop_lng double, stop_lat double")
    found = {(c.route_id, c.rank): c for c in stops.terminal_candidates(df).collect()}
    for k in (0, 1):
        p = np.array([(x, y) for route, _, x, y in at if route == k])
        near = np.array([[km(b, a, d, c) <= stops.RADIUS_KM for c, d in p] for a, b in p])
        best = sorted(range(len(p)), key=lambda i: (-near[i].sum(), i))[:8]
        assert sum(key[0] == k for key in found) == len(best)
        for rank, i in enumerate(best, 1):
            c = found[k, rank]
            assert (c.anchor, c.density) == (i + 1, near[i].sum()) and abs(c.lng - p[near[i], 0].mean()) < 1e-9 and abs(c.lat - p[near[i], 1].mean()) < 1e-9


def matrix_filter(ep, x, y, speed):
    """The filter as one of four states, with matrices."""
    h, r = np.eye(2, 4), 1e-6 * np.eye(2)
    start = np.diag([0.1, 0.1, 1.0, 1.0])
    s, p, out, last = np.array([x[0], y[0], 0, 0]), start.copy(), [(x[0], y[0])], ep[0]
    for t, mx, my, v in zip(ep[1:], x[1:], y[1:], speed[1:]):
        dt, last = t - last, t
        if dt > 15 or dt <= 0:
            s, p, dt = np.array([mx, my, 0, 0]), start.copy(), 1.0
        if v <= 2.0:
            s[2:] = 0
            p[2:, :] = 0
            p[:, 2:] = 0
            f, q = np.eye(4), np.diag([1e-12, 1e-12, 0, 0])
        else:
            f = np.eye(4)
            f[0, 2] = f[1, 3] = dt
            a, c, d = dt**4 / 4, dt**3 / 2, dt**2
            q = 1e-11 * np.array([[a, 0, c, 0], [0, a, 0, c], [c, 0, d, 0], [0, c, 0, d]])
        s, p = f @ s, f @ p @ f.T + q
        k = p @ h.T @ np.linalg.inv(h @ p @ h.T + r)
        s, p = s + k @ (np.array([mx, my]) - h @ s), (np.eye(4) - k @ h) @ p
        out.append((s[0], s[1]))
    return np.array(out)


def test_two_state_filters_equal_the_matrix_form():
    r = np.random.default_rng(2)
    ep = np.cumsum(r.choice([5, 10, 14, 40, 0], 200))
    x, y, speed = 106.6 + np.cumsum(r.normal(0, 1e-4, 200)), 10.7 + np.cumsum(r.normal(0, 1e-4, 200)), r.choice([0.0, 1.5, 30.0], 200)
    _, fx, fy = kalman.run(None, ep, x, y, speed <= 2.0)
    assert np.abs(np.stack([fx, fy], 1) - matrix_filter(ep, x, y, speed)).max() < 1e-9
    state, ax, _ = kalman.run(None, ep[:77], x[:77], y[:77], speed[:77] <= 2.0)
    _, bx, _ = kalman.run(state, ep[77:], x[77:], y[77:], speed[77:] <= 2.0)
    assert np.array_equal(np.concatenate([ax, bx]), fx)


def test_a_vector_of_filters_equals_single_ones(spark):
    """The grid's one pass against the filter of each pair alone."""
    rows = b.dense_waypoints(spark, SF).drop("props").filter("vehicle < '11'").cache()
    pairs = [(r, a) for r in kalman.MEASUREMENTS[:2] for a in kalman.ACCELERATIONS[::2]]
    tried = {r.event_id: r for r in kalman.smooth_grid(rows, pairs, "ept").collect()}
    assert len(tried) == rows.count() > 50
    for i, (m, a) in enumerate(pairs):
        for r in kalman.smooth(rows, "ept", single_model=True, measurement=m, acceleration=a).collect():
            assert abs(tried[r.event_id].fx[i] - r.x) < 1e-12 and abs(tried[r.event_id].fy[i] - r.y) < 1e-12


def test_filtered_speed():
    v = np.array([0.0, 1e-4, 1.0])
    assert kalman._filtered_speed(v * 0, v * 0, v * 0, v, 0.5).tolist()[0] == 0.0
    found = kalman._filtered_speed(v * 0, v * 0 + 60, v, v * 0, 7.0)
    assert abs(found[1] - 1e-4 * 111_320 * 3.6 * 0.5) < 1e-9 and found[2] == 7.0


def test_calibration_falls_back(spark):
    some = spark.createDataFrame([("a", 1e-12, 1e-12, 3), ("b", 3e-9, 1e-12, 2), ("c", 1e-9, 5e-9, 2)], "vehicle string, var_x double, var_y double, runs long")
    found = {r.vehicle: (r.var_x, r.var_y) for r in kalman.calibration_table(some).collect()}
    assert set(found) == {"b", "c", "global"} and abs(found["global"][0] - 2e-9) < 1e-20
    alone = [tuple(r) for r in kalman.calibration_table(some.filter("vehicle = 'a'")).collect()]
    assert alone == [("global", 1e-9, 1e-9)]


def test_mapping_override(spark):
    pings = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "vehicle string, route_id int")
    mapping = spark.createDataFrame([("a", 9), ("a", 8), (None, 7)], "vehicle string, route_id int")
    assert sorted((r.vehicle or "", r.route_id) for r in cleaning.override_routes(pings, mapping).collect()) == [("", 3), ("a", 8), ("b", 2)]


def test_sequences_take_the_vehicles_first_route_and_no_pause(spark):
    rows = [(i, "a", 5 if i else 6, 10 * i + (400 if i > 14 else 0), float(i), 0.0, 1.0, None if i == 3 else 10.0 * i, True, False, None) for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, vehicle string, route_id int, ep long, x double, y double, speed double, heading double, door_up boolean, door_down boolean, working boolean")
    found = sequences.sequence_windows(sequences.delta_features(df), length=5).orderBy("first").collect()
    assert {r.route_id for r in found} == {5} and all(r.waypoint_count == 5 for r in found)  # the vehicle's first row has no delta
    assert found[0].door_up_0 == 1.0 and found[0].working_0 is None and found[0].delta_heading_2 == 0.0
    assert len(found) == 23 and all(r.delta_time_4 == 10.0 for r in found)  # the pause's own row isn't a feature row


def test_routes_met_by_cells_are_those_of_all_pairs(spark):
    from tidefleet.operators import routes

    w, ends = b.waypoints(spark, SF), b.routes(spark, SF)
    found = {(r.vehicle, r.candidate): (round(r.a_km, 9), round(r.b_km, 9)) for r in routes.route_candidates(w, ends).collect()}
    places = w.select("vehicle", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")).distinct().collect()
    expected = {}
    for e in ends.collect():
        for p in places:
            a, c = expected.get((p.vehicle, e.route_id), (math.inf, math.inf))
            expected[p.vehicle, e.route_id] = (min(a, km(p.y, p.x, e.a_lat, e.a_lng)), min(c, km(p.y, p.x, e.b_lat, e.b_lng)))
    near = {k: (round(a, 9), round(c, 9)) for k, (a, c) in expected.items() if a <= 0.6 and c <= 0.6}
    assert found == near and near


def test_trips_are_numbered_without_gaps_and_add_up(spark):
    seg = trips.segment_trips(b.waypoints(spark, SF), b.routes(spark, SF).drop("route_no", "path"), gap=b.GAP_SECONDS).cache()
    per = seg.groupBy("vehicle").agg(F.max("trip_id").alias("most"), F.count_distinct("trip_id").alias("n"), F.min("trip_id").alias("least")).collect()
    assert per and all(r.most == r.n and r.least == 1 for r in per)
    total = seg.agg(F.sum("segment_km")).collect()[0][0]
    summed = trips.trip_summary(seg, least_km=-1, least_outside=-1).agg(F.sum("total_km")).collect()[0][0]
    assert abs(total - summed) < 1e-6


def test_sequences_are_as_many_as_rows_allow(spark):
    f = sequences.delta_features(b.dense_waypoints(spark, SF), "ept").cache()
    expected = sum(max(0, r["count"] - 10) for r in f.groupBy("vehicle").count().collect())
    assert sequences.sequence_windows(f, "ept").count() == expected > 0


def test_one_row_per_key_whatever_the_partitions(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("v"), "id")
    a, c = (sorted(map(tuple, cleaning.one_per_key(df.repartition(n), ["k"], F.desc("v"), F.col("id")).collect())) for n in (1, 5))
    assert a == c and len(a) == 7


def test_mapping_with_several_routes_does_not_multiply_rows(spark):
    pings = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "vehicle string, event_id int")
    mapping = spark.createDataFrame([("a", 5, "x"), ("a", 4, "y"), (None, 1, "z")], "vehicle string, route_id int, route_no string")
    assert sorted(tuple(r)[1:] for r in cleaning.enrich(pings, mapping).collect()) == [(1, 4, "y"), (2, None, None), (3, None, None)]


def test_plans(spark):
    w = b.waypoints(spark, SF)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    from tidefleet.operators.status import latest_status

    assert "WindowGroupLimit" in plan(latest_status(w))
    lines = plan(b.table(spark, SF, "lineitem").filter("l_orderkey = 5").select("l_tax"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in lines and "EqualTo(l_orderkey,5)" in lines
    assert plan(sequences.delta_features(w)).count("Exchange hashpartitioning(vehicle") == 1
