"""Queries against their SQL over tables with what only larger ones hold."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.oracle import SF, TABLES, differing
from tidefleet.plans.catalog import ORACLES, QUERIES
from tidefleet.sources import layout, readers


def tables(path, **changed) -> str:
    """The folder of the test tables with some in place of theirs."""
    for t in TABLES:
        if t in changed:
            pq.write_table(changed[t], path / f"{t}.parquet")
        else:
            os.symlink(f"{SF}/{t}.parquet", path / f"{t}.parquet")
    return str(path)


def events(rows) -> pa.Table:
    """Rows of (user, seconds since the year began) as events."""
    start = 1_704_067_200_000_000
    user, at = [u for u, _ in rows], [start + int(t * 1_000_000) for _, t in rows]
    n = len(rows)
    columns = [pa.array(range(n), pa.int64()), pa.array(at, pa.timestamp("us")), pa.array(user, pa.int64()), ["click", "view", "error", "signup"] * (n // 4) + ["view"] * (n % 4), pa.array([float(i % 97) for i in range(n)]), ['{"k": 1}'] * n]
    return pa.table(columns, ["event_id", "ts", "user_id", "event_type", "value", "props"])


def customers(n: int) -> pa.Table:
    return pa.table([pa.array(range(n), pa.int64()), [f"c{i}" for i in range(n)], pa.array([i % 2 for i in range(n)], pa.int32()), [0.0] * n, ["x"] * n], ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def agrees(spark, name, sf) -> bool:
    return differing(spark, name, QUERIES[name], ORACLES[name], sf) == []


def crowd(path) -> str:
    """Windows of thousands of vehicles, some of them seen in several of a window's minutes."""
    rows = [(u, 3600 + u * 7919 % 240) for u in range(12_000)] + [(u, 3600 + 60 * m) for u in range(0, 12_000, 5) for m in (0, 2, 7)]
    return tables(path, customer=customers(12_000), events=events(rows))


def test_vehicles_of_crowded_windows_are_counted_exactly(spark, tmp_path):
    sf = crowd(tmp_path)
    assert [n for n in ("sliding_window_kpis", "stream_route_window_kpis", "rolling_kpis_last", "kpi_snapshot_last") if not agrees(spark, n, sf)] == []


def test_pings_of_one_second_are_all_kept(spark, tmp_path):
    """Two events of one vehicle in one second are two pings; only copies of an event go."""
    sf = tables(tmp_path, customer=customers(9), events=events([(u, 1000 * u + t) for u in range(9) for t in (0.1, 0.7, 5)]))
    assert agrees(spark, "stream_dedup_enrich", sf)


def test_sessions_end_by_pauses_just_over_the_gap(spark, tmp_path):
    half = 43_200
    sf = tables(tmp_path, customer=customers(9), events=events([(u, at) for u in range(9) for at in (100, 100 + half - 1 + u % 3, 100 + 2 * half + u, 100 + 2 * half + u + half + 1)]))
    assert agrees(spark, "stream_session", sf)


def test_health_of_files_over_the_usual_least_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout.table_health, "__defaults__", (100,))
    assert agrees(spark, "table_health", SF)


def test_sketches_are_kept_by_route_only(spark):
    plan = QUERIES["approx_active_vehicles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    held = [x for x in plan.splitlines() if "approx_count_distinct" in x and "keys=" in x]
    assert len(held) > 1 and not any("vehicle" in x.split("functions=")[0] for x in held)


def test_rewrites_of_many_rows_take_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_A_FILE", 1000, raising=False)
    path = f"file://{tmp_path}"
    spark.range(10_000).selectExpr("id", "id % 100 AS x", "id DIV 100 AS y").write.parquet(f"{path}/t")
    layout.sort_rewrite(spark, f"{path}/t", f"{path}/sorted", ["x", "y"], 4)
    layout.z_order_rewrite(spark, f"{path}/t", f"{path}/z", "x", "y", 4)
    for out in ("sorted", "z"):
        assert spark.read.parquet(f"{path}/{out}").count() == 10_000 and len(layout.data_files(spark, f"{path}/{out}")) == 10


STREAMS = ("stream_kalman_state", "stream_silver_chain", "stream_file_sink", "stream_tumbling", "stream_route_window_kpis", "stream_late_rows", "stream_latest_upsert", "fleet_snapshot_stream", "event_router")


@pytest.mark.parametrize("name", STREAMS)
def test_parts_of_many_rows_take_several_files(spark, monkeypatch, name):
    """A batch then reads several files, and sees the same rows."""
    monkeypatch.setattr(readers, "ROWS_A_FILE", 1500, raising=False)
    seen, read = [], readers.table_stream
    monkeypatch.setattr(readers, "table_stream", lambda s, path, schema, files=None: (seen.append((files, len(layout.data_files(s, path)))), read(s, path, schema, files))[1])
    assert agrees(spark, name, SF)
    assert all(files > 1 and found % files == 0 and found >= 2 * files for files, found in seen) and seen
