"""Streams: metrics, late rows, restarts, replays and expiry of state."""

import csv
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidefleet.operators import kalman
from tidefleet.sources import readers, writers
from tidefleet.streaming import pipelines as p


def run(query):
    query.awaitTermination()
    query.stop()


def test_metrics_with_observed_latency(spark, tmp_path):
    spark.range(50).select("id", (F.lit(1000) + F.col("id")).alias("at")).repartition(3).write.parquet(f"file://{tmp_path}/in")
    listener = p.Metrics(warm_up=1, clock=lambda: 2000.0)
    spark.streams.addListener(listener)
    try:
        stream = p.observed(readers.table_stream(spark, f"file://{tmp_path}/in", "id long, at long", 1), "at")
        run(p.to_batches(stream, lambda batch, n: batch.write.format("noop").mode("overwrite").save(), f"file://{tmp_path}/state"))
        for _ in range(100):
            if sum(r["rows"] for r in listener.rows) == 50:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["rows"] for r in listener.rows) == 50 and all(r["lag"] == 0 for r in listener.rows)
    assert [r["is_warmup"] for r in listener.rows[:2]] == [True, False]
    seen = [r for r in listener.rows if r["rows"]]
    assert all(951 <= r["least_latency"] <= r["mean_latency"] <= r["greatest_latency"] <= 1000 for r in seen) and max(r["greatest_latency"] for r in seen) == 1000
    summary = listener.summary()
    rates = [r["process_rate"] for r in seen if not r["is_warmup"]]
    assert summary["process_rate"]["p50"] == p.percentile(rates, 50) and summary["mean_latency"]["mean"] > 900
    n = len(listener.rows)
    for _ in range(2):
        listener.append_csv(str(tmp_path / "log.csv"))
    rows = list(csv.DictReader(open(tmp_path / "log.csv")))
    assert len(rows) == n and set(rows[0]) == set(p.MEASURES) and listener.rows == []


def test_percentiles_lie_between_ranks():
    assert p.percentile([], 50) == 0 and p.percentile([3], 99) == 3
    assert p.percentile([4, 1, 3, 2], 50) == 2.5 and p.percentile([0, 10], 95) == 9.5 and p.percentile([0, 10], 100) == 10


def test_lag_of_kafka_offsets():
    assert p._offset('{"t": {"0": 5, "1": 7}, "u": {"0": 1}}') == 13
    assert p._offset(None) == p._offset("{}") == p._offset("17") == p._offset('{"logOffset": 3}') == 0


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    """Rows that came before a restart aren't read again, and state is kept: a duplicate of an earlier run is known."""
    path, rows = f"file://{tmp_path}/in", lambda *r: spark.createDataFrame(list(r), "vehicle string, at long").select("vehicle", F.timestamp_seconds("at").alias("timestamp"))
    batches = []
    for more in (rows(("a", 100), ("a", 100), ("b", 100)), rows(("a", 100), ("c", 160))):
        readers.replay(more, path, 1, "timestamp")
        stream = p.unique_pings(readers.table_stream(spark, path, more.schema), "1 hour")
        run(p.to_batches(stream, lambda batch, n: batches.append((n, sorted(r.vehicle for r in batch.collect()))), f"file://{tmp_path}/state"))
    assert [v for _, v in batches if v] == [["a", "b"], ["c"]]
    assert len({n for n, _ in batches}) == len(batches)


def test_rows_later_than_the_watermark_go(spark, tmp_path):
    path, rows = f"file://{tmp_path}/in", lambda *r: spark.createDataFrame(list(r), "vehicle string, at long").select("vehicle", F.timestamp_seconds("at").alias("timestamp"))
    kept = []
    for more in (rows(("a", 10_000)), rows(("b", 9_500), ("c", 8_000))):  # the watermark is 9400 then
        readers.replay(more, path, 1, "timestamp")
        stream = p.unique_pings(readers.table_stream(spark, path, more.schema), "10 minutes")
        run(p.to_batches(stream, lambda batch, n: kept.extend(r.vehicle for r in batch.collect()), f"file://{tmp_path}/state"))
    assert kept == ["a", "b"]


def test_state_of_the_smoother_expires(spark, tmp_path):
    """After the watermark has passed a vehicle's state, its next ping starts anew; before that the filter goes on."""
    schema = "event_id long, vehicle string, ep long, x double, y double, speed double, timestamp timestamp"
    row = lambda i, v, t, x: (i, v, t, x, 10.0, 30.0, pd.Timestamp(t, unit="s").to_pydatetime())
    out = {}
    for rows in ([row(1, "a", 100_000, 106.0), row(2, "b", 100_000, 106.0)], [row(3, "a", 100_010, 106.001), row(4, "b", 130_000, 107.0)], [row(5, "c", 200_000, 1.0)], [row(6, "a", 200_010, 108.0)]):
        readers.replay(spark.createDataFrame(rows, schema), f"file://{tmp_path}/in", 1, "ep")
        stream = p.smooth_stream(readers.table_stream(spark, f"file://{tmp_path}/in", schema), "ep", "1 minute", 3600)
        with p.state_store(spark):
            run(p.to_batches(stream, lambda batch, n: out.update({r.event_id: r.x for r in batch.collect()}), f"file://{tmp_path}/state"))
    assert 106.0 < out[3] < 106.001 and out[4] == 107.0 and out[6] == 108.0


def test_noise_of_each_vehicle_is_its_initial_state(spark, tmp_path):
    """What the calibration table says of a vehicle holds from its first ping and over restarts; others have the usual noise."""
    schema = "event_id long, vehicle string, ep long, x double, y double, speed double, timestamp timestamp"
    row = lambda i, v, t, x: (i, v, t, x, 10.0, 30.0, pd.Timestamp(t, unit="s").to_pydatetime())
    noise = spark.createDataFrame([("a", 1e-9), ("c", 1e-9)], "vehicle string, measurement double")
    steps, out = [[106.0, 106.0004], [106.0002, 106.0007]], {}
    for part, places in enumerate(steps):
        rows = [row(10 * part + 2 * j + (v == "b"), v, 100_000 + 10 * (2 * part + j), x) for j, x in enumerate(places) for v in "ab"]
        readers.replay(spark.createDataFrame(rows, schema), f"file://{tmp_path}/in", 1, "ep")
        stream = p.smooth_stream(readers.table_stream(spark, f"file://{tmp_path}/in", schema), "ep", "1 hour", 3600, noise)
        with p.state_store(spark):
            run(p.to_batches(stream, lambda batch, n: out.update({r.event_id: r.x for r in batch.collect()}), f"file://{tmp_path}/state"))
    ep, x = np.array([100_000.0, 100_010, 100_020, 100_030]), np.array(sum(steps, []))
    for v, measurement in ((0, 1e-9), (1, kalman.MEASUREMENT)):
        _, expected, _ = kalman.run(None, ep, x, x * 0 + 10.0, np.zeros(4, bool), measurement=measurement)
        assert np.allclose([out[i + v] for i in (0, 2, 10, 12)], expected, atol=1e-12, rtol=0)
    assert out[12] != out[13] and spark.conf.get("spark.sql.streaming.stateStore.providerClass") != p.ROCKS


def test_native_sink_and_trigger(spark, tmp_path):
    spark.range(20).withColumn("day", F.col("id") % 2).repartition(2).write.parquet(f"file://{tmp_path}/in")
    stream = lambda: readers.table_stream(spark, f"file://{tmp_path}/in", "id long, day long")
    q = p.to_files(stream(), f"file://{tmp_path}/out", f"file://{tmp_path}/state", "day", trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    q.stop()
    run(p.to_files(stream(), f"file://{tmp_path}/out", f"file://{tmp_path}/state", "day"))
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == list(range(20))
    assert (tmp_path / "out" / "day=1").is_dir()


def test_each_partition_is_sent_from_its_task(spark, tmp_path):
    """A store of files by (query, batch, partition): rows arrive once, and a second query of the same checkpoint sends nothing again."""
    store = str(tmp_path / "store")
    spark.range(100).repartition(5).write.parquet(f"file://{tmp_path}/in")

    def send(rows, source):
        import os

        os.makedirs(store, exist_ok=True)
        with open(f"{store}/{'-'.join(map(str, source))}", "w") as f:
            f.writelines(f"{r.id}\n" for r in rows)

    for _ in range(2):
        run(p.to_partitions(readers.table_stream(spark, f"file://{tmp_path}/in", "id long", 3), send, f"file://{tmp_path}/state"))
    files = list((tmp_path / "store").iterdir())
    assert sorted(int(x) for f in files for x in f.read_text().split()) == list(range(100))
    assert len(files) > 2 and len({f.name.rsplit("-", 2)[0] for f in files}) == 1 and {f.name.rsplit("-", 2)[1] for f in files} == {"0", "1"}


def test_router_explodes_and_repeats_safely(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1, [(7,), (8,)]), ("y", 2, None), ("z", 3, None)], "kind string, id int, events array<struct<e: int>>")
    targets = {k: f"file://{tmp_path}/{k}" for k in ("x", "y", "none")}
    for _ in range(2):
        writers.by_type(rows, "kind", targets, {"x": "events"}, "batch=0")
    assert sorted(r.e for r in spark.read.parquet(targets["x"]).collect()) == [7, 8] and spark.read.parquet(targets["y"]).count() == 1
    assert not (tmp_path / "none").exists() and not (tmp_path / "z").exists()
