"""Streaming pipelines: cleaning, windows, smoothing with state, latest status, metrics."""

from __future__ import annotations

import csv
import json
import os
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidefleet.operators.cleaning import enrich, local_columns, valid_gps
from tidefleet.operators.kalman import MEASUREMENT, STATE_SECONDS, State, _resting, run, state_columns
from tidefleet.operators.status import fleet_snapshot, latest_status, panes, vehicle_panes
from tidefleet.sources.published import Published, batch_of


#: What tells pings apart, and what tells them apart where each has an id of its own: a vehicle may send several in one second.
PING_KEYS, EVENT_KEYS = ("vehicle", "timestamp"), ("event_id", "timestamp")


def unique_pings(stream: DataFrame, late: str = "15 minutes", keys: tuple[str, ...] = PING_KEYS) -> DataFrame:
    """One ping for each key, which has the time in it; how long duplicates are known is bounded by the watermark."""
    return stream.withWatermark("timestamp", late).dropDuplicates([*keys])


def silver(stream: DataFrame, mapping: DataFrame, late: str = "15 minutes", smooth_by: str | None = None, keys: tuple[str, ...] = PING_KEYS) -> DataFrame:
    """Deduplicated, enriched, valid pings with local dates; places smoothed along the column smooth_by, if given. The sink sorts each batch by cleaning.silver_order."""
    kept = valid_gps(enrich(unique_pings(stream, late, keys), mapping))
    if smooth_by:
        kept = _smoothed(kept, smooth_by, STATE_SECONDS)
    return local_columns(kept.withColumn("instant", F.col("timestamp")).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def route_panes(stream: DataFrame, mapping: DataFrame, late: str = "10 minutes", width: str = "1 minute", exact: bool = False) -> DataFrame:
    """Panes of each route's vehicles, for update mode: state holds a row for each route and pane, however wide the windows that are asked for later; where vehicles are to be counted exactly, one for each vehicle too."""
    return (vehicle_panes if exact else panes)(enrich(stream, mapping, "inner").withWatermark("timestamp", late), "timestamp", width)


def vehicle_sessions(stream: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each vehicle that end after a pause longer than gap: a ping just a gap after another is of its session."""
    sessions = stream.withWatermark("timestamp", late).groupBy(F.session_window("timestamp", gap).alias("s"), "vehicle").agg(F.count("*").alias("pings"))
    return sessions.select("vehicle", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "pings")


STATE = "ep double, x double, y double, vx double, vy double, place double, cross double, speed double"


def smooth_stream(stream: DataFrame, by: str = "ep", late: str = "15 minutes", seconds: int = STATE_SECONDS, noise: DataFrame | None = None) -> DataFrame:
    """x and y replaced by the Kalman filter's, whose state goes on from batch to batch.

    timestamp is the instant of the column by (epoch seconds). A vehicle's state is dropped
    when the watermark is so many seconds past its last ping. What a vehicle sends
    in one batch is sorted in memory; a ping before the last batch's makes the
    filter start anew from it. noise (vehicle, measurement) is where the first
    run of a query takes each vehicle's measurement variance from; others have the
    usual one. Start the query within state_store().
    """
    return _smoothed(stream.withWatermark("timestamp", late), by, seconds, noise)


class Smoother(StatefulProcessor):
    """One vehicle's filter on a stream: its state, and its own measurement noise if the initial state has one.

    A timer ends the state when the watermark is so many seconds past its last
    ping. A time to live by the clock would keep a query that ends when all is
    read from ever ending.
    """

    def __init__(self, by: str, seconds: int):
        self.by, self.seconds = by, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.filter = handle.getValueState("filter", STATE)
        self.noise = handle.getValueState("noise", "measurement double")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Measurement variance of the vehicle, from the calibration table."""
        self.noise.update((float(initialState["measurement"].iloc[0]),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pings = pd.concat(list(rows)).sort_values([self.by, "event_id"])  # a vehicle's pings of one batch
        before = State(*self.filter.get()) if self.filter.exists() else None
        measurement = self.noise.get()[0] if self.noise.exists() else MEASUREMENT
        after, x, y = run(before, pings[self.by].to_numpy(float), pings["x"].to_numpy(float), pings["y"].to_numpy(float), _resting(pings["speed"]), measurement=measurement)
        self.filter.update(state_columns(after))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(int(after.ep + self.seconds) * 1000, timerValues.getCurrentWatermarkInMs() + 1))
        yield pings.assign(x=x, y=y)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.filter.clear()
        return iter([])

    def close(self) -> None:
        pass


def _smoothed(stream: DataFrame, by: str, seconds: int, noise: DataFrame | None = None) -> DataFrame:
    initial = None if noise is None else noise.select("vehicle", "measurement").groupBy("vehicle")
    return stream.groupBy("vehicle").transformWithStateInPandas(Smoother(by, seconds), stream.schema, "append", "EventTime", initial)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKS) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which state with timers needs; the session's setting is as before afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def to_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Start a query that hands each micro-batch to write; by default it ends when all that is there has been read."""
    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def to_partitions(stream: DataFrame, send: Callable[[Iterator[Row], tuple[str, int, int]], None], checkpoint: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Start a query that hands each partition of each batch to send, in the task that holds it, as an iterator of rows.

    send opens its own connection, as nothing else crosses to the task. It also
    gets the query's id, the batch's number and the partition's: a batch or a task
    that comes again has the same, so that a store can tell what it has taken in.
    """

    def write(batch: DataFrame, number: int) -> None:
        query, number = batch_of(batch, number)

        def each(rows: Iterator[Row]) -> None:
            send(rows, (query, number, TaskContext.get().partitionId()))

        batch.foreachPartition(each)

    return to_batches(stream, write, checkpoint, mode, trigger)


def to_files(stream: DataFrame, path: str, checkpoint: str, *partitions: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a query into Parquet files by the streaming file sink, in folders by some columns."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*partitions)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def last_wins(path: str, keys: list[str], partition: str, keep: int = 3) -> Callable[[DataFrame, int], None]:
    """A writer for update mode into a published table: a batch's rows replace those of their keys, and only the files that hold such a key are read and written.

    The table is in folders by partition. A batch that stops anywhere and is
    repeated, or that comes twice, changes nothing else.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            table = Published(batch.sparkSession, path, keys[0])
            if not batch.isEmpty():
                table.upsert(batch, keys, partition, source=batch_of(batch, number), nulls_match=True)
                table.vacuum(keep)
        finally:
            batch.unpersist()

    return write


def serving(log: str, latest: str, kpis: str, order: tuple[str, ...] = ("ep", "event_id"), seconds: int = STATE_SECONDS, digits: int = 2, keep: int = 3) -> Callable[[DataFrame, int], None]:
    """A writer that feeds three published tables from each batch: the log of pings, the latest ping of each vehicle, and fleet KPIs of those.

    A vehicle whose latest ping lies so many seconds before the newest of all is
    stale: it leaves the latest table, and with it the KPIs. Each table takes a
    batch once, so a batch that stops between two of them is made up for when it
    is repeated, and a new checkpoint goes on from what the tables hold.
    """
    merge = newest(["vehicle"], *order)

    def write(batch: DataFrame, number: int) -> None:
        spark, source = batch.sparkSession, batch_of(batch, number)
        batch.persist()
        try:
            Published(spark, log).append(batch, source=source)
            versioned(latest, lambda old, new: fresh(merge(old, new), order[0], seconds), keep)(batch, number)
        finally:
            batch.unpersist()
        table = Published(spark, kpis)
        table.replace(snapshot(Published(spark, latest).read(), digits), source=source)
        table.vacuum(keep)

    return write


def fresh(latest: DataFrame, time: str, seconds: int) -> DataFrame:
    """Rows whose time lies at most so many seconds before the newest."""
    last = latest.agg(F.max(time).alias("__newest"))
    return latest.crossJoin(F.broadcast(last)).filter(F.col(time) >= F.col("__newest") - seconds).drop("__newest")  # one row


def versioned(path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], keep: int = 3) -> Callable[[DataFrame, int], None]:
    """A writer that merges each batch into the whole of a published table, of which so many versions stay.

    For tables that stay small, such as one row a vehicle. It goes on from the
    newest version, whatever query wrote that; a batch that is repeated changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = Published(batch.sparkSession, path)
        table.replace(merge(table.read(batch.schema) if table.record() else batch.limit(0), batch), source=batch_of(batch, number))
        table.vacuum(keep)

    return write


def newest(keys: list[str], *order: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Merge by which the last row of each key in an order stays."""
    from tidefleet.operators.cleaning import one_per_key

    return lambda old, new: one_per_key(old.unionByName(new), keys, *(F.desc(c) for c in order))


def snapshot(latest: DataFrame, digits: int = 2) -> DataFrame:
    """Fleet KPIs of a table of latest pings."""
    return fleet_snapshot(latest_status(latest), digits)


def observed(stream: DataFrame, time: str, name: str = "latency") -> DataFrame:
    """stream with least, greatest and mean time (epoch seconds) and count of each batch's rows, measured on the way."""
    seconds = F.col(time).cast("double")
    return stream.observe(name, F.min(seconds).alias("least"), F.max(seconds).alias("greatest"), F.avg(seconds).alias("mean"), F.count(F.lit(1)).alias("rows"))


MEASURES = ("batch_id", "timestamp", "input_rate", "process_rate", "trigger_ms", "write_ms", "rows", "lag", "mean_latency", "least_latency", "greatest_latency", "is_warmup")


class Metrics(StreamingQueryListener):
    """Rates, durations, lag and the latency of observed() rows of every batch; the first few are warm-up."""

    def __init__(self, warm_up: int = 3, observation: str = "latency", clock: Callable[[], float] = time.time):
        self.warm_up, self.observation, self.clock, self.rows = warm_up, observation, clock, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        lag = sum(_offset(s.latestOffset) - _offset(s.endOffset) for s in p.sources)
        seen = (p.observedMetrics or {}).get(self.observation)
        ago = lambda t: None if seen is None or t is None else self.clock() - t
        values = (
            p.batchId, p.timestamp, p.inputRowsPerSecond, p.processedRowsPerSecond, p.durationMs.get("triggerExecution", 0), p.durationMs.get("addBatch", 0), p.numInputRows, lag,
            ago(seen and seen["mean"]), ago(seen and seen["greatest"]), ago(seen and seen["least"]), p.batchId < self.warm_up,
        )
        self.rows.append(dict(zip(MEASURES, values, strict=True)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def summary(self) -> dict[str, dict[str, float]]:
        """Mean, p50, p95 and p99 of each measure over the batches with rows that aren't warm-up."""
        rows = [r for r in self.rows if r["rows"] and not r["is_warmup"]]
        out = {}
        for name in MEASURES[2:-1]:
            if values := [r[name] for r in rows if r[name] is not None]:
                out[name] = {"mean": sum(values) / len(values)} | {f"p{p}": percentile(values, p) for p in (50, 95, 99)}
        return out

    def append_csv(self, path: str) -> None:
        """Add the batches so far to a CSV file on the driver's machine, with a header if it is new, and forget them."""
        new = not os.path.exists(path)
        with open(path, "a", newline="") as f:
            w = csv.DictWriter(f, MEASURES)
            if new:
                w.writeheader()
            w.writerows(self.rows)
        self.rows.clear()


def percentile(values: list[float], percent: float) -> float:
    """By linear interpolation between the two nearest ranks; zero of none."""
    if not values:
        return 0.0
    ranked, place = sorted(values), (len(values) - 1) * percent / 100
    low = int(place)
    return ranked[low] + (place - low) * (ranked[min(low + 1, len(ranked) - 1)] - ranked[low])


def _offset(text: str | None) -> int:
    """Sum of the offsets of all partitions of a Kafka source; zero for other sources."""
    try:
        return sum(v for topic in json.loads(text).values() if isinstance(topic, dict) for v in topic.values())
    except (TypeError, ValueError, AttributeError):
        return 0
