"""Position smoothing per vehicle: a Kalman filter with a model at rest and one in motion.

East and north don't influence each other, so each is a filter of two states,
place and speed; both share one covariance, as their noise is the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.geo import haversine_km
from tidefleet.functions.pings import flag
from tidefleet.operators import kalman_elements, scans
from tidefleet.operators.scans import Tracks, lag, total

#: Fixed values of the model: measurement variance (degrees^2), variance of acceleration, longest step (s), speed at rest (km/h), start variances of place and speed, drift at rest.
MEASUREMENT, ACCELERATION, LONGEST, AT_REST, START_PLACE, START_SPEED, DRIFT = 1e-6, 1e-11, 15.0, 2.0, 0.1, 1.0, 1e-12
#: How long a vehicle's state is kept on a stream.
STATE_SECONDS = 7200


@dataclass
class State:
    """One filter, or with arrays in place of numbers (all but ep) a vector of filters."""

    ep: float
    x: float
    y: float
    vx: float = 0.0
    vy: float = 0.0
    place: float = START_PLACE  # covariance
    cross: float = 0.0
    speed: float = START_SPEED

    def step(self, ep: float, x: float, y: float, at_rest: bool, measurement: float = MEASUREMENT, acceleration: float = ACCELERATION) -> None:
        """Take in a later ping. A step too long or not forward starts anew from the ping."""
        dt = ep - self.ep
        if not 0 < dt <= LONGEST:
            none = 0.0 * self.vx
            self.x, self.y, self.vx, self.vy, self.place, self.cross, self.speed, dt = none + x, none + y, none, none, none + START_PLACE, none, none + START_SPEED, 1.0
        self.ep = ep
        if at_rest:
            self.vx = self.vy = self.cross = self.speed = 0.0
            self.place = self.place + DRIFT
        else:
            self.x, self.y = self.x + dt * self.vx, self.y + dt * self.vy
            self.place = self.place + 2 * dt * self.cross + dt * dt * self.speed + acceleration * dt**4 / 4
            self.cross = self.cross + dt * self.speed + acceleration * dt**3 / 2
            self.speed = self.speed + acceleration * dt**2
        total = self.place + measurement
        gain, gain_speed = self.place / total, self.cross / total
        dx, dy = x - self.x, y - self.y
        self.x, self.y, self.vx, self.vy = self.x + gain * dx, self.y + gain * dy, self.vx + gain_speed * dx, self.vy + gain_speed * dy
        self.speed = self.speed - gain_speed * self.cross
        self.place, self.cross = (1 - gain) * self.place, (1 - gain) * self.cross


def run(state: State | None, ep: np.ndarray, x: np.ndarray, y: np.ndarray, at_rest: np.ndarray, **noise: float) -> tuple[State, np.ndarray, np.ndarray]:
    """The state after some pings in their order, and the places that the filter gives them."""
    out_x, out_y = np.array(x, float), np.array(y, float)
    for i in range(len(ep)):
        if state is None:
            state = State(float(ep[i]), float(x[i]), float(y[i]))
        else:
            state.step(float(ep[i]), float(x[i]), float(y[i]), bool(at_rest[i]), **noise)
        out_x[i], out_y[i] = state.x, state.y
    return state, out_x, out_y


#: Runs that are taken in side by side; fewer go on one after another.
SIDE_BY_SIDE = 12


def run_all(state: State | None, ep: np.ndarray, x: np.ndarray, y: np.ndarray, at_rest: np.ndarray, new: np.ndarray, measurement: float = MEASUREMENT, acceleration: float = ACCELERATION) -> tuple[State, np.ndarray, np.ndarray]:
    """What run() gives for many vehicles' pings, one vehicle after another; new marks each one's first, state is that before the first of all.

    Between two steps that make the filter start anew nothing is handed on, so
    such runs are taken in side by side: first the first pings of all, then the
    second ones, and so on.
    """
    n, out_x, out_y = len(ep), np.array(x, float), np.array(y, float)
    dt = np.diff(ep, prepend=state.ep if state else np.inf)
    first = new.copy()
    first[0] |= state is None
    anew = first | ~((dt > 0) & (dt <= LONGEST))
    begins = anew.copy()
    begins[0] = True
    at = np.flatnonzero(begins)
    length = np.diff(at, append=n)
    order = np.argsort(-length, kind="stable")
    at, length = at[order], length[order]
    # states before the first step: where a run begins anew it's that of its own ping, and the step is one of a second
    sx, sy, zero = x[at].astype(float), y[at].astype(float), np.zeros(len(at))
    s = [sx, sy, zero.copy(), zero.copy(), zero + START_PLACE, zero.copy(), zero + START_SPEED]
    steps = np.where(anew, 1.0, dt)
    if not anew[0]:
        k = int(np.flatnonzero(order == 0)[0])
        for a, v in zip(s, astuple(state)[1:], strict=True):
            a[k] = v
    for i in range(int(length[0])):
        k = int(np.searchsorted(-length, -i, "left"))  # runs that are longer than i
        if i and k < SIDE_BY_SIDE:
            for r in range(k):
                rows = slice(at[r] + i, at[r] + length[r])
                after, out_x[rows], out_y[rows] = run(State(ep[at[r] + i - 1], *(float(a[r]) for a in s)), ep[rows], x[rows], y[rows], at_rest[rows], measurement=measurement, acceleration=acceleration)
                for a, v in zip(s, astuple(after)[1:], strict=True):
                    a[r] = v
            break
        rows = at[:k] + i
        moved = _step([a[:k] for a in s], steps[rows], x[rows], y[rows], at_rest[rows], measurement, acceleration)
        if not i and first.any():  # a vehicle's first ping is no step
            own = first[rows]
            moved = [np.where(own, a[:k], m) for a, m in zip(s, moved, strict=True)]
        for a, m in zip(s, moved, strict=True):
            a[:k] = m
        out_x[rows], out_y[rows] = s[0][:k], s[1][:k]
    last = int(np.argmax(at))
    return State(float(ep[-1]), *(float(a[last]) for a in s)), out_x, out_y


def _step(s: list[np.ndarray], dt: np.ndarray, x: np.ndarray, y: np.ndarray, at_rest: np.ndarray, measurement: float, acceleration: float) -> list[np.ndarray]:
    """State.step of many filters, each with its own step and kind of motion."""
    px, py, vx, vy, place, cross, speed = s
    vx, vy = np.where(at_rest, 0.0, vx), np.where(at_rest, 0.0, vy)
    px, py = px + dt * vx, py + dt * vy
    place = np.where(at_rest, place + DRIFT, place + 2 * dt * cross + dt * dt * speed + acceleration * dt**4 / 4)
    cross = np.where(at_rest, 0.0, cross + dt * speed + acceleration * dt**3 / 2)
    speed = np.where(at_rest, 0.0, speed + acceleration * dt**2)
    total = place + measurement
    gain, gain_speed = place / total, cross / total
    dx, dy = x - px, y - py
    return [px + gain * dx, py + gain * dy, vx + gain_speed * dx, vy + gain_speed * dy, (1 - gain) * place, (1 - gain) * cross, speed - gain_speed * cross]


def _resting(speed: pd.Series) -> np.ndarray:
    return (speed <= AT_REST).to_numpy()


#: A filter's state in columns.
CARRIED = [f"__{f.name}" for f in fields(State)]


def smooth(pings: DataFrame, time: str = "ep", single_model: bool = False, measurement: float = MEASUREMENT, acceleration: float = ACCELERATION, parts: int | None = None) -> DataFrame:
    """pings with x and y replaced by the filter's; speed stays raw. Pings without a vehicle go.

    A vehicle's rows come to its task in Arrow batches sorted by time, so its
    whole history is never in memory at once. A vehicle that holds more than one
    in parts of all pings is dealt out in blocks of time, each smoothed in a task
    of its own: a first pass reduces each block to one element, from which the
    state before each block follows.
    """
    noise = {"measurement": measurement, "acceleration": acceleration}
    rows = pings.filter("vehicle is not null")
    resting = (lambda part: np.zeros(len(part), bool)) if single_model else (lambda part: _resting(part["speed"]))

    def smoothed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: State | None = None
        vehicle: object = None
        for batch in batches:
            if not len(batch):
                continue
            names = batch["vehicle"].to_numpy()
            new = np.append(names[0] != vehicle, names[1:] != names[:-1])
            state, x, y = run_all(None if new[0] else state, *(batch[c].to_numpy(float) for c in (time, "x", "y")), resting(batch), new, **noise)
            vehicle = names[-1]
            yield batch.assign(x=x, y=y)

    order = ["vehicle", time, "event_id"]
    found = scans.blocks(rows, ["vehicle"], time, parts)
    if found is None:
        return rows.repartition("vehicle").sortWithinPartitions(*order).mapInPandas(smoothed, pings.schema)
    block = scans.BLOCK
    dealt = scans.dealt(rows, found, ["vehicle"], time)
    hot, cold = dealt.filter(F.col(block).isNotNull()), dealt.filter(F.col(block).isNull()).drop(block)
    carried = _carried(hot, time, resting, noise)

    def by_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: State | None = None
        at: object = None
        for batch in batches:
            for key, part in batch.groupby(["vehicle", block], sort=False):
                if key != at:
                    before = part[CARRIED].iloc[0]
                    at, state = key, None if before.isna().any() else State(*map(float, before))
                state, x, y = run_all(state, *(part[c].to_numpy(float) for c in (time, "x", "y")), resting(part), np.zeros(len(part), bool), **noise)
                yield part.drop(columns=[block, *CARRIED]).assign(x=x, y=y)

    handed = F.broadcast(carried.withColumnsRenamed({"vehicle": "__vehicle", "block": "__at"}))
    met = hot.join(handed, (F.col("vehicle") == F.col("__vehicle")) & (F.col(block) == F.col("__at")), "left").drop("__vehicle", "__at")
    large = met.repartition("vehicle", block).sortWithinPartitions("vehicle", block, time, "event_id").mapInPandas(by_block, pings.schema)
    return cold.repartition("vehicle").sortWithinPartitions(*order).mapInPandas(smoothed, pings.schema).unionByName(large)


#: What a block is reduced to: its first ping, the time of its last, and the element of all pings but the first.
REDUCED = "vehicle string, block int, ep double, x double, y double, at_rest boolean, last_ep double, element array<double>"


def _carried(hot: DataFrame, time: str, resting: Callable, noise: dict[str, float]) -> DataFrame:
    """(vehicle, block, CARRIED): the state before each block but a vehicle's first.

    Blocks are reduced where they are; what is left is a row a block, of which
    there are at most twice as many as parts, and those are put together in order.
    """

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: object = None
        row: list = []
        whole: kalman_elements.Elements | None = None

        def out() -> pd.DataFrame:
            flat = [] if whole is None else np.concatenate([m[0].ravel() for m in whole]).tolist()
            return pd.DataFrame([[*row, flat]], columns=["vehicle", "block", "ep", "x", "y", "at_rest", "last_ep", "element"])

        for batch in batches:
            for key, part in batch.groupby(["vehicle", scans.BLOCK], sort=False):
                ep, x, y = (part[c].to_numpy(float) for c in (time, "x", "y"))
                rest = resting(part)
                if key != at:
                    if row:
                        yield out()
                    at, row, whole = key, [key[0], int(key[1]), ep[0], x[0], y[0], bool(rest[0]), ep[0]], None
                    ep, x, y, rest = ep[1:], x[1:], y[1:], rest[1:]
                if not len(ep):
                    continue
                dt = np.diff(ep, prepend=row[6])
                row[6], x, y = ep[-1], x - row[3], y - row[4]  # places from the block's first
                anew = np.flatnonzero(~((dt > 0) & (dt <= LONGEST)))
                if len(anew):  # what was before doesn't matter
                    i = anew[-1]
                    begun = State(-np.inf, 0.0, 0.0)
                    begun.step(ep[i], x[i], y[i], bool(rest[i]), **noise)
                    whole, dt, x, y, rest = kalman_elements.fixed(*_matrices(begun)), dt[i + 1 :], x[i + 1 :], y[i + 1 :], rest[i + 1 :]
                if len(dt):
                    more = kalman_elements.folded(kalman_elements.steps(dt, x, y, rest, drift=DRIFT, **noise))
                    whole = more if whole is None else kalman_elements.after(whole, more)
        if row:
            yield out()

    ordered = hot.select(hot["vehicle"].cast("string").alias("vehicle"), scans.BLOCK, time, "event_id", "x", "y", "speed").repartition("vehicle", scans.BLOCK).sortWithinPartitions("vehicle", scans.BLOCK, time, "event_id")
    per = sorted(ordered.mapInPandas(reduced, REDUCED).collect(), key=lambda r: (r["vehicle"], r["block"]))
    states, vehicle, state = [], None, None
    for r in per:
        if r["vehicle"] != vehicle:
            vehicle, state = r["vehicle"], State(r["ep"], r["x"], r["y"])
        else:
            states.append((vehicle, r["block"], *state_columns(state)))
            state.step(r["ep"], r["x"], r["y"], r["at_rest"], **noise)
        if r["element"]:
            element = kalman_elements.Elements(*np.reshape(r["element"], (5, 1, 2, 2)))
            state.x, state.y = state.x - r["x"], state.y - r["y"]
            m, p = kalman_elements.applied(element, *_matrices(state))
            state = State(r["last_ep"], *map(float, (m[0, 0] + r["x"], m[0, 1] + r["y"], m[1, 0], m[1, 1], p[0, 0], (p[0, 1] + p[1, 0]) / 2, p[1, 1])))
    return hot.sparkSession.createDataFrame(states, "vehicle string, block int, " + ", ".join(f"{c} double" for c in CARRIED))


def _matrices(s: State) -> tuple[np.ndarray, np.ndarray]:
    """Mean (place and speed, in east and north) and covariance of a state."""
    return np.array([[s.x, s.y], [s.vx, s.vy]]), np.array([[s.place, s.cross], [s.cross, s.speed]])


def state_columns(state: State) -> tuple[float, ...]:
    return astuple(state)


def calibrate(pings: DataFrame, time: str = "ep", least: int = 5, floor: float = 1e-12) -> DataFrame:
    """(vehicle, var_x, var_y, runs): mean sample variance of places over runs of at least so many pings at rest."""
    track = Tracks.of(pings.withColumn("rest", flag(F.col("speed") <= AT_REST)), ["vehicle"], time, "event_id", counted=pings).scan(before=lag("rest"))
    changed = track.add(changed=flag(F.coalesce(F.col("before") != F.col("rest"), F.lit(True))))
    runs = changed.scan(run=total("changed")).plain().filter("rest = 1").groupBy("vehicle", "run")
    per = runs.agg(F.count("*").alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy")).filter(F.col("n") >= least)
    return per.groupBy("vehicle").agg(F.avg(F.greatest("vx", F.lit(floor))).alias("var_x"), F.avg(F.greatest("vy", F.lit(floor))).alias("var_y"), F.count("*").alias("runs"))


def global_variance(calibrated: DataFrame, least: float = 1e-10, fallback: float = 1e-9) -> DataFrame:
    """One row: mean variances over vehicles that show any, else a fallback."""
    some = calibrated.filter((F.col("var_x") > least) | (F.col("var_y") > least))
    return some.agg(F.coalesce(F.avg("var_x"), F.lit(fallback)).alias("var_x"), F.coalesce(F.avg("var_y"), F.lit(fallback)).alias("var_y"), F.count("*").alias("vehicles"))


def calibration_table(calibrated: DataFrame, least: float = 1e-10) -> DataFrame:
    """(vehicle, var_x, var_y): vehicles whose places vary at rest, and a row global that holds for all others."""
    some = calibrated.filter((F.col("var_x") > least) | (F.col("var_y") > least)).select("vehicle", "var_x", "var_y")
    return some.unionAll(global_variance(calibrated, least).select(F.lit("global"), "var_x", "var_y"))


def _track(rows: DataFrame, x: str, y: str, time: str, name: str) -> dict[str, Column]:
    w = Window.partitionBy("vehicle").orderBy(time, "event_id")
    km = haversine_km(F.lag(y).over(w), F.lag(x).over(w), F.col(y), F.col(x))
    return {f"{name}_m": km * 1000}


def evaluate(raw: DataFrame, filtered: DataFrame, time: str = "ep", least_seconds: int = 5) -> DataFrame:
    """One row: mean and spread of the shift, and per-vehicle path length and spread of acceleration, raw and filtered.

    Steps shorter than least_seconds go before accelerations are taken, so an
    acceleration may span a step that went.
    """
    both = raw.select("vehicle", "event_id", time, "x", "y").join(filtered.select("vehicle", "event_id", F.col("x").alias("fx"), F.col("y").alias("fy")), ["vehicle", "event_id"])
    w = Window.partitionBy("vehicle").orderBy(time, "event_id")
    steps = both.withColumn("shift_m", haversine_km(F.col("y"), F.col("x"), F.col("fy"), F.col("fx")) * 1000).withColumn("dt", F.col(time) - F.lag(time).over(w))
    steps = steps.withColumns(_track(steps, "x", "y", time, "raw")).withColumns(_track(steps, "fx", "fy", time, "filtered")).filter(F.col("dt") >= least_seconds)
    for s in ("raw", "filtered"):
        steps = steps.withColumn(f"{s}_ms", F.col(f"{s}_m") / F.col("dt"))
    for s in ("raw", "filtered"):
        steps = steps.withColumn(f"{s}_acc", (F.col(f"{s}_ms") - F.lag(f"{s}_ms").over(w)) / F.col("dt"))
    per = steps.groupBy("vehicle").agg(
        F.sum("raw_m").alias("raw_m"), F.sum("filtered_m").alias("filtered_m"), F.sum("shift_m").alias("s1"), F.sum(F.col("shift_m") ** 2).alias("s2"), F.count("*").alias("n"),
        *(f.alias(a) for s in ("raw", "filtered") for f, a in ((F.sum(f"{s}_acc"), f"{s}_a1"), (F.sum(F.col(f"{s}_acc") ** 2), f"{s}_a2"), (F.count(f"{s}_acc"), f"{s}_an"))),
    )
    spread = lambda a1, a2, n: F.sqrt((F.sum(a2) - F.sum(a1) ** 2 / F.sum(n)) / (F.sum(n) - 1))
    out = per.agg(
        F.sum("n").alias("steps"), (F.sum("s1") / F.sum("n")).alias("mean_shift_m"), spread("s1", "s2", "n").alias("std_shift_m"), (F.avg("raw_m") / 1000).alias("raw_km"), (F.avg("filtered_m") / 1000).alias("filtered_km"),
        spread("raw_a1", "raw_a2", "raw_an").alias("raw_acceleration"), spread("filtered_a1", "filtered_a2", "filtered_an").alias("filtered_acceleration"),
    )
    return out.withColumn("path_reduction", (1 - F.col("filtered_km") / F.col("raw_km")) * 100)


def _filtered_speed(x: np.ndarray, y: np.ndarray, vx: np.ndarray, vy: np.ndarray, speed: float) -> np.ndarray:
    """km/h of speeds in degrees a second; the raw speed where they are beyond 120, zero where both are next to nothing."""
    kmh = 3.6 * 111_320.0 * np.hypot(vy, vx * np.cos(np.radians(y)))
    return np.where(kmh > 120.0, speed, np.where((kmh < 0.1) & (speed < 1.0), 0.0, kmh))


def smooth_grid(pings: DataFrame, parameters: list[tuple[float, float]], time: str = "ep") -> DataFrame:
    """(vehicle, event_id, time, x, y, fx, fy, fs): places and speeds of the one-model filter as arrays, an entry for each (measurement, acceleration).

    All parameters go through each vehicle's sorted pings together, as vectors.
    """
    r, a = (np.array(v, float) for v in zip(*parameters, strict=True))

    def smoothed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: State | None = None
        vehicle: object = None
        for batch in batches:
            out = []
            for name, t, x, y, speed in zip(batch["vehicle"], batch[time], batch["x"], batch["y"], batch["speed"], strict=True):
                if state is None or name != vehicle:
                    vehicle, zero = name, np.zeros(len(r))
                    state = State(float(t), zero + x, zero + y, zero, zero, zero + START_PLACE, zero, zero + START_SPEED)
                    out.append((state.x, state.y, zero + speed))
                else:
                    state.step(float(t), x, y, False, r, a)
                    out.append((state.x, state.y, _filtered_speed(state.x, state.y, state.vx, state.vy, speed)))
            columns = [list(map(np.ndarray.tolist, c)) for c in zip(*out, strict=True)] or [[], [], []]
            yield batch[["vehicle", "event_id", time, "x", "y"]].assign(fx=columns[0], fy=columns[1], fs=columns[2])

    rows = pings.select("vehicle", "event_id", time, "x", "y", "speed").filter("vehicle is not null")
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("vehicle", "event_id", time, "x", "y")) + ", fx array<double>, fy array<double>, fs array<double>"
    return rows.repartition("vehicle").sortWithinPartitions("vehicle", time, "event_id").mapInPandas(smoothed, schema)


#: The pairs of parameters that are tried.
MEASUREMENTS, ACCELERATIONS = (1e-9, 5e-9, 1e-8, 5e-8, 1e-7), (1e-11, 5e-11, 1e-10, 1.96e-10, 1e-9)


def grid_search(pings: DataFrame, measurements: tuple[float, ...] = MEASUREMENTS, accelerations: tuple[float, ...] = ACCELERATIONS, time: str = "ep", least: int = 5) -> DataFrame:
    """One row for each pair of parameters: mean and spread of the shift, by how much steps shorten (%), and the spread of acceleration; vehicles with few pings don't count.

    Pings are sorted once and smoothed in one pass for all pairs.
    """
    counted = pings.groupBy("vehicle").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    pairs = [(r, a) for r in measurements for a in accelerations]
    tried = smooth_grid(pings.join(counted, "vehicle", "left_semi"), pairs, time)
    w = Window.partitionBy("vehicle").orderBy(time, "event_id")
    tried = tried.withColumns({f"last_{c}": F.lag(c).over(w) for c in (time, "x", "y", "fx", "fy", "fs")})
    each = tried.select("*", F.posexplode(F.array(*(F.struct(F.lit(r).alias("measurement"), F.lit(a).alias("acceleration")) for r, a in pairs))).alias("i", "p"))
    at = lambda c: F.get(c, F.col("i"))
    dt = F.col(time) - F.col(f"last_{time}")
    each = each.select(
        "p.*", (1000 * haversine_km(F.col("y"), F.col("x"), at("fy"), at("fx"))).alias("shift"), (1000 * haversine_km(F.col("last_y"), F.col("last_x"), F.col("y"), F.col("x"))).alias("raw"),
        (1000 * haversine_km(at("last_fy"), at("last_fx"), at("fy"), at("fx"))).alias("filtered"), F.when(dt > 0, (at("fs") - at("last_fs")) / 3.6 / dt).alias("acc"),
    )
    out = each.groupBy("measurement", "acceleration").agg(
        F.avg("shift").alias("mean_shift_m"), F.stddev_samp("shift").alias("std_shift_m"), F.avg("raw").alias("raw"), F.avg("filtered").alias("filtered"), F.stddev_samp("acc").alias("acceleration_std")
    )
    reduction = F.when(F.col("raw") > 0, 100 * (F.col("raw") - F.col("filtered")) / F.col("raw")).otherwise(0.0)
    return out.select("measurement", "acceleration", "mean_shift_m", "std_shift_m", reduction.alias("path_reduction"), "acceleration_std")
