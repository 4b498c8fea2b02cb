"""Cleaning and enrichment of pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.functions.pings import day_type, flag, is_peak, local_time, speed_level
from tidefleet.session import LOCAL_TZ


def parse_envelopes(raw: DataFrame, schema, message_type: str, kind: str = "msgType", body: str = "msgBusWayPoint") -> DataFrame:
    """JSON values to flat rows: one message type is kept, malformed values are dropped with the others."""
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("d")).select("d.*")
    return parsed.filter(F.col(kind) == message_type).select(f"{body}.*")


def normalise(pings: DataFrame) -> DataFrame:
    """Event time and date from epoch seconds in column datetime, and the time of loading."""
    ts = F.timestamp_seconds("datetime")
    return pings.withColumn("timestamp", ts).withColumn("date", F.to_date(ts)).withColumn("load_at", F.current_timestamp())


def valid_gps(pings: DataFrame, max_speed_kmh: float | None = None) -> DataFrame:
    """Pings with a vehicle, a time and coordinates other than zero; optionally up to a speed."""
    ok = F.col("vehicle").isNotNull() & F.col("timestamp").isNotNull() & (F.col("x") != 0) & (F.col("y") != 0)
    return pings.filter(ok if max_speed_kmh is None else ok & (F.coalesce("speed", F.lit(0.0)) <= max_speed_kmh))


def one_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order, so that the choice doesn't depend on partitions."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def enrich(pings: DataFrame, mapping: DataFrame, how: str = "left") -> DataFrame:
    """Each ping's route by its vehicle. Several routes of one vehicle would multiply rows, so the lowest counts."""
    unique = mapping.filter("vehicle is not null").groupBy("vehicle").agg(F.min(F.struct(*(c for c in mapping.columns if c != "vehicle"))).alias("__m")).select("vehicle", "__m.*")
    return pings.join(unique, "vehicle", how)


def override_routes(pings: DataFrame, mapping: DataFrame) -> DataFrame:
    """pings with the mapping's route_id where their vehicle has one, else their own; of several routes of a vehicle the lowest."""
    known = mapping.filter("vehicle is not null").groupBy("vehicle").agg(F.min("route_id").alias("__mapped"))
    return pings.join(known, "vehicle", "left").withColumn("route_id", F.coalesce("__mapped", "route_id")).drop("__mapped")


def local_columns(pings: DataFrame, zone: str = LOCAL_TZ) -> DataFrame:
    """date and hour in a zone."""
    t = local_time(F.col("timestamp"), zone)
    return pings.withColumn("date", t.cast("date")).withColumn("hour", F.hour(t).cast("long"))


def speed_features(pings: DataFrame) -> DataFrame:
    """Speed class, movement flags, kind of day and rush hour of each ping."""
    return pings.withColumns({
        "speed_level": speed_level(F.col("speed")), "is_moving": flag(F.col("speed") > 0), "is_stopped": flag(F.col("speed") == 0),
        "day_type": day_type(F.col("date")), "is_peak_hour": is_peak(F.col("hour")),
    })


def to_silver(pings: DataFrame, mapping: DataFrame, order: Column, how: str = "left", zone: str = LOCAL_TZ, smooth_by: str | None = None) -> DataFrame:
    """One valid ping per vehicle and time, with its route and local date; places smoothed along the column smooth_by, if given; sorted inside partitions for the writer."""
    kept = one_per_key(valid_gps(enrich(pings, mapping, how)), ["vehicle", "timestamp"], order)
    if smooth_by:
        from tidefleet.operators.kalman import smooth

        kept = smooth(kept, smooth_by)
    return silver_order(local_columns(kept, zone))


def silver_order(rows: DataFrame) -> DataFrame:
    """Rows sorted inside partitions, so that files skip by route, vehicle and time."""
    return rows.sortWithinPartitions(F.asc_nulls_first("route_id"), F.asc_nulls_first("vehicle"), F.asc_nulls_first("timestamp"))
