"""Batch and streaming readers of telemetry and route dimensions."""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schemas, fixed by the formats of messages and files.
PING = (
    "vehicle string, driver string, speed float, datetime int, x double, y double, z float, heading float, ignition boolean, aircon boolean, door_up boolean, door_down boolean, sos boolean, working boolean, analog1 float, analog2 float"
)
ENVELOPE = f"msgType string, msgBusWayPoint struct<{PING}>"
MAPPING = "vehicle string, route_id int, route_no string"
ROUTE_PATH = "RouteId int, RouteNo string, RouteVarId int, RouteVarName string, Outbound boolean, lat array<double>, lng array<double>"
ROUTE_INFO = "RouteId int, RouteNo string, Vars array<struct<RouteVarId:int,RouteVarName:string,Outbound:boolean,Distance:double,RunningTime:int,StartStop:string,EndStop:string>>"
ROUTE_STOP = (
    "RouteId int, RouteVarId int, StopId int, Code string, Name string, StopType string, Zone string, Ward string, AddressNo string, Street string, Lng double, Lat double, Routes string, Outbound boolean"
)
PING_MESSAGE = "MsgType_BusWayPoint"


def kafka_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source: lost data is tolerated, a rate limit is optional."""
    limit = {"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {}
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "false"} | limit


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = None, with_time: bool = False) -> DataFrame:
    """value (and the broker's timestamp) of a Kafka topic; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, per_trigger)).load()
    return stream.select("value", *(["timestamp"] if with_time else []))


def protobuf(raw: DataFrame, message: str, descriptor: str) -> DataFrame:
    """Binary values to structs; needs the protobuf connector on the class path."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return raw.select(from_protobuf("value", message, descFilePath=descriptor).alias("d")).select("d.*")


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder as a stream of what is appended to it."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


#: Rows that a task sorts and writes into one file of a replay.
ROWS_A_FILE = 500_000


def replay(rows: DataFrame, path: str, parts: int, *order: str) -> int:
    """Rows in so many parts by their order, oldest first; how many files each takes: a stream that reads as many a trigger sees a part a batch, as they came, and goes on from its checkpoint."""
    if parts == 1:
        return replay_parts([rows], path, *order)
    by = F.col(order[0])
    ends = rows.agg(F.percentile_approx(by, [i / parts for i in range(1, parts)], 10_000).alias("ends")).collect()[0]["ends"] or []
    ends = [F.lit(e).cast(rows.schema[order[0]].dataType) for e in ends]
    first = [by.isNull() | (by <= e) for e in ends[:1]]
    middle = [(by > a) & (by <= e) for a, e in zip(ends, ends[1:], strict=False)]
    return replay_parts([rows.filter(c) for c in (*first, *middle, *(by > e for e in ends[-1:]))] or [rows], path, *order)


def replay_parts(parts: list[DataFrame], path: str, *order: str) -> int:
    """Parts written one after the other, as a stream reads files by their times, each in as many files as the largest needs; how many those are."""
    files = max(1, math.ceil(max(p.count() for p in parts) / ROWS_A_FILE))
    for part in parts:
        part.repartition(files).sortWithinPartitions(*order).write.mode("append").parquet(path)
        time.sleep(0.05)
    return files


def multiline_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A document of one JSON array, over several lines; without a schema it is inferred."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MAPPING).option("header", True).csv(path).dropna(subset=["vehicle"])


def route_variants(info: DataFrame) -> DataFrame:
    """One row per route and variant of ROUTE_INFO rows."""
    v = info.select("RouteId", "RouteNo", F.explode("Vars").alias("v"))
    direction = F.when(F.col("v.Outbound"), "Outbound").otherwise("Inbound")
    return v.select(
        F.col("RouteId").alias("route_id"), F.col("RouteNo").alias("route_no"), F.col("v.RouteVarId").alias("route_var_id"), F.col("v.RouteVarName").alias("route_var_name"), F.col("v.Outbound").alias("outbound"), direction.alias("direction"),
        F.col("v.Distance").alias("distance"), F.col("v.RunningTime").alias("running_time"), F.col("v.StartStop").alias("start_stop"), F.col("v.EndStop").alias("end_stop"),
    )


#: The terminal that the paths of one route lack, by its variants: outbound begins there, inbound ends there.
MISSING_TERMINAL, MISSING_ROUTE, OUTWARD, HOMEWARD = [106.6983, 10.7716], 1, 1, 2


def stop_dimension(stops: DataFrame) -> DataFrame:
    """ROUTE_STOP rows as the stop dimension; of rows of one route, variant and stop the least stays."""
    names = {
        "RouteId": ("route_id", "int"), "RouteVarId": ("route_var_id", "int"), "StopId": ("stop_id", "int"), "Code": ("code", "string"), "Name": ("stop_name", "string"), "StopType": ("stop_type", "string"), "Zone": ("zone", "string"),
        "Ward": ("ward", "string"), "AddressNo": ("address_no", "string"), "Street": ("street", "string"), "Lng": ("lng", "double"), "Lat": ("lat", "double"), "Routes": ("routes", "string"),
    }
    clean = stops.select(*(F.col(old).cast(kind).alias(new) for old, (new, kind) in names.items()))
    return one_of_each(clean, "route_id", "route_var_id", "stop_id")


def path_dimension(paths: DataFrame) -> DataFrame:
    """ROUTE_PATH rows with their paths as the path dimension, one route's missing terminal put in; one row for each route, variant and direction."""
    zipped = F.coalesce(F.transform(F.arrays_zip("lng", "lat"), lambda p: F.array(p["lng"], p["lat"])), F.array().cast("array<array<double>>"))
    clean = paths.select(F.col("RouteId").alias("route_id"), F.col("RouteNo").alias("route_no"), F.col("RouteVarId").alias("route_var_id"), F.col("RouteVarName").alias("route_var_name"), F.col("Outbound").alias("outbound"), zipped.alias("path"))
    end = F.array(F.array(*map(F.lit, MISSING_TERMINAL)))
    own, size = F.col("route_id") == MISSING_ROUTE, F.size("path")
    rest = F.greatest(size - 1, F.lit(0))
    patched = F.when(own & (F.col("route_var_id") == OUTWARD), F.concat(end, F.slice("path", 2, F.greatest(size, F.lit(1))))).when(own & (F.col("route_var_id") == HOMEWARD), F.concat(F.slice("path", F.lit(1), rest), end))
    return one_of_each(clean.withColumn("path", F.coalesce(patched, "path")), "route_id", "route_var_id", "outbound")


def variant_dimension(info: DataFrame) -> DataFrame:
    """ROUTE_INFO rows as the variant dimension: a row for each route and variant."""
    return one_of_each(route_variants(info), "route_id", "route_var_id")


def one_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: the least by its other columns in their order."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("one")).select(*keys, "one.*").select(*rows.columns)


def route_paths(paths: DataFrame) -> DataFrame:
    """lat[] and lng[] of ROUTE_PATH rows zipped to path: an array of [lng, lat]; empty for empty or missing arrays."""
    zipped = F.transform(F.arrays_zip("lng", "lat"), lambda p: F.array(p["lng"], p["lat"]))
    return paths.select(F.col("RouteId").alias("route_id"), F.col("RouteVarId").alias("route_var_id"), F.col("Outbound").alias("outbound"), F.coalesce(zipped, F.array().cast("array<array<double>>")).alias("path"))


def patch_path(paths: DataFrame, route_id: int, insert: list[list[float]], after: int) -> DataFrame:
    """Points put into one route's path after a place; other paths stay."""
    points = F.array(*(F.array(*map(F.lit, p)) for p in insert))
    head, tail = F.slice("path", 1, after), F.slice("path", after + 1, F.greatest(F.size("path"), F.lit(1)))
    return paths.withColumn("path", F.when(F.col("route_id") == route_id, F.concat(head, points, tail)).otherwise(F.col("path")))
