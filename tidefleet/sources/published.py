"""Parquet tables of which readers see what the newest record names.

A write puts its files into a folder of its own, lists them with their rows,
bytes and range of keys, and last of all writes a small record. Until that is
there nobody sees anything of it, so that a write that stops anywhere leaves the
table as it was and can be repeated. A record also says which batches of which
streaming queries it holds; a batch that is repeated changes nothing. Merges and
deletes rewrite only the files that hold a row they touch.

One writer at a time. Files that no recent record names are removed by vacuum().
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Listings that a record may name before they are put together into one.
LISTINGS = 16
#: Keys of a change that a broadcast may hold when ranges of files are looked through.
BROADCAST_KEYS = 10_000


class Published:
    """The table at path, in folders by the partition columns of its first write. key is the column whose range in each file is listed; the first key of merges serves best."""

    def __init__(self, spark: SparkSession, path: str, key: str | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- records

    def _at(self, *parts: str) -> str:
        return "/".join((self.path, *parts))

    def versions(self) -> list[int]:
        folder = self._hadoop.Path(self._at("_records"))
        found = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in found if f.getPath().getName().endswith(".json"))

    def record(self, version: int | None = None) -> dict | None:
        """The newest record, or that of a version; None before the first write."""
        known = self.versions()
        if not known:
            return None
        return json.loads(self.spark.read.text(self._at("_records", f"{known[-1] if version is None else version:012d}.json"), wholetext=True).collect()[0][0])

    def holds(self, source: tuple[str, int] | None) -> bool:
        """Whether a batch of a query is in the table."""
        record = self.record()
        return bool(source and record) and record["seen"].get(source[0], -1) >= source[1]

    def listing(self, record: dict | None = None) -> DataFrame | None:
        """(file, rows, bytes, low, high) of the table's files."""
        record = record or self.record()
        if not record or not record["listings"]:
            return None
        return self.spark.read.parquet(*(self._at("_listings", x) for x in record["listings"]))

    def read(self, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
        """The table's rows, as of the newest record or of a version that is kept; schema is needed as long as it has no files."""
        record = self.record(version)
        listing = self.listing(record) if record else None
        return self._rows([] if listing is None else [r[0] for r in listing.select("file").collect()], schema or (record and T.StructType.fromJson(record["schema"])))

    def _rows(self, files: list[str], schema: T.StructType | None) -> DataFrame:
        """Rows of some files; Spark's reader too holds their names on the driver."""
        if not files:
            if schema is None:
                raise ValueError(f"nothing has been written to {self.path}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("write", T.StringType())]))
        return reader.parquet(*files).drop("write")

    def summary(self) -> DataFrame:
        """(folder, files, rows, bytes, smallest, largest, low, high) of each partition folder, from the listing alone: no file of the table is opened. low and high are the key's."""
        listing = self.listing()
        if listing is None:
            raise ValueError(f"nothing has been written to {self.path}")
        return listing.groupBy(F.regexp_extract("file", "write=[^/]+/(?:(.*)/)?[^/]+$", 1).alias("folder")).agg(
            F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("smallest"), F.max("bytes").alias("largest"), F.min("low").alias("low"), F.max("high").alias("high")
        )

    def partition_rows(self, column: str) -> DataFrame:
        """(column, rows): the rows of each value of a partition column, from the listing alone."""
        value = F.url_decode(F.replace(F.regexp_extract("folder", f"(?:^|/){column}=([^/]*)", 1), F.lit("+"), F.lit("%2B")))
        kind = T.StructType.fromJson(self.record()["schema"])[column].dataType
        value = F.when(value != "__HIVE_DEFAULT_PARTITION__", value).cast(kind)
        return self.summary().groupBy(value.alias(column)).agg(F.sum("rows").alias("rows"))

    # ---- writes

    def append(self, rows: DataFrame, *partitions: str, source: tuple[str, int] | None = None) -> bool:
        """Add rows; False if the batch is there already."""
        return self._publish(rows, partitions, source)

    def replace(self, rows: DataFrame, *partitions: str, source: tuple[str, int] | None = None) -> bool:
        """Put rows, which may come from the table itself, in place of all that is there."""
        return self._publish(rows, partitions, source, keep=lambda files: files.limit(0))

    def upsert(self, rows: DataFrame, keys: list[str], *partitions: str, source: tuple[str, int] | None = None, nulls_match: bool = False) -> bool:
        """rows replace those of their keys; files without such rows stay as they are. A null matches nothing, or another null. Repeated keys in rows are an error."""
        if self.holds(source):
            return False
        known = rows if nulls_match else rows.dropna(subset=keys)
        if known.groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError("several rows of one key")
        files = self._touched(rows.select(*keys), keys, nulls_match)
        if not files:
            return self._publish(rows, partitions, source)
        old = self.rows_of(files)
        kept = old.join(rows.select(*keys).withColumnsRenamed(_named(keys)), _same(keys, nulls_match), "left_anti")
        return self._publish(kept.unionByName(rows), partitions, source, gone=files)

    def delete(self, condition: str) -> int:
        """Rows go for which condition is true; how many files were rewritten."""
        listing = self.listing()
        known = [] if listing is None else [r[0] for r in listing.select("file").collect()]
        if not known:
            return 0
        files = [r[0] for r in self.rows_of(known).filter(condition).select(file_name()).distinct().collect()]
        if files:
            self._publish(self.rows_of(files).filter(~F.coalesce(F.expr(condition), F.lit(False))), (), None, gone=files)
        return len(files)

    def rewrite(self, rows: DataFrame, gone: list[str]) -> None:
        """rows in place of some files, whose rows they are in another layout."""
        self._publish(rows, (), None, gone=gone)

    def rows_of(self, files: list[str]) -> DataFrame:
        """The rows of some of the table's files, with their _metadata."""
        return self._rows(files, T.StructType.fromJson(self.record()["schema"]))

    def _touched(self, changed: DataFrame, keys: list[str], nulls_match: bool) -> list[str]:
        """Files with a row of a changed key: those whose range can hold one are looked through, by their key columns only."""
        listing = self.listing()
        if listing is None:
            return []
        first = keys[0]
        if self.key == first and not nulls_match:
            few = changed.select(F.col(first).alias("__key")).distinct().limit(BROADCAST_KEYS + 1)
            if few.count() <= BROADCAST_KEYS:
                listing = listing.join(F.broadcast(few), F.col("__key").between(F.col("low"), F.col("high")), "left_semi")
            else:
                low, high = changed.agg(F.min(first), F.max(first)).collect()[0]
                listing = listing.filter((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high)))
        files = [r[0] for r in listing.select("file").collect()]
        if not files:
            return []
        rows = self.rows_of(files).select(*keys, file_name())
        return [r[0] for r in rows.join(changed.withColumnsRenamed(_named(keys)), _same(keys, nulls_match), "left_semi").select("file").distinct().collect()]

    def _publish(self, rows: DataFrame, partitions: tuple[str, ...], source: tuple[str, int] | None, gone: list[str] | None = None, keep=None) -> bool:
        record = self.record()
        if self.holds(source):
            return False
        name = uuid.uuid4().hex
        partitions = record["partitions"] if record else list(partitions)
        rows.write.partitionBy(*partitions).parquet(self._at(f"write={name}"))
        new = self._listed(name, rows.schema)
        listings = list(record["listings"]) if record else []
        old = self.listing(record) if record else None
        if keep:
            listings = []
        elif old is not None and (gone or len(listings) >= LISTINGS):
            out = self.spark.createDataFrame([(f,) for f in gone or []], "file string")
            old.join(out, "file", "left_anti").unionByName(new).write.parquet(self._at("_listings", name))
            listings, new = [name], None
        if new is not None:
            new.write.parquet(self._at("_listings", name))
            listings.append(name)
        seen = dict(record["seen"]) if record else {}
        if source:
            seen[source[0]] = source[1]
        version = record["version"] + 1 if record else 0
        self._write_record(version, {"version": version, "seen": seen, "listings": listings, "partitions": partitions, "schema": rows.schema.jsonValue()})
        return True

    def _listed(self, name: str, schema: T.StructType) -> DataFrame:
        """The files of one write; (low, high) is the range of the key, null without one."""
        written = self.spark.read.schema(schema).option("basePath", self.path).parquet(self._at(f"write={name}"))
        key = F.col(self.key) if self.key else F.lit(None).cast("string")
        per = written.select(file_name(), F.col("_metadata.file_size").alias("bytes"), key.alias("__key"))
        return per.groupBy("file").agg(F.count("*").alias("rows"), F.first("bytes").alias("bytes"), F.min("__key").alias("low"), F.max("__key").alias("high"))

    def _write_record(self, version: int, record: dict) -> None:
        """Under another name first: a record is there as a whole or not at all."""
        target, aside = (self._hadoop.Path(self._at("_records", x)) for x in (f"{version:012d}.json", f"{uuid.uuid4().hex}.new"))
        out = self._fs.create(aside)
        out.write(json.dumps(record).encode())
        out.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            raise OSError(f"version {version} of {self.path} was written by another")

    def vacuum(self, keep: int = 3) -> int:
        """Remove records but the newest, and what none of those names; how many folders of writes, files and listings went. Not while a write is under way."""
        known = self.versions()
        kept = [self.record(v) for v in known[-keep:]]
        named = {x for r in kept for x in r["listings"]}
        files = [r[0] for r in self.spark.read.parquet(*(self._at("_listings", x) for x in sorted(named))).select("file").distinct().collect()] if named else []
        files = {self._hadoop.Path(f).toUri().getPath() for f in files}
        gone = 0
        for v in known[:-keep]:
            self._fs.delete(self._hadoop.Path(self._at("_records", f"{v:012d}.json")), False)
        listings = self._hadoop.Path(self._at("_listings"))
        for f in self._fs.listStatus(listings) if self._fs.exists(listings) else []:
            if f.getPath().getName() not in named:
                gone += self._fs.delete(f.getPath(), True)
        each = self._fs.listFiles(self._hadoop.Path(self.path), True)
        while each.hasNext():
            f = each.next().getPath()
            if "/write=" in (at := f.toUri().getPath()) and at not in files and f.getName()[0] not in "_.":
                gone += self._fs.delete(f, False)
        return gone


def file_name() -> Column:
    """A row's file by its plain name; _metadata has it escaped as in a URL."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file")


def _named(keys: list[str]) -> dict[str, str]:
    return {k: f"__k_{k}" for k in keys}


def _same(keys: list[str], nulls_match: bool) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(k).eqNullSafe(F.col(f"__k_{k}")) if nulls_match else F.col(k) == F.col(f"__k_{k}"))
    return out


def batch_of(batch: DataFrame, number: int) -> tuple[str, int]:
    """The streaming query that a batch comes from, and its number; outside a query the name is empty."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "", number
