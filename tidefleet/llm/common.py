"""What the text operators share: table reading, shared-folder tables, tokenizer files."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, by the path that the caller was given."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one of this machine, which only a local master can use; else an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = _local_dir()
    return where.rstrip("/")


@functools.cache
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="tidefleet-")


_made: list[str] = []  # folders that this process has made in the shared folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Folders that operators make inside are deleted at the end: what was computed from them must have been written by then."""
    at = len(_made)
    try:
        yield
    finally:
        for path in _made[at:]:
            delete(spark, path)
        del _made[at:]


class SharedTables:
    """Tables written to the shared folder to cut lineage; those that nothing needs any more can be dropped early."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, new_folder(spark, "tables")
        self.count = 0

    def keep(self, df: DataFrame, few: bool = False) -> DataFrame:
        """The rows of df, read back from a table of their own; few rows of many tasks are gathered into a file a core first."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        (df.repartition(self.spark.sparkContext.defaultParallelism) if few else df).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._shared_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        delete(self.spark, df._shared_path)


def as_row(df: DataFrame) -> DataFrame:
    """df as one struct column, row: its own names can't clash with those that an operator adds beside it."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. lower() does just that where every character is one byte long."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def crc32_text(doc_id: Column) -> Column:
    """crc32 of an id's decimal text, by which rows are held out."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def label_of_ids(labels: DataFrame, label: str) -> DataFrame:
    """(id, label) of all labelled ids; of several labels of one id the least counts."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min(F.col(label).cast("int")).alias(label))


def labelled_ids(labels: DataFrame, label: str, k: int) -> DataFrame:
    """label_of_ids() of k ids at most, chosen by their hashes."""
    return bottom_k(label_of_ids(labels, label), "id", k)


def once_an_id(rows: DataFrame) -> DataFrame:
    """rows without their column id, one for each id: the least by its columns in their order."""
    return rows.groupBy("id").agg(F.min(F.struct(*(c for c in rows.columns if c != "id"))).alias("one")).select("one.*")


def bottom_k(ids: DataFrame, key: str, k: int) -> DataFrame:
    """k rows at most, chosen by the hash of their key: the same ones in every run and in any partitioning."""
    return ids.orderBy(F.xxhash64(key), key).limit(k)


#: Rows in the Arrow batches of texts that tasks and their Python workers hold: Spark's own 10 000 whole texts would take tens of MB several times over.
BATCH_ROWS = 2000


def small_batches(rows: DataFrame) -> DataFrame:
    """rows, whose session makes Arrow batches of BATCH_ROWS rows at most from now on; a smaller setting stays."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return rows


def slices(batch: pa.RecordBatch, column: str, rows: int = 1000, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of so many rows at most, and of so many bytes of a column's text unless one row has more: what a worker holds as Python objects at once."""
    sizes = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most_bytes, "right"))
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def spread(listed: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of listed, from first on and of given sizes, one after another."""
    ends = np.cumsum(sizes)
    return listed[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Remembered(dict):
    """A worker's cache of two generations: when the younger is full it becomes the older, whose entries live on where they are asked for again."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def __missing__(self, key):
        self[key] = value = self.older[key]
        return value

    def has(self, key) -> bool:
        return key in self or key in self.older

    def age(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


def text_key(text: Column) -> dict[str, Column]:
    """128 bits by which whole texts are told apart; null is the empty text."""
    whole = F.coalesce(text, F.lit(""))
    return {"h1": F.xxhash64(whole), "h2": F.xxhash64(F.lit(1), whole)}


#: Groups with more than one of so many rows each are fewer than that: a broadcast of them is bounded, whatever the table.
HOT_GROUPS = 1024


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows joined with their groups, a row each: those of hot groups where they are, by a broadcast of HOT_GROUPS groups at most, others by a shuffle in which no key has more than total / HOT_GROUPS rows. Both are read twice, so they had better be tables."""
    hot = F.col(size) > total / HOT_GROUPS
    large = F.broadcast(groups.filter(hot))
    rest = rows.join(F.broadcast(groups.filter(hot).select(*keys)), keys, "left_anti")
    return rows.join(large, keys).unionByName(rest.join(groups.filter(~hot), keys))


def ranked(rows: DataFrame, tables: SharedTables, *order: Column) -> DataFrame:
    """rows with rank (1, 2, 3, ...) in an order over all of them: sorted by ranges, numbered in each, and moved on by the counts of the ranges before.

    rows must be a table, as ranges are drawn from it. A window without
    partitions would sort everything in one task.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ordered = tables.keep(ordered)
    counts = ordered.groupBy(F.shiftright("__at", 33).alias("__part")).agg(F.count("*").alias("n")).collect()  # a row a range
    before, sizes = 0, []
    for r in sorted(counts, key=lambda r: r["__part"]):
        sizes.append((r["__part"], before))
        before += r["n"]
    starts = F.broadcast(spark.createDataFrame(sizes, "__part long, __before long"))
    local = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(starts, F.shiftright("__at", 33) == F.col("__part")).withColumn("rank", F.col("__before") + local + 1).drop("__at", "__part", "__before")
