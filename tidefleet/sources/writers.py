"""Writers over plain Parquet folders: append, overwrite, whole partitions, buckets. Merges, deletes and repeated batches are those of published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("append").partitionBy(*partitions).parquet(path)


def overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace the partitions that df has rows for; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> bool:
    """Delete the rows of one partition, by its folder alone; whether there was one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int = 50) -> None:
    """Parquet in folders by the hash of a key, one file a bucket."""
    bucketed = df.withColumn(f"{key}_bucket", F.pmod(F.hash(key), F.lit(buckets)))
    overwrite(bucketed.repartition(buckets, f"{key}_bucket"), path, f"{key}_bucket")


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], order: list[str], buckets: int = 50) -> None:
    """A table of the catalog whose files are hashed into buckets by keys, each sorted by keys and order: joins and groupings by the keys with a table of as many buckets need no shuffle. Each bucket is one file, as its rows are gathered first."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, *order)
    writer.saveAsTable(name)


def write_json_document(df: DataFrame, path: str) -> None:
    """A small table as JSON lines in one file, replaced as a whole."""
    df.coalesce(1).write.mode("overwrite").json(path)


def by_type(batch: DataFrame, column: str, targets: dict[str, str], explode: dict[str, str] | None = None, folder: str = "") -> None:
    """Rows of one batch to the table of their type; the batch is computed once, empty types write nothing.

    explode names, for some types, an array column of structs of which each
    becomes a row. With folder, rows replace that folder of each table, so that a
    batch that is repeated on a stream is there once.
    """
    batch.persist()
    try:
        for kind, path in targets.items():
            some = batch.filter(F.col(column) == kind)
            if some.isEmpty():
                continue
            if array := (explode or {}).get(kind):
                some = some.select(column, F.explode(array).alias("e")).select(column, "e.*")
            if folder:
                overwrite(some, f"{path}/{folder}")
            else:
                append(some, path)
    finally:
        batch.unpersist()
