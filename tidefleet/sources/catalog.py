"""Catalog tables: creation, from a schema or a query, views, and removal with all files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{name}`")


def create_table(spark: SparkSession, name: str, columns: str, location: str, partitions: tuple[str, ...] = (), properties: dict[str, str] | None = None) -> None:
    """An empty Parquet table with a schema, in folders by some columns, with table properties; one that is there stays as it is."""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    more = f" TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in properties.items())})" if properties else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION '{location}'{more}")


def create_as_select(spark: SparkSession, name: str, select: str, location: str, partitions: tuple[str, ...] = ()) -> None:
    """A Parquet table of a query's rows, in folders by some columns."""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {name} USING parquet{by} LOCATION '{location}' AS {select}")


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_table(spark: SparkSession, name: str, *folders: str) -> None:
    """Drop a table, and delete folders such as its location and its streams' checkpoints: everything starts anew."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
