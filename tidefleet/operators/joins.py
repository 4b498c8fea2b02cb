"""Joins that Spark has no operator for, made of those that it has."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def triangular(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, l, r): pairs of rows of one key whose order values ascend; an equi-join with a residual."""
    a, b = rows.select(key, F.col(order).alias("l")), rows.select(key, F.col(order).alias("r"))
    return a.join(b, key).filter("l < r")


def last_known_before(rows: DataFrame, known: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """rows with the values of the last row of known at or before their time, by key; null if there is none.

    Both sides are stacked, sorted by key and time and filled forward: one shuffle
    of each, no range join. known has one row per key and time.
    """
    mine = rows.withColumn("__known", F.lit(0))
    for v in values:
        mine = mine.withColumn(v, F.lit(None).cast(known.schema[v].dataType))
    theirs = known.select(*keys, time, *values).withColumn("__known", F.lit(1)).withColumn("__seen", F.struct(*values))
    both = mine.withColumn("__seen", F.lit(None).cast(theirs.schema["__seen"].dataType)).unionByName(theirs, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(time, F.desc("__known")).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("__last", F.last("__seen", ignorenulls=True).over(w)).filter("__known = 0")
    return filled.select(*(c for c in rows.columns), *(F.col("__last")[v].alias(v) for v in values))
