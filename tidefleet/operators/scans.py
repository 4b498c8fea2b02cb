"""Running values along each key's rows in order, also where one key holds a large part of all rows.

A window puts all rows of a key into one task. Here the keys that would be too
large for one are dealt out in blocks of time. Each block is scanned on its own,
what it hands on to the next ones is kept in a small table, and each row adds
what its block was handed: two passes, the second with one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks for each partition of a shuffle, so that hashing spreads them evenly.
BLOCKS_A_PARTITION = 4
#: A key of fewer rows is no burden on one task and stays whole.
LEAST_ROWS = 10_000
BLOCK = "__block"


def parts_of(rows: DataFrame) -> int:
    return BLOCKS_A_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocks(rows: DataFrame, keys: list[str], time: str, parts: int | None = None) -> DataFrame | None:
    """(keys, low, high, block): blocks of time of the keys that hold more than one in parts of all rows, and LEAST_ROWS at least; None if there are no such keys.

    There are fewer than parts such keys, and at most twice parts blocks in all,
    so that the table is small whatever rows holds. Bounds are approximate
    quantiles of the time as a number; rows of one key and time stay together.
    """
    parts = parts or parts_of(rows)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    most, total = counts.agg(F.max("__n"), F.sum("__n")).collect()[0]
    if (most or 0) < LEAST_ROWS or most * parts <= total:
        return None
    hot = [r.asDict() for r in counts.filter((F.col("__n") * parts > total) & (F.col("__n") >= LEAST_ROWS)).collect()]  # fewer than parts
    large = F.broadcast(rows.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], rows.select(*keys).schema))
    quantiles = F.percentile_approx(number(time), [i / parts for i in range(1, parts)], 20 * parts).alias("__q")
    found = _with(rows.select(*keys, time), large, keys).groupBy(*keys).agg(quantiles).collect()
    size = {tuple(r[k] for k in keys): r["__n"] for r in hot}
    listed = []
    for r in found:
        key = tuple(r[k] for k in keys)
        pieces = -(-size[key] * parts // total)
        bounds = sorted({r["__q"][i * parts // pieces - 1] for i in range(1, pieces)})
        listed += [(*key, low, high, i) for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None], strict=True))]
    columns = ", ".join(f"`{k}` {dict(rows.dtypes)[k]}" for k in keys)
    return rows.sparkSession.createDataFrame(listed, f"{columns}, low double, high double, block int")


def number(time: str) -> Column:
    """A time as a number; null comes first."""
    return F.coalesce(F.col(time).cast("double"), F.lit(float("-inf")))


def _with(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", *more: Column) -> DataFrame:
    """rows joined with a small table by keys, of which null equals null; the small table's keys are dropped."""
    named = few.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys))
    return rows.join(F.broadcast(named), reduce(lambda a, b: a & b, more, same), how).drop(*(f"__k_{k}" for k in keys))


def dealt(rows: DataFrame, found: DataFrame, keys: list[str], time: str) -> DataFrame:
    """rows with the block that each lies in, null for keys without blocks."""
    here = (F.col("__low").isNull() | (number(time) >= F.col("__low"))) & (F.col("__high").isNull() | (number(time) < F.col("__high")))
    return _with(rows, found.withColumnsRenamed({"low": "__low", "high": "__high", "block": BLOCK}), keys, "left", here).drop("__low", "__high")


@dataclass(frozen=True)
class Running:
    """A value along a key's rows: what a block hands on, how that is gathered over the blocks before, and the row's own value with it."""

    kind: str
    column: str


def lag(column: str) -> Running:
    """The row before's value, null for a key's first row."""
    return Running("lag", column)


def total(column: str) -> Running:
    """The sum up to the row, itself included; nulls count nothing, and before any other value there's none."""
    return Running("total", column)


def last(column: str) -> Running:
    """The last value that isn't null up to the row, itself included."""
    return Running("last", column)


@dataclass(frozen=True)
class Tracks:
    """The rows of each key in an order, whose first column is a time (a number) and whose last makes it total."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    hot: bool

    @classmethod
    def of(cls, rows: DataFrame, keys: list[str], *order: str, parts: int | None = None, counted: DataFrame | None = None) -> Tracks:
        """counted is a table that costs less to count keys and times in, if there is one; else rows are counted."""
        found = blocks(rows if counted is None else counted, keys, order[0], parts)
        return cls(rows if found is None else dealt(rows, found, keys, order[0]), keys, list(order), found is not None)

    def add(self, **columns: Column) -> Tracks:
        return replace(self, rows=self.rows.withColumns(columns))

    def scan(self, **running: Running) -> Tracks:
        """With a column for each running value."""
        inside = Window.partitionBy(*self.keys, *([BLOCK] if self.hot else [])).orderBy(*self.order)
        upto = inside.rowsBetween(Window.unboundedPreceding, 0)
        own = {n: {"lag": lambda c: F.lag(c).over(inside), "total": lambda c: F.sum(c).over(upto), "last": lambda c: F.last(c, ignorenulls=True).over(upto)}[r.kind](r.column) for n, r in running.items()}
        if not self.hot:
            return self.add(**own)
        order = F.struct(*self.order)
        handed = {"lag": lambda c: F.max_by(c, order), "total": F.sum, "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order))}
        per = self.rows.filter(F.col(BLOCK).isNotNull()).groupBy(*self.keys, BLOCK).agg(*(handed[r.kind](r.column).alias(f"__c_{n}") for n, r in running.items()))
        along = Window.partitionBy(*self.keys).orderBy(BLOCK)
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        gathered = {"lag": lambda c: F.lag(c).over(along), "total": lambda c: F.sum(c).over(before), "last": lambda c: F.last(c, ignorenulls=True).over(before)}
        carried = per.select(*self.keys, F.col(BLOCK).alias("__carried"), *(gathered[r.kind](f"__c_{n}").alias(f"__b_{n}") for n, r in running.items()))
        rows = self.rows.withColumns(own | {"__nth": F.row_number().over(inside)})
        rows = _with(rows, carried, self.keys, "left", F.col(BLOCK) == F.col("__carried"))
        whole = {
            "lag": lambda n: F.when(F.col("__nth") == 1, F.col(f"__b_{n}")).otherwise(F.col(n)),
            "total": lambda n: F.when(F.col(n).isNull(), F.col(f"__b_{n}")).otherwise(F.col(n) + F.coalesce(f"__b_{n}", F.lit(0))),
            "last": lambda n: F.coalesce(n, f"__b_{n}"),
        }
        rows = rows.withColumns({n: whole[r.kind](n) for n, r in running.items()})
        return replace(self, rows=rows.drop("__nth", "__carried", *(f"__b_{n}" for n in running)))

    def plain(self) -> DataFrame:
        """The rows without the block."""
        return self.rows.drop(BLOCK)
