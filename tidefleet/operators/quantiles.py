"""Exact quantiles of groups of any size.

An exact percentile holds every different value of a group in one buffer. That
is done only for groups that fit. For each quantile of a larger group a sketch
whose error is known gives a bracket of values that must hold it; a pass counts
what lies below the bracket and in it, and the next sketch is drawn of what lies
in it, until few values are left and are sorted.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a group that one task holds and sorts.
AT_ONCE = 1_000_000
#: Larger groups are at most so many: a group counts as one if it has more than one in so many of all values.
LARGE_GROUPS = 10_000
#: The sketch's size, and the share of ranks by which its quantiles are off at most, three times its usual error of 0.35 %.
SKETCH, ERROR = 800, 0.0105
#: Ranks that a sketch is asked for.
GRID = 200


@dataclass(frozen=True)
class Bracket:
    """Values from low to high of a group, of which below are lower than low and inside within; the values of ranks first and first + 1 are among them."""

    key: tuple
    q: int
    first: int
    share: float  # of the way to the next rank
    low: float
    high: float
    below: int
    inside: int


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], at_once: int = AT_ONCE) -> DataFrame:
    """(keys, q): the quantiles of value for each group, with the value between two ranks in proportion, as an array of doubles.

    Nulls and NaN aren't counted; a group without values has null. Groups of up
    to at_once values, and those of which there may be many, take one
    aggregation; others some passes more, whose results are one row a group.
    """
    known = rows.select(*keys, F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double")).alias("__v"))
    counts = known.groupBy(*keys).agg(F.count("__v").alias("__n"))
    most, total = counts.agg(F.max("__n"), F.sum("__n")).collect()[0]
    plain = lambda df: df.groupBy(*keys).agg(F.percentile("__v", F.array(*map(F.lit, shares))).alias("q"))
    least = max(at_once, (total or 0) // LARGE_GROUPS)
    if (most or 0) <= least:
        return plain(known)
    spark, fields = rows.sparkSession, ", ".join(f"`{k}` {dict(rows.dtypes)[k]}" for k in keys)
    large = counts.filter(F.col("__n") > least).collect()  # LARGE_GROUPS at most
    todo = []
    for r in large:
        for q, share in enumerate(shares):
            at = share * (r["__n"] - 1)
            todo.append(Bracket(tuple(r[k] for k in keys), q, int(at), at - int(at), float("-inf"), float("inf"), 0, r["__n"]))
    done: dict[tuple, list[float | None]] = {tuple(r[k] for k in keys): [None] * len(shares) for r in large}
    while todo:
        some = [b for b in todo if b.inside > at_once and b.low < b.high]
        few = [b for b in todo if not (b.inside > at_once and b.low < b.high)]
        for b, (a, c) in zip(few, _sorted(known, keys, fields, few), strict=True):
            done[b.key][b.q] = a if c is None or a == c else a + b.share * (c - a)
        todo = _narrowed(known, keys, fields, some)
    found = spark.createDataFrame([(*k, v) for k, v in done.items()], f"{fields}, q array<double>")
    named = F.broadcast(found.select(*(F.col(k).alias(f"__k_{k}") for k in keys)))
    return plain(known.join(named, _same(keys), "left_anti")).unionByName(found)


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys))


def _within(known: DataFrame, keys: list[str], fields: str, brackets: list[Bracket]) -> DataFrame:
    """known's values beside each bracket of their group, up to its upper end; the table of brackets is small."""
    listed = [(i, *b.key, b.low, b.high) for i, b in enumerate(brackets)]
    table = known.sparkSession.createDataFrame(listed, f"__i int, {fields}, __low double, __high double").withColumnsRenamed({k: f"__k_{k}" for k in keys})
    return known.join(F.broadcast(table), _same(keys) & (F.col("__v") <= F.col("__high")))


def _narrowed(known: DataFrame, keys: list[str], fields: str, brackets: list[Bracket]) -> list[Bracket]:
    """Each bracket's next one: quantiles of a sketch of its values around the ranks that are looked for, then counted."""
    if not brackets:
        return []
    inside = _within(known, keys, fields, brackets).filter("__v >= __low")
    ranks = known.sparkSession.createDataFrame([(i, max(0.0, (b.first - b.below) / b.inside - ERROR), min(1.0, (b.first + 1 - b.below) / b.inside + ERROR)) for i, b in enumerate(brackets)], "__i int, __from double, __to double")
    drawn = inside.groupBy("__i").agg(F.kll_sketch_agg_double("__v", F.lit(SKETCH)).alias("s")).join(F.broadcast(ranks), "__i")
    grid = F.kll_sketch_get_quantile_double("s", F.array(*(F.lit(i / GRID) for i in range(GRID + 1))))  # a sketch is asked for constant shares only
    drawn = drawn.select("__i", grid.alias("g"), F.floor(F.col("__from") * GRID).cast("int").alias("a"), F.ceil(F.col("__to") * GRID).cast("int").alias("c"))
    ends = {r["__i"]: (r["low"], r["high"]) for r in drawn.select("__i", F.get("g", F.col("a")).alias("low"), F.get("g", F.col("c")).alias("high")).collect()}
    tried = [replace(b, low=ends[i][0], high=ends[i][1]) for i, b in enumerate(brackets)]
    lower = F.col("__v") < F.col("__low")
    counted = {r["__i"]: r for r in _within(known, keys, fields, tried).groupBy("__i").agg(F.count_if(lower).alias("below"), F.count_if(~lower).alias("inside")).collect()}
    out = []
    for i, (b, t) in enumerate(zip(brackets, tried, strict=True)):
        t = replace(t, below=counted[i]["below"], inside=counted[i]["inside"])
        held = t.below <= b.first and min(b.first + 1, b.below + b.inside - 1) < t.below + t.inside
        out.append(t if held else b)  # the sketch was off by more: another is drawn
    return out


def _sorted(known: DataFrame, keys: list[str], fields: str, brackets: list[Bracket]) -> list[tuple[float, float | None]]:
    """The values of ranks first and first + 1 of each bracket, which has few values or one."""
    if not brackets:
        return []
    values = _within(known, keys, fields, brackets).filter("__v >= __low")
    counted = values.groupBy("__i", "__v").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("__i").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranks = known.sparkSession.createDataFrame([(i, b.first - b.below) for i, b in enumerate(brackets)], "__i int, __first long")
    ends = counted.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(ranks), "__i")
    first = F.min(F.when(F.col("upto") > F.col("__first"), F.col("__v"))).alias("first")
    second = F.min(F.when(F.col("upto") > F.col("__first") + 1, F.col("__v"))).alias("second")
    found = {r["__i"]: (r["first"], r["second"]) for r in ends.groupBy("__i").agg(first, second).collect()}
    return [found[i] for i in range(len(brackets))]
