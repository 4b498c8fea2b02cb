"""Interaction audit of filters: every order of them is replayed over every document's flags."""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.llm.common import UPPER, SharedTables, text_key, with_groups

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def conditions(text: Column) -> dict[str, Column]:
    """When a text fails the filters that look at it alone: A few words, B words repeat, C capitals, D signs."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return {"n_words": F.size(words), "n_different": F.size(F.array_distinct(words)), "n_capitals": F.length(F.regexp_replace(text, f"[^{UPPER[0]}-{UPPER[-1]}]+", "")), "n_chars": F.length(text), "d": text.rlike("[#$%&*|]")}


def flags(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, a, b, c, d, e, good, toxic): a row a document; a to e are true where it fails that filter.

    Null texts are empty: too few words, no other failure of their own. Of the
    documents of one text all fail E but those with the smallest id; without an
    id a document neither fails E nor makes another fail it. Null parts are the
    empty part. Of several labels of one id the least counts.
    """
    tables = SharedTables(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    measured = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), *(c.alias(n) for n, c in text_key(F.col("text")).items()), *(c.alias(n) for n, c in conditions(text).items()))
    a, b, c = F.col("n_words") < 50, 100 * F.col("n_different") < 65 * F.col("n_words"), 100 * F.col("n_capitals").cast("long") > 5 * F.col("n_chars").cast("long")
    own = tables.keep(measured.select("doc_id", "part", "h1", "h2", a.alias("a"), b.alias("b"), c.alias("c"), "d"))
    groups = tables.keep(own.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    total = groups.agg(F.sum("n")).collect()[0][0] or 0
    found = with_groups(own, groups, ["h1", "h2"], "n", total)
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    is_one = lambda c: F.coalesce(F.col(c) == 1, F.lit(False)).alias({"quality": "good"}.get(c, c))
    return found.join(known, "doc_id", "left").select("part", "a", "b", "c", "d", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("e"), is_one("quality"), is_one("toxic"))


def orders(flagged: DataFrame) -> DataFrame:
    """(filter_order, at_a to at_e): the 120 orders of the filters, with each filter's step."""
    listed = ["".join(p) for p in permutations(FILTERS)]
    rows = [(o, *(o.index(f) + 1 for f in FILTERS)) for o in listed]
    return flagged.sparkSession.createDataFrame(rows, "filter_order string, " + ", ".join(f"at_{f.lower()} int" for f in FILTERS))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """A row for each part, order of filters and step: part, filter_order, step, the COUNTS of documents, and shapley.

    Each document's flags meet all orders, which are broadcast (120 rows), and
    the steps of each; the filter at a step removes a document if it's the first
    in that order that the document fails. Counts are summed where the rows are
    before they are shuffled, so a part of any size is a few hundred rows a task.
    A part has all its rows, zeros included; an empty table has none. Repeated
    rows count each; columns of other names aren't read.
    """
    flagged = flags(docs, labels, part)
    names = [f.lower() for f in FILTERS]
    first = F.least(*(F.when(F.col(n), F.col(f"at_{n}")).otherwise(len(names) + 1) for n in names))
    fails = reduce(lambda x, y: x + y, (F.col(n).cast("int") for n in names))
    replayed = flagged.withColumn("n_fails", fails).crossJoin(F.broadcast(orders(flagged))).withColumn("first", first)
    steps = replayed.withColumn("step", F.explode(F.array(*(F.lit(s) for s in range(1, len(names) + 1)))))
    here = reduce(lambda x, y: x | y, (F.col(n) & (F.col(f"at_{n}") == F.col("step")) for n in names))
    gone = F.col("first") == F.col("step")
    counted = {"kept": F.col("first") > F.col("step"), "removed": gone, "redundant": here & (F.col("first") < F.col("step")), "unique_fails": here & (F.col("n_fails") == 1), "good_lost": gone & F.col("good"), "toxic_lost": gone & F.col("toxic")}
    summed = steps.groupBy("part", "filter_order", "step").agg(*(F.sum(counted[n].cast("long")).alias(n) for n in COUNTS))
    # a filter's removals over all orders and steps: 120 rows for each part
    filters = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))
    return summed.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(filters).alias("shapley"))
