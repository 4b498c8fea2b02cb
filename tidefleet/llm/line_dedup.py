"""Site-relative line frequency: a line is boilerplate where a large share of its site's pages holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, as_row

#: A line on more than this share of a site's pages is boilerplate,
RATIO = 0.05
#: but not if fewer pages hold it.
MIN_PAGES = 4
#: Line hashes of all sites' boilerplate that a broadcast may hold (about 64 MB); beyond it the pages are joined by site,
BROADCAST_LINES = 4_000_000
#: each site's in so many parts, so that no site's pages come to one task.
PARTS = 64


def _line(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(pages: DataFrame, tables: SharedTables, site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines): the hashes of each site's boilerplate lines.

    Pages of one site and one text are one page. Each site's list is short: lines
    on more than ratio of its pages can't be more than a page's mean lines / ratio.
    """
    text = F.coalesce("text", F.lit(""))
    own = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), _line))
    page = pages.select(F.coalesce(site, F.lit("")).alias("site"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), own.alias("own"))
    once = page.groupBy("site", "h1", "h2").agg(F.any_value("own").alias("own"))
    # the null line stands for the page itself: its count is the site's total
    counted = once.select("site", F.explode(F.concat(F.array(F.lit(None).cast("long")), "own")).alias("line")).groupBy("site", "line").agg(F.count("*").alias("n"))
    often = tables.keep(counted.filter(F.col("line").isNull() | (F.col("n") >= min_pages)))
    totals = often.filter("line is null").select("site", F.col("n").alias("total"))
    bad = often.filter("line is not null").join(totals, "site").filter(F.col("n") > ratio * F.col("total"))
    return tables.keep(bad.groupBy("site").agg(F.collect_set("line").alias("lines")))


def clean(pages: DataFrame, site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """(row, dropped): the rows of pages as structs, with boilerplate lines gone from text, and how many lines went (int).

    Lines stand between newlines and are compared without spaces at their ends;
    blank lines always stay, and every line over the ratio goes, be it all that a
    page has. A line on just ratio of the pages stays, as does one on fewer than
    min_pages: on sites of less than min_pages / ratio pages a line over the ratio
    may stay, so that a site of a few pages keeps what two of them share. Null texts stay null; a
    null site is a site of its own, together with the empty one; texts of any
    length are split whole; repeated rows count as one page and are cleaned
    alike; an empty table stays empty; columns of any name are carried along.
    """
    tables = SharedTables(pages.sparkSession)
    found = boilerplate(pages, tables, site, ratio, min_pages)
    entries = found.agg(F.sum(F.size("lines") + 4)).collect()[0][0] or 0
    bad = found.select(F.col("site").alias("at"), F.col("lines").alias("bad"))
    rows, text = as_row(pages), F.col("row.text")
    here = F.coalesce(f"row.{site}", F.lit(""))
    if entries <= broadcast_lines:
        joined = rows.join(F.broadcast(bad), here == F.col("at"), "left")
    else:
        part = F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(PARTS))
        dealt = bad.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        joined = rows.join(dealt, (here == F.col("at")) & (part == F.col("part")), "left")
    kept = F.filter(_lines(text), lambda x: ~F.array_contains("bad", _line(x)) | (F.trim(x) == ""))
    cut = joined.select("row", F.when(F.col("bad").isNotNull() & text.isNotNull(), kept).alias("kept"))
    cut = cut.withColumn("fewer", F.coalesce(F.size(_lines(text)) - F.size("kept"), F.lit(0)))
    taken = F.col("kept").isNotNull() & (F.col("fewer") > 0)
    return cut.select(F.col("row").withField("text", F.when(taken, F.array_join("kept", "\n")).otherwise(text)).alias("row"), F.when(taken, F.col("fewer")).otherwise(0).alias("dropped"))


def without_boilerplate(docs: DataFrame, site: str = "source") -> DataFrame:
    """docs with boilerplate lines gone from their texts, n_chars (if there) counted anew where a text changed; columns and rows as they were."""
    cleaned = clean(docs, site)
    if "n_chars" in docs.columns:
        new = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("row", F.col("row").withField("n_chars", F.when(F.col("dropped") > 0, new).otherwise(F.col("row.n_chars"))))
    return cleaned.select("row.*")
