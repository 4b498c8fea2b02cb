"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark form a hash set that is broadcast; the windows of
every document are hashed in one scan, probed, and each hit is verified word by
word before it counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, as_row, ascii_lower

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows in one broadcast: about 64 MB with their words. A larger benchmark is taken in blocks of so many, each in a scan of its own.
BROADCAST_WINDOWS = 200_000
#: Documents to leave out whose hashes a broadcast may hold (about 64 MB).
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Normalised words of a text; null has none."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), lambda w: w != "")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: an optimizer may otherwise copy its expression into a lambda function's body."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(hashes: Column, size: int) -> Column:
    """Hashes of all windows of so many words."""
    last = F.size(hashes) - size
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(size))))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(w_size, w_hash, w_words, w_items): each different window with the sorted ids of the items that hold it.

    An item of fewer than WINDOW words is one window; one without words has none.
    Items of one id are one item; a null id counts as the empty id.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("all"))
    items = items.filter(F.size("all") > 0).withColumn("w_size", F.least(F.size("all"), F.lit(WINDOW)))
    at = F.explode(F.sequence(F.lit(0), F.size("all") - F.col("w_size"))).alias("at")
    each = items.select("item", "all", "w_size", at).select("item", "w_size", F.slice("all", F.col("at") + 1, F.col("w_size")).alias("w_words"))
    hashed = F.xxhash64(F.transform("w_words", lambda w: F.xxhash64(w))).alias("w_hash")
    return each.groupBy("w_size", "w_words").agg(F.array_sort(F.collect_set("item")).alias("w_items")).select("w_size", hashed, "w_words", "w_items")


def _row_key(docs: DataFrame) -> list[Column]:
    """What tells rows apart: rows of one id and one text are alike in every result."""
    return [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_key")]


def _probed(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int) -> DataFrame:
    """(doc_id, row_key, n_words, start, w_size, w_items): a row without start for each document, and one for each verified occurrence of a window."""
    windows = benchmark_windows(benchmark)
    sizes = {r["w_size"]: r["n"] for r in windows.groupBy("w_size").agg(F.count("*").alias("n")).collect()}  # ten rows at most
    lengths, total = sorted(sizes) or [WINDOW], sum(sizes.values())
    scanned = docs.select(*_row_key(docs), words(F.col("text")).alias("all"))
    each = lambda h: F.concat(F.array(F.lit(None).cast("long")), *(_windows(h, n) for n in lengths))
    scanned = scanned.select("doc_id", "row_key", "all", _once(F.transform("all", lambda w: F.xxhash64(w)), each).alias("windows"))
    # outer: else a filter on the array's size is inferred, which computes every array a second time
    probes = scanned.select("doc_id", "row_key", "all", F.posexplode_outer("windows").alias("at", "w_hash"))
    before, offset = F.lit(1), F.lit(1)
    for n in lengths:  # the document itself stands first, then windows of each length one after another
        offset = F.when(F.col("w_size") == n, before).otherwise(offset)
        before = before + F.greatest(F.size("all") - n + 1, F.lit(0))
    start = F.col("at") - offset
    same = (start >= 0) & (F.slice("all", F.greatest(start, F.lit(0)) + 1, F.col("w_size")) == F.col("w_words"))
    blocks = -(-total // broadcast_windows) or 1
    parts = [windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("w_hash"), F.lit(blocks)) == b) for b in range(blocks)]
    wanted = lambda i: (F.col("at") == 0) | same if i == 0 else (F.col("at") > 0) & same
    found = [probes.join(F.broadcast(p), "w_hash", "left").filter(wanted(i)) for i, p in enumerate(parts)]
    columns = ["doc_id", "row_key", F.size("all").cast("long").alias("n_words"), F.when(F.col("at") > 0, start).alias("start"), "w_size", "w_items"]
    return reduce(DataFrame.unionAll, [f.select(*columns) for f in found])


def hits(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, row_key, start, w_size, w_items): verified occurrences of benchmark windows in documents.

    Null and empty texts have none; texts of any length are scanned whole; each of
    several repeated rows, or rows without an id, has its own; an empty table or
    benchmark gives none; other columns are not read.
    """
    return _probed(docs, benchmark, broadcast_windows).filter("start is not null").drop("n_words")


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per row of docs: doc_id, row_key, n_words, n_hit, item_ids (sorted as strings), n_items, contaminated.

    Null and empty texts have no words and no hits; texts of any length are read
    whole; repeated rows and null ids get a result each; an empty benchmark hits
    nothing; an empty table gives none; other columns are not read.
    """
    same_doc = ["doc_id", "row_key"]
    found = _probed(docs, benchmark, broadcast_windows).groupBy(*same_doc, "n_words", "start", "w_size").agg(F.first("w_items").alias("w_items"), F.count("*").alias("n"))
    earlier = Window.partitionBy(*same_doc).orderBy("start", "w_size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("w_size")
    new = end - F.greatest("start", F.least(F.coalesce(F.max(end).over(earlier), F.lit(0)), end))
    per_doc = found.withColumn("new", new).groupBy(*same_doc).agg(
        F.max("n_words").alias("n_words"), F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("item_ids"),
        F.max(F.when(F.col("start").isNull(), F.col("n"))).alias("rows"),
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy")
    return per_doc.select("*", copies).select(*same_doc, "n_words", "n_hit", "item_ids", F.size("item_ids").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, most_hit_share: float = 0.0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs without the documents of which a larger share of words than most_hit_share is hit; columns stay as they are.

    Null and empty texts stay; rows of one id and one text fare alike; an empty
    benchmark or table changes nothing. The hashes of what goes are written once;
    texts aren't shuffled unless there are more than broadcast_rows of them.
    """
    bad = contamination(docs, benchmark).filter((F.col("n_hit") > 0) & (F.col("n_hit") > most_hit_share * F.col("n_words"))).select("doc_id", "row_key").distinct()
    bad = SharedTables(docs.sparkSession).keep(bad)
    return as_row(docs).join(F.broadcast(bad) if bad.count() <= broadcast_rows else bad, _same_row(), "left_anti").select("row.*")


def _same_row() -> Column:
    return F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("row_key"))


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with the hit words cut out of their texts; what stands between other words stays as it was.

    Null and empty texts stay as they are; repeated rows and null ids are cut
    alike; other columns stay, whatever their names; an empty benchmark cuts
    nothing; an empty table stays empty.
    """
    each = hits(docs, benchmark).select("doc_id", "row_key", F.explode(F.sequence("start", F.col("start") + F.col("w_size") - 1)).alias("at"))
    cut = each.groupBy("doc_id", "row_key").agg(F.collect_set("at").alias("cut"))
    gaps, found = F.split("row.text", WORD), F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0))
    marked = F.transform(found, lambda w, i: F.when(F.array_contains("cut", i), F.lit("")).otherwise(w))
    rebuilt = F.array_join(F.zip_with(gaps, marked, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(rebuilt)
    return as_row(docs).join(cut, _same_row(), "left").select(F.col("row").withField("text", text).alias("row")).select("row.*")
