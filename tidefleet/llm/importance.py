"""Importance resampling towards a target distribution by hashed n-gram features.

Identical texts are collapsed first: a text's features are counted and weighed
once, with its number of copies, and only the noise is drawn for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, ranked, text_key, with_groups
from tidefleet.llm.decontaminate import _once, words

#: Features are hashed into so many buckets,
BUCKETS = 10_000
#: runs of 1 to so many words;
RUN = 2
#: documents of at least so many words are drawn from,
LEAST_WORDS = 20
#: this percentage of them,
PERCENT = 25
#: by noise of this seed.
SEED = 7
#: Gains, weights and noise are whole numbers, so many to one unit of a logarithm.
SCALE = 1000


def buckets(all_words: Column) -> Column:
    """The bucket of every feature of a text, repeats included."""
    def runs(n: int) -> Column:
        return all_words if n == 1 else F.transform(F.slice(all_words, n, F.greatest(F.size(all_words) - n + 1, F.lit(0))), lambda _, i: F.array_join(F.slice(all_words, i + 1, n), " "))

    return F.transform(F.concat(*(runs(n) for n in range(1, RUN + 1))), lambda f: F.pmod(F.crc32(f.cast("binary")), F.lit(BUCKETS)).cast("smallint"))


def collapsed(texts: DataFrame, tables: SharedTables) -> DataFrame:
    """(h1, h2, copies, n_words, buckets): each different text once, with how often it occurs; copies are added up where they are before any text is shuffled."""
    different = texts.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.count("*").alias("copies"))
    split = different.select(*(c.alias(n) for n, c in text_key(F.col("text")).items()), "copies", words(F.col("text")).alias("all"))
    return tables.keep(split.select("h1", "h2", "copies", F.size("all").alias("n_words"), _once(F.col("all"), buckets).alias("buckets")))


def bucket_counts(different: DataFrame) -> DataFrame:
    """(bucket, n): features of all texts, each as often as the text occurs."""
    return different.select("copies", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("copies").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> list[int]:
    """Each bucket's gain, from the counts of two corpora; BUCKETS numbers."""
    both = [{r["bucket"]: r["n"] for r in bucket_counts(x).collect()} for x in (documents, target)]  # BUCKETS rows at most
    counts = documents.sparkSession.createDataFrame([(b, *(float(x.get(b, 0)) for x in both)) for b in range(BUCKETS)], "bucket int, s double, t double")
    all_s, all_t = (float(sum(x.values())) for x in both)
    gain = F.floor(SCALE * F.log((F.col("t") + 1) * F.lit(all_s + BUCKETS) / ((F.col("s") + 1) * F.lit(all_t + BUCKETS))))
    return [r["gain"] for r in counts.select("bucket", gain.alias("gain")).orderBy("bucket").collect()]


def noise(doc_id: Column) -> Column:
    """A document's own Gumbel noise, from its id; a null id counts as the empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs, all long; rank is null for rows that aren't drawn.

    Of the rows of at least least_words words, percent of a hundred (rounded
    down) with the highest scores are drawn; ties go to smaller ids, then to
    rows of fewer features and smaller weight, and null ids stand first. Null
    and empty texts have no features and weight 0. Repeated rows are drawn each
    for itself, with one weight. An empty target makes gains by the documents
    alone; an empty table gives none; other columns aren't read.
    """
    tables = SharedTables(docs.sparkSession)
    different = collapsed(docs, tables)
    listed = gains(different, collapsed(target, tables))
    gain = F.split(F.lit(",".join(map(str, listed))), ",").cast("array<bigint>")  # a constant of BUCKETS numbers
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda sum, b: sum + F.get(gain, b.cast("int")))
    n = F.size("buckets").cast("long")
    weighed = tables.keep(different.select("h1", "h2", "copies", "n_words", n.alias("n_features"), F.when(n > 0, F.floor(total / n)).otherwise(0).cast("long").alias("weight")))
    sizes = weighed.agg(F.sum("copies").alias("rows"), F.sum(F.when(F.col("n_words") >= least_words, F.col("copies"))).alias("eligible")).collect()[0]
    rows = tables.keep(docs.select("doc_id", *(c.alias(n) for n, c in text_key(F.col("text")).items())))
    scored = with_groups(rows, weighed, ["h1", "h2"], "copies", sizes["rows"] or 0).select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"))).cast("long").alias("score"), (F.col("n_words") >= least_words).alias("eligible"))
    drawn = percent * (sizes["eligible"] or 0) // 100
    placed = ranked(tables.keep(scored), tables, F.desc("eligible"), F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight"))
    return placed.select(F.col("doc_id").cast("long").alias("doc_id"), "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
