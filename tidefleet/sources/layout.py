"""Table layout: compaction, sorting, Z-order, retention, health."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefleet.functions.geo import morton
from tidefleet.operators.scans import Tracks, total
from tidefleet.sources.published import Published, file_name
from tidefleet.sources.writers import overwrite

TARGET_BYTES = 64 << 20


def _listing(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def table_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop = _listing(spark, path)
    return fs.getContentSummary(hadoop).getLength()


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of last change in ms) of all files below a folder, but those whose names begin with _ or a dot."""
    fs, hadoop = _listing(spark, path)
    found, each = [], fs.listFiles(hadoop, True)
    while each.hasNext():
        f = each.next()
        if f.getPath().getName()[0] not in "_.":
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


#: Files below the least size are put together, those above the greatest split; so many are rewritten and published at a time, as their names are broadcast.
LEAST_BYTES, MOST_BYTES, FILES_AT_ONCE = 3 << 20, 128 << 20, 50_000


def bins(listing: DataFrame, least: int = LEAST_BYTES, target: int = TARGET_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """(file, rows, folder, bin, pieces): the files of a listing that are to be rewritten.

    Small files of a folder fill its bins one after another, by size, each up to
    target bytes; a bin of one file stays as it is. A file above most bytes is
    cut into pieces of about target bytes.
    """
    folder = F.regexp_extract("file", "write=[^/]+/(?:(.*)/)?[^/]+$", 1).alias("folder")
    odd = listing.select("file", "rows", "bytes", folder)
    track = Tracks.of(odd.filter(F.col("bytes") < least), ["folder"], "bytes", "file").scan(upto=total("bytes"))
    small = track.plain().withColumn("bin", F.floor((F.col("upto") - F.col("bytes")) / target))
    shared = small.groupBy("folder", "bin").agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    large = odd.filter(F.col("bytes") > most)
    columns = lambda df, bin, pieces: df.select("file", "rows", "folder", bin.cast("string").alias("bin"), pieces.cast("long").alias("pieces"))
    return columns(small.join(shared, ["folder", "bin"], "left_semi"), F.col("bin"), F.lit(1)).unionAll(columns(large, F.col("file"), F.ceil(F.col("bytes") / target)))


def compact(table: Published, least: int = LEAST_BYTES, target: int = TARGET_BYTES, most: int = MOST_BYTES, at_once: int = FILES_AT_ONCE) -> int:
    """Rewrite a table's small and very large files, a task for each bin or piece; how many files were rewritten. All others stay where they are.

    Bins are named on the driver, one for each task that it runs anyway; rows go
    from readers to writers.
    """
    listing, done = table.listing(), 0
    listed = [] if listing is None else bins(listing, least, target, most).orderBy("folder", "bin", "file").collect()
    while listed:
        some, listed = listed[:at_once], listed[at_once:]
        first, at = {}, 0
        for r in some:
            if (r["folder"], r["bin"]) not in first:
                first[r["folder"], r["bin"]], at = at, at + r["pieces"]
        named = table.spark.createDataFrame([(r["file"], first[r["folder"], r["bin"]], r["pieces"], r["rows"]) for r in some], "__file string, __first int, __pieces long, __rows long")
        files = [r["file"] for r in some]
        rows = table.rows_of(files)
        met = rows.withColumns({"__at": file_name(), "__index": F.col("_metadata.row_index")}).join(F.broadcast(named), F.col("__at") == F.col("__file"))
        task = F.col("__first") + F.floor(F.col("__index") * F.col("__pieces") / F.col("__rows")).cast("int")
        table.rewrite(met.repartitionById(at, task).select(*rows.columns), files)
        done += len(files)
    return done


def remove_orphans(spark: SparkSession, path: str, known: DataFrame, older_than_ms: int) -> list[str]:
    """Delete files below a folder that known (column file_path) doesn't list and that last changed before a time; the names of those that went.

    known is what a table's versions refer to, such as _metadata.file_path of a
    good read. Newer files may be those of a writer at work and stay.
    """
    files = spark.createDataFrame([(f, n, t) for f, n, t in data_files(spark, path)], "file_path string, bytes long, changed long")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    listed = known.select(plain(F.col("file_path")).alias("k")).distinct()
    gone = [r[0] for r in files.filter(F.col("changed") < older_than_ms).join(listed, plain(F.col("file_path")) == F.col("k"), "left_anti").select("file_path").collect()]
    fs, _ = _listing(spark, path)
    for f in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f), False)
    return sorted(gone)


def by_day(df: DataFrame, time: str = "timestamp", day: str = "day") -> DataFrame:
    """df with the day that a partitioned table derives from a time; write with partitionBy(day)."""
    return df.withColumn(day, F.to_date(time))


def in_range(df: DataFrame, start: str, end: str, time: str = "timestamp", day: str = "day") -> DataFrame:
    """Rows of start <= time < end of a table by_day(): days follow from the times, so that partitions are pruned without the caller naming them."""
    low, high = F.lit(start).cast(df.schema[time].dataType), F.lit(end).cast(df.schema[time].dataType)
    return df.filter((F.col(time) >= low) & (F.col(time) < high) & (F.col(day) >= F.to_date(low)) & (F.col(day) <= F.to_date(high)))


#: Rows that a task sorts and writes into one file.
ROWS_A_FILE = 1_000_000


def files_for(rows: int, least: int) -> int:
    """How many files hold so many rows: at least least, and more where they would get too long."""
    return max(least, math.ceil(rows / ROWS_A_FILE))


def sort_rewrite(spark: SparkSession, path: str, out: str, keys: list[str], files: int) -> None:
    """Ranges of the keys in so many files or, of a large table, more, sorted inside, so that scans skip by minima and maxima."""
    rows = spark.read.parquet(path)
    overwrite(rows.repartitionByRange(files_for(rows.count(), files), *keys).sortWithinPartitions(*keys), out)


def z_order(df: DataFrame, x: str, y: str, files: int) -> DataFrame:
    """Rows in so many ranges, of a large table more, of a Z-order key of two numeric columns, scaled to the table's own extremes."""
    low_x, high_x, low_y, high_y, rows = df.agg(F.min(x), F.max(x), F.min(y), F.max(y), F.count("*")).collect()[0]
    key: Column = morton(F.col(x).cast("double"), F.col(y).cast("double"), (low_x or 0, high_x or 0), (low_y or 0, high_y or 0))
    return df.withColumn("__z", key).repartitionByRange(files_for(rows, files), "__z").sortWithinPartitions("__z").drop("__z")


def z_order_rewrite(spark: SparkSession, path: str, out: str, x: str, y: str, files: int) -> None:
    overwrite(z_order(spark.read.parquet(path), x, y, files), out)


def prune_versions(spark: SparkSession, folder: str, keep: int = 3) -> list[str]:
    """Delete all but the newest versions, which are folders named in ascending order."""
    fs, hadoop = _listing(spark, folder)
    found = sorted(s.getPath().toString() for s in fs.listStatus(hadoop) if s.isDirectory())
    gone = found[:-keep] if keep else found
    for p in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p), True)
    return gone


def table_health(table: Published, least: int = LEAST_BYTES) -> DataFrame:
    """A row for each partition: folder, files, small (files below the least size), rows, bytes, smallest, largest, mean size, the range of the key, the columns of the table, its newest version and how many there are. No file is opened."""
    record = table.record()
    small = table.listing().filter(F.col("bytes") < least).groupBy(F.regexp_extract("file", "write=[^/]+/(?:(.*)/)?[^/]+$", 1).alias("folder")).agg(F.count("*").alias("small"))
    columns = F.array(*(F.lit(f"{f['name']} {f['type'] if isinstance(f['type'], str) else f['type']['type']}") for f in record["schema"]["fields"]))
    per = table.summary().join(small, "folder", "left").withColumn("small", F.coalesce("small", F.lit(0)))
    return per.withColumns({"mean_bytes": F.col("bytes") / F.col("files"), "columns": columns, "version": F.lit(record["version"]), "versions": F.lit(len(table.versions()))})


def layout_benchmark(spark: SparkSession, path: str, root: str, queries: dict[str, Callable[[DataFrame], DataFrame]], time_column: str, keys: list[str], pieces: int = 200, files: int = 4) -> list[dict]:
    """Seconds of each query over five layouts of one table: many small files, compacted, by day, sorted, in Z-order. One warm-up, then the mean of two runs."""
    source = spark.read.parquet(path)
    overwrite(source.repartition(pieces), f"{root}/small")
    compacted = Published(spark, f"{root}/compacted")
    compacted.append(source.repartition(pieces))
    compact(compacted)
    compacted.vacuum(1)
    overwrite(by_day(source, time_column).repartition("day"), f"{root}/by_day", "day")
    sort_rewrite(spark, f"{root}/small", f"{root}/sorted", keys, files)
    z_order_rewrite(spark, f"{root}/small", f"{root}/z_order", *keys[:2], files)
    out = []
    for name in ("small", "compacted", "by_day", "sorted", "z_order"):
        seconds = {q: [timed(run(compacted.read() if name == "compacted" else spark.read.parquet(f"{root}/{name}"))) for _ in range(3)][1:] for q, run in queries.items()}
        out.append({"layout": name, "files": compacted.listing().count() if name == "compacted" else len(data_files(spark, f"{root}/{name}")), "bytes": table_bytes(spark, f"{root}/{name}")} | {q: sum(v) / 2 for q, v in seconds.items()})
    return out


def timed(df: DataFrame) -> float:
    """Seconds to compute every row of df."""
    import time

    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began
