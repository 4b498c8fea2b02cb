"""Writers, layouts and streams on small tables."""

import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidefleet.sources import layout, readers, writers
from tidefleet.sources.published import Published
from tidefleet.streaming import pipelines as p


def test_partition_overwrite_leaves_other_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.append(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), path, "day")
    writers.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, day string"), path, "day")
    assert sorted(map(tuple, spark.read.parquet(path).select("v", "day").collect())) == [(1, "a"), (9, "b")]


def test_health_from_the_listing(spark, tmp_path):
    t = Published(spark, f"file://{tmp_path}/h", "id")
    t.append(spark.range(1000).selectExpr("id", "IF(id < 900, 'a b', NULL) AS day").repartition(20), "day")
    health = {r.folder: r for r in layout.table_health(t, 1 << 20).collect()}
    assert sorted(health) == ["day=__HIVE_DEFAULT_PARTITION__", "day=a b"] and health["day=a b"].rows == 900 and (health["day=a b"].low, health["day=a b"].high) == (0, 899)
    assert all(h.files == h.small == 20 and h.smallest <= h.mean_bytes <= h.largest and h.columns == ["id long", "day string"] and (h.version, h.versions) == (0, 1) for h in health.values())
    assert {r.day: r.rows for r in t.partition_rows("day").collect()} == {"a b": 900, None: 100}
    plan = t.partition_rows("day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<file:string,rows:bigint>" in plan  # no file of rows is scanned


def test_joins_of_bucketed_tables_shuffle_nothing(spark, tmp_path):
    rows = spark.range(2000).selectExpr("'v' || id % 97 AS vehicle", "id AS ep")
    writers.save_bucketed(rows, "bucketed_pings", f"file://{tmp_path}/p", ["vehicle"], ["ep"], 4)
    writers.save_bucketed(spark.range(90).selectExpr("'v' || id AS vehicle", "id AS route_id"), "bucketed_mapping", f"file://{tmp_path}/m", ["vehicle"], [], 4)
    try:
        joined = spark.table("bucketed_pings").join(spark.table("bucketed_mapping").hint("merge"), "vehicle")
        counted = joined.groupBy("vehicle").agg(F.count("*").alias("n"), F.max("ep").alias("last"))
        last = spark.table("bucketed_pings").withColumn("n", F.row_number().over(Window.partitionBy("vehicle").orderBy(F.desc("ep")))).filter("n = 1")
        for df in (joined, counted, last):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == sum(1 for i in range(2000) if i % 97 < 90) and counted.count() == 90 and last.count() == 97
    finally:
        for t in ("bucketed_pings", "bucketed_mapping"):
            spark.sql(f"DROP TABLE {t}")


def test_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for v in range(5):
        spark.range(v + 1).write.parquet(f"{path}-v/version={v}")
    layout.prune_versions(spark, f"{path}-v", keep=2)
    assert {r.version for r in spark.read.parquet(f"{path}-v").collect()} == {3, 4}


def test_route_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("vehicle,route_id,route_no\na,1,01\n,2,02\nb,3,163V\n")
    assert sorted(map(tuple, readers.mapping_csv(spark, f"file://{tmp_path}/m.csv").collect())) == [("a", 1, "01"), ("b", 3, "163V")]
    (tmp_path / "p.json").write_text('[{"RouteId":1,"RouteVarId":1,"Outbound":true,"lat":[1.0,2.0],"lng":[3.0,4.0]},\n{"RouteId":2,"lat":[],"lng":[]},{"RouteId":3}]')
    found = {r.route_id: r.path for r in readers.route_paths(readers.multiline_json(spark, f"file://{tmp_path}/p.json", readers.ROUTE_PATH)).collect()}
    assert found == {1: [[3.0, 1.0], [4.0, 2.0]], 2: [], 3: []}


def test_orphans_go_by_age(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(10).repartition(2).write.parquet(path)
    known = spark.read.parquet(path).select("_metadata.file_path").distinct()
    known = spark.createDataFrame([tuple(r) for r in known.collect()], "file_path string")
    spark.range(5).coalesce(1).write.mode("append").parquet(path)
    assert layout.remove_orphans(spark, path, known, 0) == []  # none is that old
    assert len(layout.remove_orphans(spark, path, known, int(time.time() * 1000) + 60_000)) == 1
    assert spark.read.parquet(path).count() == 10


def test_partitions_and_statistics_prune(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.range(1000).select("id", (F.col("id") * 1.0).alias("x"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("timestamp"))
    writers.append(layout.by_day(rows), path, "day")
    some = layout.in_range(spark.read.parquet(path), "2024-01-03 00:00:00", "2024-01-04 12:00:00").filter("x between 60 and 70")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = some._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(x,60.0)" in plan and some.count() == 11
    assert sorted(r[0].day for r in some.select("day").distinct().collect()) == [3]


def test_layout_benchmark(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(2000).select("id", (F.col("id") % 7).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 3 as int))").alias("ts")).write.parquet(path)
    found = layout.layout_benchmark(spark, path, f"file://{tmp_path}/out", {"count": lambda df: df.groupBy("k").count(), "range": lambda df: df.filter("id < 10")}, "ts", ["id", "k"], pieces=12, files=2)
    assert [r["layout"] for r in found] == ["small", "compacted", "by_day", "sorted", "z_order"] and [r["files"] for r in found] == [12, 1, 3, 2, 2]
    assert all(r["count"] > 0 and r["range"] > 0 for r in found)


def test_json_document_is_replaced(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    for n in (3, 2):
        writers.write_json_document(spark.range(n).selectExpr("cast(id as string) as route_key", "id as index"), path)
    assert sorted(map(tuple, spark.read.json(path).select("route_key", "index").collect())) == [("0", 0), ("1", 1)]


def test_inferred_json_and_kafka_options(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1,\n "b": [{"c": "x"}]},\n {"a": 2}]')
    found = readers.multiline_json(spark, f"file://{tmp_path}/a.json")
    assert dict(found.dtypes) == {"a": "bigint", "b": "array<struct<c:string>>"} and found.count() == 2
    assert readers.kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false"}
    assert readers.kafka_options("h:1", "t", "latest", 5000)["maxOffsetsPerTrigger"] == "5000"


def test_dimensions_take_the_least_of_repeated_rows(spark):
    info = spark.createDataFrame([(1, "01", [(1, "b", True, 1.0, 5, "A", "B"), (2, "c", False, 1.0, 5, "B", "A")]), (1, "01", [(1, "a", True, 1.0, 5, "A", "B")]), (2, "02", None)], readers.ROUTE_INFO)
    assert sorted((r.route_id, r.route_var_id, r.route_var_name, r.direction) for r in readers.variant_dimension(info).collect()) == [(1, 1, "a", "Outbound"), (1, 2, "c", "Inbound")]
    paths = spark.createDataFrame([(1, "01", 1, "v", True, [10.1], [106.1]), (1, "01", 2, "v", False, [], []), (3, "03", 1, "v", True, None, None)], readers.ROUTE_PATH)
    found = {(r.route_id, r.route_var_id): r.path for r in readers.path_dimension(paths).collect()}
    assert found == {(1, 1): [readers.MISSING_TERMINAL], (1, 2): [readers.MISSING_TERMINAL], (3, 1): []}


def test_a_shared_folder_or_an_error():
    from tidefleet.session import work_dir

    class Session:
        def __init__(self, **settings):
            self.conf, self.settings = self, settings

        def get(self, key, default=None):
            return self.settings.get(key.replace(".", "_"), default)

    with pytest.raises(ValueError, match="share"):
        work_dir(Session(spark_master="spark://host:7077"))
    assert work_dir(Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///x")).startswith("hdfs:///x/work-")
