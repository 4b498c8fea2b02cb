"""Published tables: merges and deletes by file, batches that stop anywhere, restarts, compaction by bins."""

import pytest
from pyspark.sql import functions as F

from tidefleet.sources import layout, readers
from tidefleet.sources.published import Published
from tidefleet.streaming import pipelines as p


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}"


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def names(table):
    return {r.file for r in table.listing().collect()}


def test_upsert_is_idempotent_and_null_keys_match_nothing_unless_told(spark, root):
    t = Published(spark, f"{root}/dim", "k")
    t.upsert(pairs(spark, (1, "a"), (2, "b")), ["k"])
    for _ in range(2):
        t.upsert(pairs(spark, (2, "c"), (3, "d")), ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    for _ in range(2):
        t.upsert(pairs(spark, (None, "n")), ["k"])
    assert t.read().count() == 5
    t.delete("v = 'n'")
    for _ in range(2):
        t.upsert(pairs(spark, (None, "m")), ["k"], nulls_match=True)
    assert t.read().filter("k is null").count() == 1
    with pytest.raises(ValueError, match="one key"):
        t.upsert(pairs(spark, (7, "x"), (7, "y")), ["k"])


def test_few_keys_rewrite_few_files(spark, root, monkeypatch):
    t = Published(spark, f"{root}/t", "k")
    t.append(spark.range(4000).selectExpr("CAST(id AS INT) AS k", "'old' AS v").repartitionByRange(200, "k"))
    before = names(t)
    assert len(before) == 200
    changed = spark.range(0, 5000, 500).selectExpr("CAST(id AS INT) AS k", "'new' AS v")  # ten keys, two of them beyond all files
    t.upsert(changed, ["k"])
    assert len(before - names(t)) <= 8 and t.read().count() == 4002 and t.read().filter("v = 'new'").count() == 10
    monkeypatch.setattr("tidefleet.sources.published.BROADCAST_KEYS", 3)  # more keys than are broadcast
    before = names(t)
    t.upsert(changed.withColumn("v", F.lit("newer")), ["k"])
    assert len(before - names(t)) <= 20 and t.read().filter("v = 'newer'").count() == 10 and t.read(version=1).filter("v = 'new'").count() == 10


def test_delete_keeps_rows_for_which_the_condition_is_null(spark, root):
    t = Published(spark, f"{root}/t")
    t.append(spark.createDataFrame([(1,), (2,), (None,), (5,)], "v int").repartitionByRange(4, "v"))
    assert t.delete("v = 1") == 1 and t.delete("v = 1") == 0
    assert sorted(t.read().collect(), key=str) == [(2,), (5,), (None,)]


def test_partition_values_of_any_spelling(spark, root):
    t = Published(spark, f"{root}/t", "k")
    days = ["a b", "c+d%20", "é/=", "plain"]
    t.append(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, day string"), "day")
    t.upsert(spark.createDataFrame([(1, "c+d%20"), (9, "a b")], "k int, day string"), ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(0, "a b"), (1, "c+d%20"), (2, "é/="), (3, "plain"), (9, "a b")]


def test_empty_tables_and_many_listings(spark, root):
    t = Published(spark, f"{root}/t", "k")
    with pytest.raises(ValueError, match="nothing"):
        t.read()
    t.append(pairs(spark, (0, "x")).limit(0))
    assert t.read().count() == 0 and t.delete("k = 1") == 0
    for i in range(18):
        t.append(pairs(spark, (i, "x")))
    assert len(t.record()["listings"]) < 17 and t.read().count() == 18
    t.vacuum(1)
    assert t.read().count() == 18 and t.versions() == [18]


BATCHES = [[(1, "a", 1), (2, "b", 1), (1, "c", 2)], [(2, "B", 1), (3, "d", 1)], [(None, "n", 1)], [(None, "m", 1), (1, "C", 2)]]
LAST = {(1, 1): "a", (2, 1): "B", (3, 1): "d", (1, 2): "C", (None, 1): "m"}


class Stopped(Exception):
    pass


def stopping(monkeypatch, at):
    """The at-th write of files, a listing or a record stops its caller: before it happens, or (odd) once it has."""
    from pyspark.sql import DataFrameWriter

    count, parquet, record = [0], DataFrameWriter.parquet, Published._write_record

    def around(f):
        def call(*a, **b):
            count[0] += 1
            if count[0] * 2 == at:
                raise Stopped
            out = f(*a, **b)
            if count[0] * 2 + 1 == at:
                raise Stopped
            return out

        return call

    monkeypatch.setattr(DataFrameWriter, "parquet", around(parquet))
    monkeypatch.setattr(Published, "_write_record", around(record))
    return count


def test_a_batch_that_stops_anywhere_is_made_up_for(spark, root, monkeypatch):
    """After each stop readers see the table before the batch or after it; the batch comes again and all is there once."""
    rows = lambda r: spark.createDataFrame(r, "k int, v string, day int")
    for at in range(2, 8):
        t = Published(spark, f"{root}/t{at}", "k")
        write = p.last_wins(t.path, ["k", "day"], "day")
        write(rows(BATCHES[0]), 0)
        states = [sorted(map(str, t.read().collect()))]
        with monkeypatch.context() as m:
            stopping(m, at)
            with pytest.raises(Stopped):
                write(rows(BATCHES[1]), 1)
        seen = sorted(map(str, t.read().collect()))
        for n, batch in list(enumerate(BATCHES))[1:]:
            for _ in range(2):  # a batch that is there changes nothing
                write(rows(batch), n)
            states.append(sorted(map(str, t.read().collect())))
        assert seen in states[:2]
        assert {(r.k, r.day): r.v for r in t.read().collect()} == LAST and t.read().count() == len(LAST)


PING = "event_id long, vehicle string, route_no string, ep long, speed double, ignition boolean, aircon boolean, sos boolean"


def ping(i, vehicle, route, ep, speed=10.0, sos=False):
    return (i, vehicle, route, ep, speed, True, False, sos)


def test_serving_tables_and_stale_vehicles(spark, root):
    write = p.serving(f"{root}/log", f"{root}/latest", f"{root}/kpis", seconds=100)
    batch = lambda *r: spark.createDataFrame(list(r), PING)
    write(batch(ping(1, "a", "1", 1000), ping(2, "b", "2", 1010, 0.0)), 0)
    for _ in range(2):
        write(batch(ping(3, "a", "1", 1105, 30.0, True), ping(4, "a", "1", 1050, 99.0)), 1)
    read = lambda name: Published(spark, f"{root}/{name}").read()
    assert read("log").count() == 4
    assert sorted((r.vehicle, r.event_id) for r in read("latest").collect()) == [("a", 3), ("b", 2)]
    write(batch(ping(5, "c", "2", 1200, 5.0)), 2)
    kpis = {r.route: r for r in read("kpis").collect()}
    assert set(kpis) == {"1", "2", "ALL"} and kpis["ALL"].vehicles == 2 and kpis["1"].sos == 1  # b is stale


def test_serving_stops_between_any_two_writes(spark, root, monkeypatch):
    batch = lambda *r: spark.createDataFrame(list(r), PING)
    for at in (2, 4, 6, 7, 8, 12, 13, 16, 18):
        path = f"{root}/s{at}"
        write = p.serving(f"{path}/log", f"{path}/latest", f"{path}/kpis", seconds=1000)
        write(batch(ping(1, "a", "1", 1000), ping(2, "b", "2", 1010)), 0)
        with monkeypatch.context() as m:
            stopping(m, at)
            with pytest.raises(Stopped):
                write(batch(ping(3, "a", "1", 1105)), 1)
        write(batch(ping(3, "a", "1", 1105)), 1)
        read = lambda name, path=path: Published(spark, f"{path}/{name}").read()
        assert sorted(r.event_id for r in read("log").collect()) == [1, 2, 3]
        assert sorted((r.vehicle, r.ep) for r in read("latest").collect()) == [("a", 1105), ("b", 1010)]
        assert {r.route: r.vehicles for r in read("kpis").collect()} == {"1": 1, "2": 1, "ALL": 2}


def test_a_new_checkpoint_goes_on_from_the_last_version(spark, root):
    """Two queries, one after the other, each with a checkpoint of its own and batches from 0 on."""
    schema = "vehicle string, ep long, event_id long"
    for run, rows in enumerate(([("a", 1, 1), ("b", 2, 2)], [("c", 3, 3)], [("d", 4, 4), ("a", 5, 5)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in{run}")
        q = p.to_batches(readers.table_stream(spark, f"{root}/in{run}", schema), p.versioned(f"{root}/latest", p.newest(["vehicle"], "ep", "event_id")), f"{root}/state{run}")
        q.awaitTermination()
    t = Published(spark, f"{root}/latest")
    assert sorted((r.vehicle, r.ep) for r in t.read().collect()) == [("a", 5), ("b", 2), ("c", 3), ("d", 4)]
    assert len(t.record()["seen"]) == 3 and "" not in t.record()["seen"]


def test_compaction_by_bins(spark, root):
    t = Published(spark, f"{root}/t", "id")
    rows = lambda a, b, day, files: t.append(spark.range(a, b).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS s", f"{day} AS day").repartition(files), "day")
    rows(0, 4000, 1, 40)
    rows(4000, 4100, 2, 1)
    rows(4100, 64_100, 2, 1)
    rows(64_100, 84_100, 1, 1)
    sizes = sorted(r.bytes for r in t.listing().collect())
    small, middle, large = sizes[39], sizes[-2], sizes[-1]
    least, target, most = small * 4, small * 10, middle + 1
    found = layout.bins(t.listing(), least, target, most).collect()
    assert len({r.file for r in found}) == 41 and sorted({r.folder for r in found}) == ["day=1", "day=2"]  # a lone small file of a day stays
    per = {}
    for r in found:
        per.setdefault((r.folder, r.bin), []).append(r)
    assert max(r.pieces for r in found) == -(-large // target) > 3 and all(len(v) <= 11 for v in per.values()) and len(per) >= 5
    lone = {r.file for r in t.listing().collect()} - {r.file for r in found}
    assert layout.compact(t, least, target, most, at_once=15) == 41
    after = t.listing().collect()
    assert lone <= {r.file for r in after} and sum(r.rows for r in after) == 84_100
    assert max(r.bytes for r in after if r.file not in lone) < 2 * target
    whole = t.read().agg(F.count("*"), F.sum("id"), F.count_distinct("id"), F.sum("day")).collect()[0]
    assert tuple(whole) == (84_100, sum(range(84_100)), 84_100, 24_000 + 2 * 60_100)
