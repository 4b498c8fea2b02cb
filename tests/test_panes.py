"""Windows put together from panes, against windows over the rows."""

import pytest
from pyspark.sql import functions as F

from tidefleet.operators import status


@pytest.fixture(scope="module")
def pings(spark):
    """A minute's pings by the hundred, with holes in time, null speeds and null routes."""
    rows = spark.range(12_000).selectExpr("id", "timestamp_seconds(1700000000 + id * 7919 % 4000 + IF(id % 3 = 0, 9000, 0)) AS timestamp", "'v' || (id * 31 % 5000) AS vehicle", "CASE WHEN id % 9 > 0 THEN 'r' || id % 2 END AS route_no", "CASE WHEN id % 11 > 0 THEN CAST(id % 60 AS DOUBLE) END AS speed", "id % 50 = 0 AS sos", "id % 4 > 0 AS ignition")
    return rows.cache()


@pytest.mark.parametrize(("width", "slide"), [("5 minutes", "1 minute"), ("6 minutes", "2 minutes"), ("10 minutes", None)])
def test_windows_equal_those_over_the_rows(pings, width, slide):
    n = lambda c: F.sum(F.coalesce(c.cast("int"), F.lit(0)))
    expected = pings.groupBy(F.window("timestamp", width, slide).alias("w"), "route_no").agg(
        F.round(F.avg("speed"), 9).alias("avg_speed"), F.count("*").alias("messages"), F.count_distinct("vehicle").alias("exact"), n(F.col("speed") > 0).alias("moving"), n(F.col("speed") == 0).alias("stopped"), n(F.col("sos")).alias("sos"), n(F.col("ignition")).alias("ignition_on"))
    expected = {(r.w.start, r.w.end, r.route_no): r for r in expected.collect()}
    found = status.window_kpis(pings, width=width, slide=slide).withColumn("avg_speed", F.round("avg_speed", 9)).collect()
    assert len(found) == len(expected) > 20
    for r in found:
        e = expected[r.window_start, r.window_end, r.route_no]
        assert all(r[c] == e[c] for c in status.MEASURES if c != "vehicles"), (r, e)
        assert abs(r.vehicles - e.exact) <= max(1, 4 * 0.0065 * e.exact)


def test_one_store_answers_any_width(spark, pings, tmp_path):
    status.panes(pings).write.parquet(f"file://{tmp_path}/panes")
    stored = spark.read.parquet(f"file://{tmp_path}/panes")
    for width, slide in (("5 minutes", "1 minute"), ("15 minutes", "5 minutes"), ("1 hour", "1 hour")):
        plain = lambda df: {(r.window_start, r.route_no): r for r in df.drop("avg_speed").collect()}
        a, e = plain(status.pane_kpis(status.merged_panes(stored, width, slide), width)), plain(status.window_kpis(pings, width=width, slide=slide))
        assert a.keys() == e.keys() and all(a[k].messages == e[k].messages and a[k].ignition_on == e[k].ignition_on and abs(a[k].vehicles - e[k].vehicles) <= max(1, 0.03 * e[k].vehicles) for k in a)


def test_rows_are_not_multiplied(pings):
    plan = status.window_kpis(pings)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.index("explode(sequence") < plan.rindex("partial_hll_sketch_agg")  # above the first aggregation
