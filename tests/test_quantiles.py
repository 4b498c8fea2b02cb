"""Exact quantiles by sketches and brackets against those of one aggregation."""

import pytest
from pyspark.sql import functions as F

from tidefleet.operators.quantiles import quantiles

SHARES = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """One group of 150 000 values, one of one value, one of ties, small ones, nulls and NaN, and a group of the null key."""
    v = "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 51 = 0 THEN DOUBLE('NaN') WHEN k = 'ties' THEN id % 3 WHEN k = 'one' THEN 7 WHEN k IS NULL THEN -id ELSE id * 7919 % 1000003 + id / 1e6 END"
    return spark.range(250_000).selectExpr("id", "CASE WHEN id < 150000 THEN 'large' WHEN id < 190000 THEN 'ties' WHEN id < 210000 THEN 'one' WHEN id < 230000 THEN NULL WHEN id < 249900 THEN 's' || id % 97 ELSE 'none' END AS k").selectExpr("k", f"IF(k = 'none', NULL, {v}) AS v").cache()


def test_quantiles_are_exact(rows):
    expected = {r.k: r.q for r in rows.filter("NOT isnan(v) OR v IS NULL").groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, SHARES))).alias("q")).collect()}
    for at_once in (10_000_000, 2000):
        found = {r.k: r.q for r in quantiles(rows, ["k"], "v", SHARES, at_once).collect()}
        assert found.keys() == expected.keys() and found["none"] is None
        for k, q in expected.items():
            assert q is None or max(abs(a - c) for a, c in zip(q, found[k], strict=True)) < 1e-6, (k, q, found[k])


def test_no_group_and_two_keys(spark, rows):
    assert quantiles(rows.limit(0), ["k"], "v", [0.5]).collect() == []
    two = rows.withColumn("j", F.lit(1)).filter("k = 'large'")
    assert [tuple(r) for r in quantiles(two, ["j", "k"], "v", [0.5], 5000).collect()] == [tuple(r) for r in quantiles(two, ["j", "k"], "v", [0.5]).collect()]
