import pytest

from tests.oracle import connection, differing
from tidefleet.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differing(spark, name, QUERIES[name], ORACLES[name]) == []


def test_every_query_has_sql_and_rows():
    """No query goes without SQL, and no SQL is over an empty result, which would agree with anything."""
    assert set(QUERIES) == set(ORACLES)
    c = connection()
    assert [n for n in sorted(ORACLES) if c.execute(f"SELECT count(*) FROM ({ORACLES[n]})").fetchone()[0] == 0] == []
