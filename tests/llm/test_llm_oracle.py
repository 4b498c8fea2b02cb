"""Every query with SQL against DuckDB: over the small tables, and over made ones in which hosts differ and lines repeat."""

import pytest

from tests.oracle import TABLES, differing
from tidefleet.llm import queries as L

NAMES = sorted(L.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, name):
    assert differing(spark, name, L.queries()[name], L.oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Tables in which some hosts have bad pages, some sites' pages share most of their lines, and ids, urls and texts may be null."""
    import duckdb

    d = str(tmp_path_factory.mktemp("uneven"))
    c = duckdb.connect()
    source = "/root/testdata/sf0.001"
    for t in TABLES:
        c.execute(f"COPY (SELECT * FROM '{source}/{t}.parquet') TO '{d}/{t}.parquet'")
    c.execute(f"""COPY (SELECT i AS page_id, CASE WHEN i % 50 = 49 THEN NULL WHEN i % 50 = 48 THEN 'none' ELSE 'http://' || CASE i % 5 WHEN 0 THEN 'bad.example.info' WHEN 1 THEN 'also.bad.co.uk' WHEN 2 THEN 'h' || (i % 40) || '.example.com' WHEN 3 THEN '10.0.0.1:80' ELSE 'www.good.net' END
      || '/p/' || i END AS url, '' AS html FROM range(600) r(i)) TO '{d}/pages.parquet'""")
    c.execute(f"COPY (SELECT i AS doc_id, CAST(CASE WHEN i % 5 < 2 THEN i % 9 = 0 ELSE i % 9 <> 0 END AS INTEGER) AS quality, 0 AS toxic FROM range(0, 600, 2) r(i)) TO '{d}/labels.parquet'")
    c.execute(f"""COPY (SELECT i AS doc_id, CASE WHEN i % 20 = 19 THEN NULL ELSE CASE WHEN i % 3 = 0 THEN 'shared menu' || chr(10) || 'shared end' WHEN i % 3 = 1 THEN 'own ' || i || chr(10) || ' shared menu ' ELSE 'own ' || i || chr(10) || chr(10) || 'own b ' || i END END AS text,
      'en' AS lang, CASE WHEN i % 7 = 0 THEN NULL ELSE 's' || (i % 2) END AS source, 0 AS n_chars FROM range(300) r(i)) TO '{d}/documents.parquet'""")
    return d


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql_on_uneven_tables(spark, uneven, name):
    assert differing(spark, name, L.queries()[name], L.oracle_sql()[name], uneven) == []


def test_bad_hosts_are_blocked_by_the_method(spark, uneven):
    found = L.op8_url_filter(spark, uneven).filter("rule is null").groupBy("host", "verdict").count().collect()
    blocked = {r.host for r in found if r.verdict == "block"}
    assert blocked == {"bad.example.info", "also.bad.co.uk"}
    assert not blocked & {r.host for r in found if r.verdict == "allow"}
