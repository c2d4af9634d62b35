"""Every query against its SQL twin over the whole small tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from feedmill.plans.oracle import ORACLE
from feedmill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    assert difference(QUERIES[name](spark, sf), con, ORACLE[name]) is None


def test_entry_is_sorted_and_limited(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 20
    assert [r.date for r in rows] == sorted((r.date for r in rows), reverse=True)


def test_fixture_counts(spark, sf):
    """Counts known from the fixture description at sf0.001."""
    from feedmill.plans import fixtures as fx

    a = fx.articles(spark, sf)
    assert (a.count(), a.select("url").distinct().count(), a.select("date").distinct().count()) == (200, 50, 200)
    assert fx.sources(spark, sf).count() == 17
