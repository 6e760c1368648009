"""Every registered query against its SQL, on the small tables."""

import __spark_entry__ as entry
import pytest
from oracle_check import compare, connect

from footfall.plans import CATALOG

ORACLES = {k: q for k, q in entry.oracle_sql().items() if k in CATALOG}
QUERIES = {k: q for k, q in entry.queries().items() if k in CATALOG}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_sql(spark, con, small, key):
    frame = QUERIES[key](spark, small)
    assert compare(con, ORACLES[key], frame) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:3] == ["area", "area_level", "product_id"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_no_query_is_empty():
    """Equal results prove nothing where both have no rows."""
    from footfall.plans import CATALOG

    con = connect("/root/testdata/sf0.01")
    empty = [
        key for key, q in CATALOG.items()
        if q.oracle is not None and not con.execute(f"SELECT count(*) FROM ({q.oracle})").fetchone()[0]
    ]
    assert empty == []
