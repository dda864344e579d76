"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import catalogue
from oracle import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
QUERIES, ORACLES = catalogue.all_queries(), catalogue.all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    seen, faults = compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name])
    assert not faults and seen > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["series_id", "series_label", "best_year", "best_year_summed_value"]
