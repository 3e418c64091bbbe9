"""Every registered query against its DuckDB oracle (the driver's check), on sf0.001."""

import pytest

import __spark_entry__ as entry
from cohortline.plans.queries import ORACLE, QUERIES
from conftest import SF_SMALL
from parity import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["subject_id", "time", "code", "numeric_value", "text_value"]
    assert df.count() > 0
