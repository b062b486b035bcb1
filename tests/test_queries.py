"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from arealens.plans.registry import ORACLES, QUERIES
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    count, problems = compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name])
    assert not problems, "\n".join(problems)
    assert count > 0
