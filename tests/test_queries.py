"""Every registered query against its SQL twin on the smallest data folder."""

import pytest

from check import compare, connect
from palmares.queries import load

FOLDER = "/root/testdata/sf0.001"
QUERIES = load()

@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, name, QUERIES[name]) is None


def test_every_query_has_a_twin():
    assert not {n for n, q in QUERIES.items() if q.sql is None}
