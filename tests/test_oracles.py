"""Every registered query against its SQL twin, over the smallest given tables."""

import os

import pytest

from checks import compare
from checks.oracle import ORACLES
from checks.registry import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"{SF_DIR} is not there")
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare.compare(spark, connection, SF_DIR, name) is None
