"""Every registered query against its SQL on DuckDB."""

import os

import pytest

from oracle import compare, connect
from sedimenta.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLES.get(name)) == ""


def test_names():
    assert set(ORACLES) <= set(QUERIES)
