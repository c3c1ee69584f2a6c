"""Every registered query against its SQL twin, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

from ledgerline.testbed import load_cases  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = load_cases()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, text = compare.compare(spark, con, name, FOLDER, QUERIES, ORACLE)
    assert ok, text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
