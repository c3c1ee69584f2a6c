import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), ...)``."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df, *columns):
    """All rows as plain tuples, in the order they come."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def row_set(df, *columns):
    return sorted(rows(df, *columns), key=lambda r: tuple((v is None, str(v)) for v in r))
