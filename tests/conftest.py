import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabprep.session import local_session

    return local_session("tests", "8", 8)


@pytest.fixture(scope="session")
def make(spark):
    """Build a table from rows and a schema string."""
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def by(df, key):
    return {r[key]: r for r in df.collect()}
