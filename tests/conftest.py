import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orewright.session import local_session

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def sample():
    if not os.path.isdir(SAMPLE):
        pytest.skip("sample tables are not here")
    return SAMPLE


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def values(df, *columns):
    """Rows as sorted tuples of the named columns (all by default)."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
