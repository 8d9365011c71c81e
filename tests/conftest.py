import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4, app_name="starloom-tests")
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from starloom.oracle.check import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    from starloom.oracle.check import duckdb_connection

    return duckdb_connection(SF_MID)
