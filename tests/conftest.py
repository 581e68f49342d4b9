from __future__ import annotations

import pytest

from tests.compare import duck, session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
