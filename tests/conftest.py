import pytest

from meterwatch.session import build_session
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.fixture()
def rows(spark):
    """rows(schema, [...]) -> DataFrame"""
    return lambda schema, data: spark.createDataFrame(data, schema)
