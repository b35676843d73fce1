import pytest

from coverlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A DataFrame from literal rows."""
    return lambda schema, data: spark.createDataFrame(data, schema)
