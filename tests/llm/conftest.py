import pytest


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame of one partition, so that their order is fixed."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).coalesce(1)

    return make
