import pytest
from odd_data import COLUMNS, odd_rows


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3).cache()


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
