import pytest

from tests.conftest import SMALL


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
