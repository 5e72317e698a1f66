import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables need few tasks; the operators run many short jobs."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)
