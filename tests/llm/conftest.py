import pytest

from roadlens.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as documents with columns that clash with names the operators use inside and return."""

    def make(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema)
        for name in ("size", "score", "found", "print", "key", "id", "th", "label", "words", "_1"):
            if name not in df.columns:
                from pyspark.sql import functions as F

                df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture
def many_partitions(spark):
    """Small results of a shuffle stay in as many partitions as it has."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)
