import pytest
from pyspark.sql import functions as F


@pytest.fixture
def frame(spark):
    """A DataFrame of documents from (doc_id, text) pairs, spread over several partitions."""

    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture
def cluttered():
    """Add columns whose names an operator might use itself."""

    def add(df):
        names = ["shard", "size", "fp", "kept", "rule_kept", "pii", "lang_pred", "__text", "__key", "__order", "term", "digest", "salt"]
        return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])

    return add
