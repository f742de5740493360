from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def frame(spark):
    """A function: documents (id, text) as a DataFrame."""
    return lambda rows: spark.createDataFrame(list(rows), DOCS)
