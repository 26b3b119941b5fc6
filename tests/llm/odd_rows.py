"""Fixtures of the operators' tests, and rows that every operator must take."""

import pytest
from pyspark.sql import types as T

from sentimart.session import ship_package


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship_package(spark)
    return spark


@pytest.fixture
def docs_of(llm_spark):
    """documents-like frames; extra columns clash with names the operators use inside."""

    def make(rows):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("key", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("n", T.StringType()), T.StructField("hash", T.StringType())])
        return llm_spark.createDataFrame([(k, t, "x", None, "y", "z") for k, t in rows], schema)

    return make


#: Nulls, empty and very long texts, repeated rows and ids.
ODD_ROWS = [(1, None), (2, ""), (None, "a b c"), (None, None), (4, " \n\t "), (5, "word"), (5, "word"), (5, "other words here"), (6, "lorem ipsum dolor " * 40_000), (7, "é" * 3000)]
