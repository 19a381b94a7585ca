import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import ODD  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("score", T.StringType()),
        T.StructField("row_", T.StringType()),
        T.StructField("size_", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source), with columns of clashing names."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            id_, text, source = ((i, row, "a") if not isinstance(row, tuple) else (*row, "a"))[:3]
            full.append((id_, text, "en", source, None if text is None else len(text), "s", "r", "z"))
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
