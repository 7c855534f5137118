import pytest
from pyspark.sql import types as T

from episcope.llm.common import ship_code
from episcope.llm.registry import tokenizer_path

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, over some partitions."""
    ship_code(spark)

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)
    return make
