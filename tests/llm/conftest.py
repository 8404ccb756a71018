import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """A small table of documents: rows of (doc_id, text, lang, source), with extra columns of clashing names."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("comp", T.StringType())]
    )

    def make(rows):
        return spark.createDataFrame([(*r, *[None] * (4 - len(r)), "x", 1, "y") for r in rows], schema)

    return make
