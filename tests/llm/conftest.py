import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names may clash."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
                           T.StructField("k1", T.StringType()), T.StructField("label", T.StringType()),
                           T.StructField("spans", T.StringType()), T.StructField("copies", T.StringType())])

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]),
                 "x", "y", "z", "w", "v") for r in rows]
        return spark.createDataFrame(full, schema)

    return make
