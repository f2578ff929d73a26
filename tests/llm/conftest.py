import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, in three partitions, with columns
    whose names are likely to clash with an operator's own."""
    def build(rows, extra=True):
        full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:
            for name in ("key_id", "key_hash", "n", "nodes", "bucket", "span", "fingerprint", "digest",
                         "rank", "size", "score", "words", "start"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return build
