import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def docs_of(spark):
    """documents rows from (doc_id, text) or (doc_id, text, lang, source), dealt over several partitions."""
    def make(rows, **extra):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
        return df.selectExpr("*", *[f"{v} AS {k}" for k, v in extra.items()])
    return make
