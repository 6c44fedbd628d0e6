import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

AWKWARD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "  \n\t ", None, "b", 5), (4, "!!! ???", "en", None, 7), (5, "one", "en", "b", 3),
    (6, "one two three four", "en", "b", 18), (6, "one two three four", "en", "b", 18), (7, "ein wört mit ümläuten und mehr wörtern", "de", "a", 38),
    (8, "word " * 30000, "en", "c", 150000), (None, "a text of no known number at all here", "en", "c", 37), (None, None, None, None, None),
]


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns that clash with working names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, DOC)
    extra = {"rid": F.lit("x"), "rep": F.lit(1), "size": F.lit(2.5), "score": F.lit(None).cast("int"), "toxicity": F.lit("t"), "shard": F.lit(9), "n": F.lit(1), "h": F.lit("h"), "_b": F.lit(0), "target": F.lit("z")}
    return docs.withColumns(extra)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC)
