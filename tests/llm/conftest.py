import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that operators use themselves
                     T.StructField("n_lines", T.StringType()), T.StructField("score", T.StringType()), T.StructField("id", T.StringType()),
                     T.StructField("Kept", T.StringType()), T.StructField("part", T.StringType())])


@pytest.fixture
def make_docs(spark):
    """Documents of (doc_id, text), with further columns of clashing names."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "x", "y", "z", "k", None) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def rows_of():
    import pyarrow.parquet as pq
    return lambda table, sf=SF: pq.read_table(f"{sf}/{table}.parquet").to_pylist()


#: Nulls, empty and blank texts, repeated rows, ties, a very long text, several alphabets.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (4, "one"), (5, "ä ö ü 漢字 \n\n ä"), (None, "no id at all, only words"), (None, None),
       (7, "word " * 40_000), (8, "word " * 40_000), (9, "x" * 300_000), (-3, "negative ids are ids too"), (1 << 40, "large ids as well")]
