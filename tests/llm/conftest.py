import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with columns that operators use as names of their own."""

    def make(rows):
        rows = [tuple(r) + ("s",) * (3 - len(r)) for r in rows]
        df = spark.createDataFrame(rows, DOCS)
        for name in ("size", "key", "hash", "fp", "line", "label", "score", "word", "kind", "n", "target", "uid", "row"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabulary():
    from plumbline.llm.queries import BYTE_BPE, vocabulary

    return vocabulary(BYTE_BPE)
