import pytest
from pyspark.sql import types as T

from tallyworks.workspace import Workspace

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

#: Names that operators use for columns of their own.
CLASHES = ["size", "key", "node", "_node", "grp", "part", "depth", "shard", "words", "labels", "score", "n_tokens",
           "ids", "copies", "root", "target", "taken", "n_lines", "held_out", "fine", "time"]


@pytest.fixture(scope="session")
def frame(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows, clash=False):
        whole = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None if r[1] is None else len(r[1])) for r in rows]
        out = spark.createDataFrame(whole, DOCUMENT)
        if clash:
            from pyspark.sql import functions as F
            out = out.select("*", *[F.lit("own").alias(c) for c in CLASHES])
        return out

    return make


@pytest.fixture
def room(spark, tmp_path):
    return Workspace(spark, str(tmp_path))
