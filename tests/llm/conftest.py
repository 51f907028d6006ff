import os

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names that the operators use in their results or on the way.
CLASHING = ("shard", "slot", "size", "curve", "row", "node", "label", "kept", "key", "h", "n", "score", "entities", "path", "reads", "target", "mark",
            "_id", "_size", "_crc", "_curve", "_shard", "_row", "_text_key", "_no_id", "_source", "_copy", "_key", "_found", "_letters", "_first", "_rt_part_", "times", "draw")


@pytest.fixture(scope="session")
def make(spark):
    """(doc_id, text, lang, source) rows as a documents table, with columns of clashing names on demand."""
    from pyspark.sql import functions as F

    def frame(rows, clash=True):
        df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], SCHEMA)
        return df.withColumns({c: F.lit("x") for c in CLASHING}) if clash else df

    return frame


LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "Word", None, "b"), (5, "Word", None, "b"), (5, "Word", None, "b"),
    (None, "some words without an id, more of them than five", "en", None), (6, "a b", "en", "b"), (7, LONG, "en", "a"), (8, LONG + " tail", "en", "c"),
    (9, "1234 !!! 5678", "fr", "c"), (10, "ünï cödé " * 40, "de", "c"), (11, "same words here again and again", "en", "a"), (12, "same words here again and again", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
