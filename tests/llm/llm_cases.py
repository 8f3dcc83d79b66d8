"""Small tables with every awkward case, and helpers shared by the tests of the llm operators."""

import pytest
from pyspark.sql import functions as F

from leadflow.llm import common as C

AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta\nA shared line of text\nx"),
    (2, "  a SHARED line of text \t\nsomething else entirely\n"),
    (3, None),
    (4, ""),
    (5, "\n\n"),
    (6, "alpha beta gamma delta epsilon zeta eta theta\nA shared line of text\nx"),
    (6, "alpha beta gamma delta epsilon zeta eta theta\nA shared line of text\nx"),
    (7, "café ñandú été 123 $$$ !!\r\n　wide space"),
    (8, "word " * 3000),
    (9, "x" * 5000),
    (None, "a row without an id, A shared line of text\nA shared line of text"),
    (10, "<|endoftext|> in the text<|endoftext|>"),
    (11, "12.5 77"),
]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    C.ship(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """(doc_id, text) and columns whose names the operators use themselves, with nulls."""
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    for name in ("_id", "_text", "row", "line", "key", "pos", "score", "lang", "shard", "_print", "at"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def texts(duck_mid):
    return dict(duck_mid.sql("SELECT doc_id, text FROM documents").fetchall())
