"""Small tables that hold every awkward case, as fixtures."""

import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa. " * 400


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, ties, repeated rows, a long text, null ids, columns that clash with results."""
    rows = [(1, None), (2, ""), (3, "Hello, world!"), (3, "Hello, world!"), (4, "Hello, world!"), (5, LONG), (6, LONG + " end"),
            (None, "no id here"), (None, None), (7, "   \n\n\t "), (8, "漢字 é ß 😀 1234 <|endoftext|> it's"), (3, "other text, same id"),
            (9, "!!! ??? ..."), (10, "idiot\x1cscum trash")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("score", "n_tokens", "id", "rid", "spans", "hits", "shard", "rank", "piece",
                                                   "kept", "n_bytes", "part")}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
