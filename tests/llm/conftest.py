import pytest
from pyspark.sql import functions as F

LONG = ("a long text of many words that goes on, " * 4000).strip()


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35), (2, None, "en", "s1", None), (3, "", None, "s2", 0),
            (4, "  \n\t ", "de", None, 5), (5, LONG, "en", "s2", len(LONG)), (6, "alpha beta gamma delta epsilon zeta", None, None, 35),
            (6, "alpha beta gamma delta epsilon zeta", None, None, 35), (None, "no id 日本 \U0001F600 é", "xx", "s3", 1),
            (None, None, None, None, None), (9, "one", "en", "s1", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = ["row", "score", "size", "times", "target", "id", "key", "label", "bucket", "shard", "hit", "clean", "parts", "base", "doc"]
    return df.withColumns({c: F.lit(f"own {c}") for c in taken})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
