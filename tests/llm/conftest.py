import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHING = ("id", "n", "q", "key", "uid", "size", "word", "gram", "fp", "rank", "count", "copies", "row", "sha", "kept", "score", "gone", "nth", "h", "part")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "É", "naïve", "x1", "don't", "the"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    same = " ".join(rng.choice(words) for _ in range(80))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \t\n ", "en", "a", 5), (4, "one", "en", "b", 3),
        (5, same, "en", None, 1), (6, same, "de", "b", 1), (7, same + " end", "de", "b", 1), (8, long, "fr", "c", 1),
        (9, long, "fr", "c", 1), (10, "x" * 70_000, "en", "c", 1), (None, same, "en", "a", 1), (None, "other words here", None, "a", 1),
        (11, "tie", "en", "b", 1), (11, "tie", "en", "b", 1), (12, " é 中文 \U0001f600 <|endoftext|>s 's", "zz", "Z", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with names of the operators' own."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows, DOCS)
    return frame.select("*", *[F.lit(f"<{c}>").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
