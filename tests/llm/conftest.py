import os
import random

import pytest

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "delta", "Été", "naïve", "x1", "the", "of", "日本"]
    long = " ".join(rng.choice(vocab) + str(rng.randint(0, 400)) for _ in range(6000))
    some = " ".join(rng.choice(vocab) + str(rng.randint(0, 60)) for _ in range(150))
    rows = [
        (1, some, "en", "a", 5), (2, some, "en", "a", 5), (3, some, None, None, None), (None, some, "en", "a", 1),
        (4, "", "en", "a", 0), (5, None, "fr", "a", None), (6, " \t\n", None, "b", 3), (7, "!!! ???", "en", "b", 7),
        (8, long, "fr", "c", 9), (9, long[:-5] + "tail.", "fr", "c", 9), (10, "one", "en", "c", 3), (10, "one", "en", "c", 3),
        (10, "two words", "en", "c", 9), (None, None, None, None, None), (11, "a" * 3000, "en", "d", 3000), (12, "a" * 2500, "en", "d", 2500),
        (13, "alpha\x1cbeta <|endoftext|> Ünïted\x00", "en", "d", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    # Extra columns named like what the operators make.
    return df.withColumns({c: F.lit(k) for k, c in enumerate(("kept", "score", "key", "h", "fp", "n", "part", "t", "m", "r", "label", "words"))})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
