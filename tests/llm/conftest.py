import pytest

ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 3),
    (4, "one two", "en", None, 7),
    (5, "word " * 30_000, "en", "a", 150_000),
    (6, "x" * 200_000, "en", "a", 200_000),
    (7, "the same text of some words again and again", "en", "b", 43),
    (7, "the same text of some words again and again", "en", "b", 43),
    (8, "the same text of some words again and again", "de", "b", 43),
    (None, "a text without a key, é ß 😀 <|endoftext|>", "en", "b", 40),
    (9, "The Same text of some words again and AGAIN", "fr", None, 43),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from rows, with extra columns whose names results use too."""
    from pyspark.sql import functions as F

    def build(rows):
        clash = ["ids", "score", "kept", "label", "node", "hub", "place", "g", "n", "bin", "size", "shard", "row", "word", "sketch", "curve", "tie"]
        return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(k).alias(c) for k, c in enumerate(clash)])

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([])
