import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns that clash with own names."""
    long = "alpha beta gamma delta epsilon zeta eta theta " * 40_000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en"),
        (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en"),
        (1, "another text of the same id", None), (2, None, "en"), (3, "", "fr"), (4, " \n\t ", None), (None, "no id here at all", "en"),
        (None, "no id here at all", "en"), (None, None, None), (5, long, "en"), (6, "!!! ### 123", "de"), (7, "Äpfel und Öl <|endoftext|>", "de"),
        (8, "one", None), (9, "a\tb\x1cc  d\r\n\r\ne", "es"), (-10, "below zero", "en"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.withColumns({
        "source": F.lit(None).cast("string"), "n_chars": F.char_length("text").cast("long"), "fp": F.lit("clash"), "key": F.lit(1),
        "part": F.lit(2), "edge": F.lit(1), "hits": F.lit(0), "items": F.lit(0), "mark": F.lit(5), "root": F.lit(1), "votes": F.lit("v")})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
