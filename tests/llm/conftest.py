import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType()), StructField("size", StringType()),
                   StructField("score", StringType()), StructField("digest", StringType())])

LONG = "word " * 400 + "tail\tof a very\nlong text " * 900
EDGE = [  # null, empty, blank, marks only, special strings, control codes, many scripts, repeated rows, a very long text
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "... 123 !!", "en", "a"),
    (5, "One <|endoftext|> two <|startoftext|>.", "en", "b"), (6, "tab\there\x0bthere\x0c\r\n end", "en", "b"),
    (7, "naïve café ß İstanbul ΣΑΣ 日本語 🙂 é", "fr", None), (8, "it's we're I'LL 'tis '", "en", None),
    (9, "same text twice here now", "en", "a"), (9, "same text twice here now", "en", "a"),
    (10, "Same TEXT twice here now", "en", "b"), (11, "short one", "de", "b"), (12, "Short  one", "de", "b"),
    (13, LONG, "en", "c"), (14, LONG + "x", "en", "c"), (15, "nothing in common with the others at all", None, "c")]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with every kind of odd row, and extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "clash", "clash", "clash") for i, t, lang, s in EDGE], DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
