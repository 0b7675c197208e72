import pytest
from pyspark.sql import functions as F

#: Rows that every operator has to survive: nulls in any column, empty and very long texts,
#: ties, repeated rows, a text of punctuation only, and extra columns with the names that the
#: operators use themselves.
LONG = "The river runs past the old mill and the miller counts his sacks of grain. " * 4000
HOSTILE = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", None),
    (3, None, "en", "a"), (4, "", "en", "b"), (5, "   \n\t ", None, "b"), (6, "?!... ---", "de", "b"),
    (7, LONG, "en", "a"), (None, "Der alte Müller zählt die Säcke am Fluss und geht nach Hause.", "de", "c"),
    (8, "Der alte Müller zählt die Säcke am Fluss und geht nach Hause.", "de", "c"),
    (9, "x", None, ""), (None, None, None, None), (10, "   Éà ß İ", "fr", "c"),
]
CLASHES = ("_part", "_rank", "a", "b", "key", "rep", "class", "label", "v", "n", "h", "shard", "slot", "score", "_src", "_id")


@pytest.fixture(scope="session")
def hostile(spark):
    df = spark.createDataFrame(HOSTILE, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(hostile):
    return hostile.limit(0)
