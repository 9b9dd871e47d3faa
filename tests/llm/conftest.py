import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old mill", "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, "the QUICK brown fox jumps over the lazy dog near the old mill", "en", "b", 2),
        (4, "the QUICK brown fox jumps over the lazy dog near the old mill", "en", "b", 2),
        (None, "no name at all", "en", "b", 3),
        (6, "word " * 30_000, "de", "c", 4),
        (7, " \n\t ", "de", "c", 4),
        (8, "é ü 中文 🙂 one two", "fr", "é", 5),
        (9, "All rights reserved. CC BY 4.0, cc by cc-by; GNU General Public License, version 3", "fr", "é", 5),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    return frame.withColumn("size", F.lit("x")).withColumn("block", F.lit(1)).withColumn("fp", F.lit(2.5)).withColumn("score", F.lit("y")).withColumn("shard", F.lit("z"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
