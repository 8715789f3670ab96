import pytest
from pyspark.sql import functions as F

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (3, None), (4, ""), (5, " \t\n "), (6, "é 中文 🎉 ▁x \\ <|user|>"), (7, "word " * 30_000), (8, "a" * 50_000), (None, "no id here at all, only a text"), (10, "short"), (10, "short"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use inside."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    extra = {c: F.lit("x") for c in ("key", "n", "salt", "rank", "length", "spans", "score", "rep", "kept", "v", "c")}
    return docs.withColumns(extra).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")
