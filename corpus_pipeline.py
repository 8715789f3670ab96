"""The corpus pipeline: from the documents table to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. The stages learn from labels or decide by models, which SQL does not
express, so that the whole is tested against the operators one by one and against brute force.

Null and empty texts are clean, copies of nothing, hold no personal data and are packed as one separator; null texts stay null until then.
Rows with a null id, and rows that share an id, are judged by their own texts; of equal rows, and of rows with equal texts, one stays. Very long texts
are read whole. Without labels nothing is toxic, and no documents give no sequences. Further columns of documents pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from releaselake.llm import near_dedup, packing, pii, toxicity
from releaselake.llm.common import discard, materialize, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document gets its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if written is not None:
            discard(written)  # the stage after it is a table of its own by now
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
