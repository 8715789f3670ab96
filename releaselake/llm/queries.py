"""The registered queries of this subpackage: each reads its tables and applies one operator with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, centroids, chat, fingerprints, html_text, infill, near_dedup, packing, pii, secrets, segment, toxicity
from .common import read


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.digest(read(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings")).drop("scans")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(read(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"))


OPERATORS = (
    op1_fingerprints, op2_pii, op3_html_text, op4_packing, op5_segment, op6_nearest, op7_near_dedup, op8_toxicity, op9_chat, op10_secrets, op11_centroids, op12_infill, op13_bpe,
)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLE_SQL: dict[str, str] = {"op11_centroids": centroids.oracle_sql(), "op12_infill": infill.oracle_sql()}
