"""First and last rows of a key, by a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_at", at).where("_at = 1").drop("_at")


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return keep_first(df, keys, [F.col(order).desc()])
